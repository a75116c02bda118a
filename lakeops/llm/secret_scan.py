"""Secret scans: known shapes, and windows of high Shannon entropy per character class.

Candidates are the maximal runs of key characters (letters, digits, + / _ = -). A window of ``WINDOW`` characters slides
over each run. One step takes a character out and one in; the counts per character, the sum of c * log2(c) over them (in
fixed-point integers, so nothing drifts), the counts per kind of character and the number of ascending neighbours are
changed by these two characters only. The smallest class that holds all characters of the window (hex, alphanumeric,
base64) sets the entropy it needs and the kinds of characters it must show. Windows that pass are united where they
overlap or touch. A united span is dropped where it overlaps a match of the allow list (digests named as such, UUIDs, URLs, data
URIs, commit ids, placeholders) or a span of a known shape, which always stays.

Offsets count code points, ends are exclusive. One Arrow pass over whole texts, no shuffle, linear in a text's length.

Edge cases: null and empty texts have no spans; texts and runs of any length are scanned whole; repeated rows get the same spans;
an empty table gives none. Other columns are not read and may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import no_cycle_collection

# The known shapes. Group 2 of an assignment is the value.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # 16 characters or more
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
# an assignment needs one of these, in any case
ASSIGN_HINTS = ("passw", "secret", "token", "api")

RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
WINDOW = 20
ONE = 1 << 32  # fixed point
WEIGHT = [round(c * math.log2(c) * ONE) if c else 0 for c in range(WINDOW + 1)]


@dataclass(frozen=True)
class CharacterClass:
    kind: str
    characters: frozenset[str]
    least_bits: float  # entropy of a window, in bits per character
    letters: int  # least number of letters, of upper-case ones, of lower-case ones and of digits in a window
    upper: int
    lower: int
    digits: int

    @property
    def most_weight(self) -> int:
        """Largest sum of c * log2(c) a window of that entropy can have."""
        return math.floor((math.log2(WINDOW) - self.least_bits) * WINDOW * ONE)


DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# from the smallest to the largest
CLASSES = (
    CharacterClass("entropy_hex", frozenset("0123456789abcdefABCDEF"), 3.0, 2, 0, 0, 2),
    CharacterClass("entropy_alnum", frozenset(DIGITS + UPPER + LOWER), 3.85, 4, 2, 2, 1),
    CharacterClass("entropy_base64", frozenset(DIGITS + UPPER + LOWER + "+/_=-"), 3.85, 4, 2, 2, 1),
)
MOST_ASCENDING = WINDOW // 2  # neighbours like "ab" or "12": more are a counted-up sequence
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))

# Strings of high entropy that are not secrets.
ALLOWED = (
    r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",
    r"(?ai:\b(?:sha-?(?:1|224|256|384|512)|md5|integrity|checksum|etag)\b)[-:= \"']{1,4}[A-Za-z0-9+/=_-]+",
    r"(?ai:\b(?:commit|revision|rev|blob|tree)\b)[: ]{1,2}[0-9a-f]{7,}",
    r"(?ai:\bdata:[a-z]+/[a-z0-9.+-]{1,40};base64,)[A-Za-z0-9+/=_-]+",
    r"(?ai:\b(?:https?|ftp)://)[^\s\"'<>]+",
    r"[A-Za-z0-9+/_=-]*(?:EXAMPLE|PLACEHOLDER|YOUR_|your[-_]|xxxx|XXXX|0000000)[A-Za-z0-9+/_=-]*",
)
SPANS = "array<struct<kind string, start int, end int>>"

_CLASS_OF = {c: min(i for i, k in enumerate(CLASSES) if c in k.characters) for c in CLASSES[-1].characters}


def entropy_windows(run: str) -> list[tuple[int, int, int]]:
    """(start, end, class) of the united windows of a run that pass their class."""
    n = len(run)
    if n < WINDOW:
        return []
    counts: dict[str, int] = {}
    weight = ascending = 0
    kinds = [0, 0, 0, 0]  # digits, upper, lower, other
    of_class = [0] * len(CLASSES)
    kind_of = lambda c: 0 if c in DIGITS else 1 if c in UPPER else 2 if c in LOWER else 3
    found: list[list[int]] = []
    for end, c in enumerate(run):
        k = counts.get(c, 0)
        weight += WEIGHT[k + 1] - WEIGHT[k]
        counts[c] = k + 1
        kinds[kind_of(c)] += 1
        of_class[_CLASS_OF[c]] += 1
        if end and ord(c) - ord(run[end - 1]) == 1:
            ascending += 1
        start = end - WINDOW + 1
        if start < 0:
            continue
        which = max(i for i, m in enumerate(of_class) if m)
        cls = CLASSES[which]
        digits, upper, lower, _ = kinds
        if (
            weight <= cls.most_weight and ascending <= MOST_ASCENDING and digits >= cls.digits
            and upper >= cls.upper and lower >= cls.lower and upper + lower >= cls.letters
        ):
            if found and start <= found[-1][1]:
                found[-1][1], found[-1][2] = end + 1, max(found[-1][2], which)
            else:
                found.append([start, end + 1, which])
        gone = run[start]
        k = counts[gone]
        weight += WEIGHT[k - 1] - WEIGHT[k]
        counts[gone] = k - 1
        kinds[kind_of(gone)] -= 1
        of_class[_CLASS_OF[gone]] -= 1
        if ord(run[start + 1]) - ord(gone) == 1:
            ascending -= 1
    return [tuple(f) for f in found]


class Scanner:
    """All spans of a text: (start, place of the kind in KINDS, end), in order."""

    def __init__(self, allowed: Sequence[str] = ALLOWED):
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        known, high = [], []
        folded = text.lower()
        if any(h in folded for h in ASSIGN_HINTS):
            known += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
        for run in RUN.finditer(text):
            at, s = run.start(), run.group()
            if "AKIA" in s:
                known += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(s)]
            known += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(s)]
            high += [(at + a, 3 + which, at + b) for a, b, which in entropy_windows(s)]
        if high:
            taken = [(a, b) for a, _, b in known]
            if self.allowed:
                taken += [m.span() for m in self.allowed.finditer(text)]
            high = _outside(high, taken)
        return sorted(known + high)


def _outside(spans: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """The spans (in order, none overlapping another) that overlap none of ``taken``."""
    merged: list[list[int]] = []
    for a, b in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    out, i = [], 0
    for a, which, b in spans:
        while i < len(merged) and merged[i][1] <= a:
            i += 1
        if i == len(merged) or merged[i][0] >= b:
            out.append((a, which, b))
    return out


def find_secrets(documents: DataFrame, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end; by start, then kind) per row of ``documents`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allowed)
        item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        with no_cycle_collection():
            for batch in batches:
                spans = [
                    [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.spans(t)] if t else []
                    for t in batch.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(item))], names=["doc_id", "spans"])

    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(shown, ",")


def of_kinds(spans: Column, kinds: Sequence[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))
