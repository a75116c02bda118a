"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes. Every token points to the farthest-right token it overlaps (the one
of the other tokenizer that holds its last byte; a token that ends where that one ends is terminal if it
is of the second tokenizer). Doubling these successors, vectorised over all tokens of a batch, converges
to the terminal token of each component of the overlap graph: its label. Components are the groups between
byte offsets at which tokens of both end. Links are the pairs of tokens whose byte ranges overlap.

A single space between two characters that are not white space is a cut in both: byte-level BPE words start at it, and
the piece vocabulary joins nothing to a following space (checked when the file is loaded; otherwise texts
are not split). So texts are split there, and each distinct stretch of a batch is encoded and aligned once; stretches are kept per Python
worker in a table of bounded size.

Corpus-wide pair counts: links are stored once as packed pair codes, counted per task and summed by pair. The
most frequent pairs, at most ``HOT_PAIRS`` of them (a few MB), are looked up inside the tasks; links of all other pairs
are joined with the counts by shuffle, where no pair is frequent any more, and summed per row.

Edge cases: texts that are null, empty, or whose tokens' joined bytes differ from a space and the text have no tokens
(zeros, no groups). Repeated rows and ids stay rows of their own; an empty table gives none; other columns are not read.
Texts of any length are taken whole; a stretch without a space is aligned in memory as one piece.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import no_cycle_collection, stash
from lakeops.llm.token_count import _resolve, byte_symbols

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
HOT_PAIRS = 1 << 18
CHUNK_CHARS = 4_000_000  # texts aligned together
CHUNK_LINKS = 4_000_000  # links counted or looked up together
KEPT_STRETCHES = 200_000
KEPT_LENGTH = 64
MERGED_PAIRS = 4_000_000  # distinct pairs a counting task holds before it passes them on
CUT = re.compile(r"(?<=\S) (?=\S)")
# Fixed value: the words of byte-level BPE.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def groups_and_links(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group numbers of the A and of the B tokens, and the A and B positions of all links, from the byte
    lengths (1 or more each) of two token sequences over the same bytes."""
    n, m = len(len_a), len(len_b)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    end_a, end_b = np.cumsum(len_a), np.cumsum(len_b)
    last_b = np.searchsorted(end_b, end_a)  # the B token with an A token's last byte
    last_a = np.searchsorted(end_a, end_b)
    own = np.arange(n, n + m)
    successor = np.concatenate([n + last_b, np.where(end_a[last_a] > end_b, last_a, own)])
    while True:  # doubling: each round follows twice as many steps
        after = successor[successor]
        if np.array_equal(after, successor):
            break
        successor = after
    terminals = np.flatnonzero(successor[n:] == own)
    group = np.searchsorted(terminals, successor - n)
    first_b = np.searchsorted(end_b, end_a - len_a, side="right")
    partners = last_b - first_b + 1
    link_a = np.repeat(np.arange(n), partners)
    skipped = np.cumsum(partners) - partners
    link_b = np.arange(len(link_a)) + np.repeat(first_b - skipped, partners)
    return group[:n], group[n:], link_a, link_b


class Pair:
    """Two tokenizers, and the aligned stretches seen last."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        import sentencepiece
        import tiktoken

        with open(_resolve(byte_bpe), encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in byte_of for c in t)}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {t: i for t, i in ranks.items() if t.decode("utf-8", "replace") not in added}
        self.a = tiktoken.Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=_resolve(piece_bpe))
        self.size_a, self.size_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * self.size_a
        for t, i in ranks.items():
            self.bytes_a[i] = t
        pieces = [self.b.id_to_piece(i) for i in range(self.size_b)]
        as_byte = re.compile(r"<0x([0-9A-F]{2})>")
        self.bytes_b = [
            bytes([int(x[1], 16)]) if (x := as_byte.fullmatch(p)) and self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.splits = not any(re.search("[^▁]▁", p) for p in pieces)
        self.len_a, self.len_b = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.bytes_a, self.bytes_b))
        # a token's number with what follows it: "," inside a group's side, "|" or ";" at its end
        self.shown = [f"{i}{c}" for i in range(self.size_a) for c in ",|"] + [f"{i}{c}" for i in range(self.size_b) for c in ",;"]
        self.code = code_type(self.size_a, self.size_b)
        self.kept: dict[str, tuple | None] = {}

    def stretches(self, text: str) -> list[str]:
        """The parts of a text between cuts; each stands for a space and itself."""
        return CUT.split(text) if self.splits else [text]

    def align(self, stretches: Iterable[str]) -> None:
        """Add the given stretches to ``kept``: (groups as text, tokens A, tokens B, groups, packed links), or
        None where a tokenizer does not give the bytes back."""
        kept, words, a, b = self.kept, [], [], []
        stretches = list(stretches)
        for w, of_b in zip(stretches, self.b.encode(stretches, num_threads=1)):
            whole = f" {w}"
            of_a = self.a.encode_ordinary(whole)
            raw = whole.encode()
            if b"".join([self.bytes_b[i] for i in of_b]) != raw or b"".join([self.bytes_a[i] for i in of_a]) != raw:
                kept[w] = None
            else:
                words.append(w), a.append(of_a), b.append(of_b)
        n_a, n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
        a, b = (np.fromiter(chain.from_iterable(side), dtype=np.int64, count=int(n.sum())) for side, n in ((a, n_a), (b, n_b)))
        group_a, group_b, link_a, link_b = groups_and_links(self.len_a[a], self.len_b[b])
        links = (a[link_a] * self.size_b + b[link_b]).astype(self.code)
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        groups = np.concatenate([[0], group_b[upto_b - 1] + 1]) if len(words) else np.zeros(1, dtype=np.int64)
        upto_link = np.searchsorted(link_a, upto_a)
        # the tokens as written: a group's A tokens, then its B tokens
        ends_a = np.append(group_a[1:] != group_a[:-1], True)[: len(a)]
        ends_b = np.append(group_b[1:] != group_b[:-1], True)[: len(b)]
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 2 * a + ends_a
        order[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 2 * (self.size_a + b) + ends_b
        shown = list(map(self.shown.__getitem__, order.tolist()))
        packed, width = links.tobytes(), links.itemsize
        at = at_link = 0
        rows = zip(words, n_a.tolist(), n_b.tolist(), np.diff(groups).tolist(), (upto_a + upto_b).tolist(), (upto_link * width).tolist())
        for w, x, y, g, upto, to_link in rows:
            kept[w] = ("".join(shown[at:upto]), x, y, g, packed[at_link:to_link])
            at, at_link = upto, to_link

    def rows(self, texts: list[str | None]) -> Iterator[tuple]:
        """One tuple of ALIGNED per text."""
        kept = self.kept
        if len(kept) > KEPT_STRETCHES:
            kept.clear()
        split = [self.stretches(t) if t else [] for t in texts]
        self.align({w for s in split for w in s if w not in kept})
        for s in split:
            found = [kept[w] for w in s]
            if not found or None in found:
                yield 0, 0, 0, 0, "", b""
                continue
            groups, n_a, n_b, n_groups, links = zip(*found)
            links = b"".join(links)
            yield sum(n_a), sum(n_b), sum(n_groups), len(links) // self.code.itemsize, "".join(groups)[:-1], links
        for w in [w for s in split for w in s if len(w) > KEPT_LENGTH]:
            kept.pop(w, None)


def code_type(size_a: int, size_b: int) -> np.dtype:
    return np.dtype("<u4") if size_a * size_b <= 2**32 else np.dtype("<u8")


@functools.lru_cache(maxsize=1)
def pair_of(byte_bpe: str, piece_bpe: str) -> Pair:
    return Pair(byte_bpe, piece_bpe)


def _chunks(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` in size; at least one item each."""
    first = total = n = 0
    for n, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield first, n
            first, total = n, 0
    if first < n:
        yield first, n


def align(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """Per row: doc_id, the numbers of tokens of either side, of groups and of links, ``groups`` as ``a1,a2|b1;a3|b2``
    (ids in text order), and ``links``: the codes A id * vocabulary of B + B id, packed little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_bpe, piece_bpe)
        kinds = [pa.int64()] * 4 + [pa.large_string(), pa.large_binary()]
        with no_cycle_collection():
            for batch in batches:
                ids, texts = batch.column(0), batch.column(1).to_pylist()
                for lo, hi in _chunks((len(t or "") for t in texts), CHUNK_CHARS):
                    columns = [pa.array(c, t) for c, t in zip(zip(*pair.rows(texts[lo:hi])), kinds)]
                    names = ["doc_id", *(f.split(" ")[0] for f in ALIGNED.split(", "))]
                    yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *columns], names=names)

    docs = documents.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, {ALIGNED}")


def _codes(column: pa.Array, lo: int, hi: int, code: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.slice(lo, hi - lo).to_pylist()), dtype=code)


def pair_counts(aligned: DataFrame, size_b: int, code: np.dtype) -> DataFrame:
    """Per linked id pair: ``code``, the number ``n`` of links that hold it, and whether none with the same B id has more (``best``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, dtype=code), np.zeros(0, dtype=np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            for lo, hi in _chunks(batch.column(1).to_pylist(), CHUNK_LINKS):
                new, n = np.unique(_codes(batch.column(0), lo, hi, code), return_counts=True)
                pairs, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
                merged = np.zeros(len(pairs), dtype=np.int64)
                np.add.at(merged, place, np.concatenate([counts, n]))
                counts = merged
                if len(pairs) > MERGED_PAIRS:
                    yield rows()
                    pairs, counts = pairs[:0], counts[:0]
        yield rows()

    counts = aligned.select("links", "n_links").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = counts.select("code", "n", (F.col("code") % size_b).alias("b"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent_from(counts: DataFrame, most: int = HOT_PAIRS) -> int:
    """The smallest power of two from which on at most ``most`` pairs have as large a count."""
    floor = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    histogram = counts.groupBy(floor.alias("e")).agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("e")).collect()  # 63 rows at most
    found, least = 0, 62
    for r in histogram:
        found += r.pairs
        if found > most:
            break
        least = r.e
    return 1 << least


def link_support(documents: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (SHA-256 of the groups as ``align`` writes them; '' without tokens),
    n_best (links whose pair is the most counted of its B id) and count_sum (counts of the links' pairs, summed)."""
    pair = pair_of(byte_bpe, piece_bpe)
    size_b, code = pair.size_b, pair.code
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    aligned = align(documents, byte_bpe, piece_bpe).withColumn("groups_sha256", digest).drop("groups")
    aligned = stash(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned", codec="zstd")
    counts = stash(pair_counts(aligned, size_b, code), "pair-counts")
    least = frequent_from(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toPandas().sort_values("code")  # at most hot_pairs rows
    hot_code, hot_n, hot_best = hot["code"].to_numpy(dtype=code), hot["n"].to_numpy(dtype=np.int64), hot["best"].to_numpy(dtype=bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_links = batch.column(0).to_numpy()
            for lo, hi in _chunks(n_links.tolist(), CHUNK_LINKS):
                distinct, place = np.unique(_codes(batch.column(1), lo, hi, code), return_inverse=True)
                at = np.searchsorted(hot_code, distinct)
                known = np.zeros(len(distinct), dtype=bool)
                known[at < len(hot_code)] = hot_code[at[at < len(hot_code)]] == distinct[at < len(hot_code)]
                n, best = np.zeros((2, len(distinct)), dtype=np.int64)
                n[known], best[known] = hot_n[at[known]], hot_best[at[known]]
                bounds = np.concatenate([[0], np.cumsum(n_links[lo:hi])])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x[place])])[bounds]) for x in (best, n)]
                rare = np.flatnonzero(~known[place])
                doc = np.searchsorted(bounds, rare, side="right") - 1
                seen, times = np.unique(doc * max(len(distinct), 1) + place[rare], return_counts=True)
                of, what = np.divmod(seen, max(len(distinct), 1))
                offsets = pa.array(np.searchsorted(of, np.arange(hi - lo + 1)).astype(np.int32))
                rest = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (distinct[what].astype(np.int64), times.astype(np.int64))]
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x) for x in sums), *rest], names=names)

    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    table = aligned.select("n_links", "links", *own, F.col("n_links").alias("links_in_row"))
    names = [*own, "n_links", "n_best", "count_sum", "codes", "times"]
    fields = ", ".join(f"{f} {aligned.schema[f].dataType.simpleString()}" for f in own)
    scored = stash(
        table.mapInArrow(run, f"{fields}, n_links long, n_best long, count_sum long, codes array<long>, times array<long>"), "scored"
    )
    rest = scored.where(F.size("codes") > 0).select("row", F.explode(F.arrays_zip("codes", "times")).alias("x"))
    rest = rest.select("row", F.col("x.codes").alias("code"), F.col("x.times").alias("times"))
    rest = rest.join(counts.where(F.col("n") < least), "code").groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_count")
    )
    return scored.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
