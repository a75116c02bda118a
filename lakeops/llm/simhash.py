"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit where more than half of the text's shingle hashes have it.
Fingerprints within two bits link. Split into two halves of 32 bits, such a pair
differs by at most one bit in the first half or not at all in the second. So every
distinct fingerprint is entered in one table per half, looks up the small Hamming
ball around its first half (itself and each one-bit change) and its own second half,
and the full distance of what the tables return is verified.

Copies cost nothing: tables and links hold distinct fingerprints only, joined
back to documents at the end. A table entry that very many fingerprints meet in
(near copies that agree in a whole half) is not paired up. Its fingerprints go
through their one-bit neighbours in all 64 bits instead: two fingerprints within
two bits share one, and two that share one are within two bits, so linking each to
the smallest fingerprint at a neighbour finds the same components in linear work.

Components come from alternating large-star and small-star rounds over the links;
each round is written to the shared folder, so a lost executor never costs more
than the round it was in. Nothing is collected but counts.

Edge cases: null, empty and blank texts have fingerprint zero and link like any
other; a text with fewer words than a shingle is one shingle; rows with a null
``doc_id`` link and get the smallest id reachable, null if there is none; rows that
repeat a ``doc_id`` are one document to ``near_duplicates`` and ``drop_near_duplicates``
keeps one of them. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stash, text_or_empty

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
PAIRED_BUCKET = 64  # fingerprints met in a table entry; fuller ones go by neighbours
HALF = 32


def _text_fingerprint(text: str, width: int) -> int:
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: A-Z and \t\n\v\f\r and space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    first = np.concatenate(([0], ends[: len(last) - 1] + 1))
    hashes = np.fromiter(
        [xxh64_intdigest(line[a:b], SEED) for a, b in zip(first.tolist(), last.tolist())], np.uint64, len(last)
    )
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[part : part + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8").astype(np.int64)[0])


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """SimHash of a string column as a long with the 64 bits."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_text_fingerprint(t or "", shingle_words) for t in texts], dtype="int64")

    return run(text_or_empty(text))


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _flip(value: Column, bits) -> Column:
    return F.transform(bits, lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def _keys(fps: DataFrame) -> DataFrame:
    """(half, value, fp, entry): the two table entries of a fingerprint and its lookups.

    A change of one bit in the first half is looked up from the side that has the
    bit clear, so each such pair is met once.
    """
    low_mask = F.lit((1 << HALF) - 1).cast("long")
    first, second = F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(low_mask)
    clear = F.filter(F.sequence(F.lit(0), F.lit(HALF - 1)), lambda i: F.getbit(first, i) == 0)
    key = lambda half, value, entry: F.struct(
        F.lit(half).alias("half"), value.alias("value"), F.lit(entry).alias("entry")
    )
    keys = F.concat(
        F.array(key(0, first, True), key(1, second, True)),
        F.transform(_flip(first, clear), lambda v: key(0, v, False)),
    )
    return fps.select("fp", F.explode(keys).alias("k")).select("k.half", "k.value", "fp", "k.entry")


def links(fps: DataFrame) -> DataFrame:
    """(a, b): links whose connected components are those of all pairs of distinct
    fingerprints ``fps`` (fp) within two bits. Every link is itself within two bits."""
    keys = _keys(fps)
    met = (
        keys.groupBy("half", "value").agg(F.count("*").alias("n"), F.sum(F.col("entry").cast("long")).alias("entries"))
        .filter("entries > 0 and n > 1").select("half", "value", "n")
    )
    keys = stash(keys.join(met, ["half", "value"]), "simhash-met")
    paired = keys.filter(F.col("n") <= PAIRED_BUCKET).select("half", "value", "fp", "entry")
    entries = paired.filter("entry").select("half", "value", F.col("fp").alias("b"))
    pairs = (
        paired.join(entries, ["half", "value"])
        .filter((F.col("fp") < F.col("b")) | (~F.col("entry") & (F.col("fp") != F.col("b"))))
        .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE)
        .select(F.col("fp").alias("a"), "b")
    )
    crowded = keys.filter(F.col("n") > PAIRED_BUCKET).select("fp").distinct()
    near = F.concat(F.array("fp"), _flip(F.col("fp"), F.sequence(F.lit(0), F.lit(63))))
    around = crowded.select("fp", F.explode(near).alias("key"))
    hub = around.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("key", "b")
    stars = around.join(hub, "key").filter(F.col("fp") != F.col("b")).select(F.col("fp").alias("a"), "b")
    return pairs.union(stars).distinct()


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One star round over (a, b): each node's neighbours are linked to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger_only:  # large star: all neighbours, but only the larger ones move
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # small star: smaller neighbours and the node itself move
        down = both.filter(F.col("b") < F.col("a"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.union(least.select("a", F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component, by alternating stars."""
    edges, before = stash(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = stash(_star(_star(edges, True), False), "star")


def near_duplicates(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (long) and component_id per row of ``documents`` (doc_id, text)."""
    docs = stash(documents.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("fp")), "simhash-docs")
    fps = stash(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(links(fps.select("fp")))
    fps = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = fps.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = stash(fps.join(ids, "root").select("fp", "component_id"), "simhash-ids")
    return docs.join(ids, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``documents`` with one row per component: the one with its smallest ``doc_id``."""
    found = stash(near_duplicates(documents, shingle_words), "simhash-groups")
    first = found.groupBy("component_id").agg(
        F.sum((F.col("doc_id").eqNullSafe(F.col("component_id"))).cast("long")).alias("n"), F.min("fp").alias("fp")
    )
    named = first.filter("component_id is not null")
    rows = documents.select(F.struct("*").alias("doc"), F.col("doc_id").alias("own_id"))
    once = rows.join(named.filter("n = 1"), F.col("own_id") == F.col("component_id"), "left_semi")
    # rows that repeat the smallest id, and those of null ids: the one that is smallest by content
    content = F.struct(F.xxhash64("doc.*"), F.to_json("doc"))
    twice = rows.join(named.filter("n > 1"), F.col("own_id") == F.col("component_id"), "left_semi")
    twice = twice.groupBy("own_id").agg(F.min_by("doc", content).alias("doc")).select("doc")
    out = once.select("doc").union(twice)
    if first.filter("component_id is null").isEmpty():
        return out.select("doc.*")
    unnamed = found.filter("component_id is null").select("fp").distinct()
    lost = rows.filter("own_id is null").withColumn("fp", fingerprint(F.col("doc.text"), shingle_words))
    fps = stash(unnamed, "simhash-unnamed")
    roots = components(links(fps))
    grouped = lost.join(fps, "fp").join(roots, F.col("fp") == F.col("node"), "left")
    grouped = grouped.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min_by("doc", content).alias("doc"))
    return out.union(grouped.select("doc")).select("doc.*")
