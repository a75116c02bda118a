"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source has a target number of words. It is met by whole passes over the
source (epochs) and one partial pass. A source's documents are dealt into blocks
by a keyed hash; the exact number of blocks drawn from each source is split down
a binary tree of output shards, each split a multivariate hypergeometric draw,
so a shard holds what a uniform draw without replacement would give it. Each
shard then takes its own, disjoint run of the source's permuted blocks and
orders the documents in it by another keyed hash.

All of it is DataFrame expressions. Per-document work is one join with the block
table on (source, block); a source of any size is spread over its blocks, and
the only ordered sums run over blocks (at most ``max_blocks`` in total) and over
the documents of one block per source.

Edge cases: a null text has size 0; a null source is a source of its own and
sorts last; a null ``doc_id`` is hashed as the empty string; rows with the same
``doc_id`` get the same draws; a source of size 0 has target 0 and its documents
are not drawn; an empty table gives an empty result. Columns other than
``doc_id``, ``text`` and ``source`` are carried but never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import count_words, stash

SEED = "mix-1"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
BLOCK_WORDS = 50_000
MAX_BLOCKS = 1 << 20
SHARD_WORDS = 4_000_000
SETTLE_STEPS = 3


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s:"), source), F.lit("n"))


def _doc_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _block(key: Column, n_blocks: Column) -> Column:
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % n_blocks


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(skey, idx, source_size, target) per source: weights repeat over the sources
    in code-point order, null last; no target exceeds ``max_repeats`` source sizes.

    Sorted by the level at which a source fills up, the words per weight left for the
    sources from the k-th on grow with k as long as the k-th fills up, and shrink
    after. Their maximum is the level at which repeated resharing of the excess ends.
    """
    per = sized.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    per = per.withColumn("idx", F.row_number().over(order) - 1).withColumn("w", w)
    limit = F.col("source_size") * F.lit(float(max_repeats))
    filled = Window.orderBy(limit / F.col("w"), "idx")
    before, everyone = filled.rowsBetween(Window.unboundedPreceding, -1), Window.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left_words = F.sum("source_size").over(everyone) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    left_weight = F.sum("w").over(everyone) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("level", left_words / left_weight).withColumn("level", F.max("level").over(everyone))
    return per.select("skey", "idx", "source_size", F.least(limit, F.col("level") * F.col("w")).alias("target"))


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    stirling = (
        x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
        + 1 / (1260 * x * x * x * x * x)
    )
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(stirling)


def _hypergeometric(total: Column, good: Column, drawn: Column, u: Column) -> Column:
    """Inverse-CDF draw of the number of ``good`` items among ``drawn`` of ``total``.

    The CDF is summed over the support within 13 standard deviations of the mean:
    what lies outside is below the resolution of a double.
    """
    total, good, drawn = (c.cast("long") for c in (total, good, drawn))
    mean = drawn.cast("double") * good / F.greatest(total, F.lit(1))
    sd = F.sqrt(
        mean * (total - good) / F.greatest(total, F.lit(1)) * (total - drawn) / F.greatest(total - 1, F.lit(1))
    )
    lowest, highest = F.greatest(F.lit(0).cast("long"), drawn - (total - good)), F.least(drawn, good)
    lo = F.greatest(lowest, F.floor(mean - 13 * sd - 13).cast("long"))
    hi = F.greatest(lo, F.least(highest, F.ceil(mean + 13 * sd + 13).cast("long")))

    def choose(n: Column, k: Column) -> Column:
        return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)

    base = choose(total, drawn)

    def add(acc: Column, x: Column) -> Column:
        cdf = acc["cdf"] + F.exp(choose(good, x) + choose(total - good, drawn - x) - base)
        return F.struct(cdf.alias("cdf"), F.when(acc["cdf"] < u, x).otherwise(acc["pick"]).alias("pick"))

    return F.aggregate(
        F.sequence(lo, hi), F.struct(F.lit(0.0).alias("cdf"), lo.alias("pick")), add, lambda acc: acc["pick"]
    )


def split_quotas(sources: DataFrame, levels: int, seed: str = SEED) -> DataFrame:
    """(shard, idx, quota): block quotas of ``sources`` (idx, quota) split over 2**levels shards.

    The state is one row per tree node with the quotas of all sources; a level
    draws each node's left half source by source, conditioned on what the sources
    before it took, and gives the rest to the right half.
    """
    nodes = sources.agg(F.array_sort(F.collect_list(F.struct("idx", "quota"))).alias("q")).select(
        F.lit(0).cast("long").alias("node"), "q"
    )
    for level in range(levels):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        uniform = lambda x: (
            F.conv(
                F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit(f"split{level}"), F.col("node"), x["idx"])), 1, 13),
                16, 10,
            ).cast("double") + 0.5
        ) / float(1 << 52)

        def take(acc, x):
            got = _hypergeometric(acc["n"], x["quota"], acc["m"], uniform(x))  # noqa: B023
            return F.struct(
                (acc["n"] - x["quota"]).alias("n"), (acc["m"] - got).alias("m"),
                F.concat(acc["left"], F.array(got)).alias("left"),
            )

        start = F.struct(
            F.col("n"), F.floor((F.col("n") + F.col("node") % 2) / 2).cast("long").alias("m"),
            F.array().cast("array<bigint>").alias("left"),
        )
        nodes = nodes.withColumn("n", total).withColumn("left", F.aggregate("q", start, take, lambda a: a["left"]))
        side = lambda f: F.zip_with(
            "q", "left", lambda x, l: F.struct(x["idx"].alias("idx"), f(x, l).alias("quota"))
        )
        nodes = nodes.select(
            F.explode(
                F.array(
                    F.struct((2 * F.col("node")).alias("node"), side(lambda x, l: l).alias("q")),
                    F.struct((2 * F.col("node") + 1).alias("node"), side(lambda x, l: x["quota"] - l).alias("q")),
                )
            ).alias("x")
        ).select("x.node", "x.q")
    return nodes.select(F.col("node").alias("shard"), F.explode("q").alias("x")).select("shard", "x.idx", "x.quota")


def _partial_pass(sized: DataFrame, blocks: DataFrame) -> DataFrame:
    """Which documents of a source's cut block belong to the partial pass.

    In key order up to the nearest document boundary; then, up to ``SETTLE_STEPS``
    times, the one document more or less that brings the source nearest to its target.
    """
    docs = (
        sized.join(blocks.filter("cut").select("skey", "block", F.col("room")), ["skey", "block"])
        .groupBy("skey", "block", "key").agg(F.sum("size").alias("size"), F.first("room").alias("room"))
    )
    upto = Window.partitionBy("skey", "block").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    docs = docs.withColumn("cum", F.sum("size").over(upto)).withColumn(
        "first", F.col("cum") - F.col("size") / 2 <= F.col("room")
    ).withColumn("inside", F.col("first"))
    whole = Window.partitionBy("skey", "block")
    for _ in range(SETTLE_STEPS):
        gap = F.col("room") - F.coalesce(F.sum(F.when(F.col("inside"), F.col("size"))).over(whole), F.lit(0))
        off = F.abs(F.abs(F.col("gap")) - F.col("size"))
        usable = (F.col("inside") == (F.col("gap") < 0)) & (off < F.abs(F.col("gap")))
        docs = docs.withColumn("gap", gap).withColumn("best", F.min(F.when(usable, F.struct(off, "key"))).over(whole)["key"])
        docs = docs.withColumn("inside", F.col("inside") != F.coalesce(F.col("key") == F.col("best"), F.lit(False)))
    return docs.groupBy("skey", "block").agg(
        F.max(F.when(F.col("first"), F.col("key"))).alias("last_key"),
        F.collect_list(F.when(F.col("inside") != F.col("first"), F.col("key"))).alias("swap_keys"),
    )


def _block_table(sized: DataFrame, sources: DataFrame, levels: int, seed: str) -> DataFrame:
    """(skey, block, draws, last_key, swap_keys): the (epoch, shard, cut) draws of every block."""
    blocks = sized.groupBy("skey", "block").agg(F.sum("size").alias("words")).join(sources, "skey")
    turn = F.md5(F.concat_ws(":", F.lit(seed), F.lit("pass"), "epochs", "skey", "block"))
    upto = Window.partitionBy("skey").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = (
        blocks.withColumn("turn", turn).withColumn("cum", F.sum("words").over(upto))
        .withColumn("room", F.col("rest") - (F.col("cum") - F.col("words")))
        .withColumn("cut", (F.col("room") > 0) & (F.col("room") < F.col("words")))
        .withColumn("passes", F.col("epochs") + F.when(F.col("room") > 0, 1).otherwise(0))
    )
    blocks = stash(blocks.select("skey", "idx", "block", "epochs", "room", "cut", "passes"), "mix-blocks")
    drawn = blocks.filter("passes > 0").select(
        "idx", "skey", "block", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))).alias("epoch"),
        (F.col("cut") & (F.col("epoch") > F.col("epochs"))).alias("cut"),
    )
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("deal"), "skey", "block", "epoch"))
    drawn = drawn.withColumn(
        "pos", F.row_number().over(Window.partitionBy("idx").orderBy(place, "block", "epoch")).cast("long")
    )
    quotas = blocks.groupBy("idx").agg(F.sum("passes").alias("quota"))
    leaves = split_quotas(quotas, levels, seed)
    run = Window.partitionBy("idx").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    leaves = leaves.withColumn("end", F.sum("quota").over(run)).filter("quota > 0").select(
        "idx", "shard", F.explode(F.sequence(F.col("end") - F.col("quota") + 1, F.col("end"))).alias("pos")
    )
    draws = (
        drawn.join(leaves, ["idx", "pos"]).groupBy("skey", "block")
        .agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "cut"))).alias("draws"))
    )
    return draws.join(_partial_pass(sized, blocks), ["skey", "block"], "left")


def _with_draws(rows: DataFrame, documents: DataFrame, seed: str, weights, block_words: int, shard_words: int) -> DataFrame:
    """``rows`` (doc, doc_id, source, size) with skey, source_size, target and the draws of each."""
    keyed = lambda df: df.withColumn("skey", _source_key(F.col("source"))).withColumn(
        "key", _doc_key(F.col("doc_id"), seed)
    )
    sized = stash(
        documents.select("doc_id", F.col("source").cast("string").alias("source"), count_words(F.col("text")).alias("size")),
        "mix-sizes",
    )
    targets = source_targets(sized.withColumn("skey", _source_key(F.col("source"))), weights)
    total = sized.agg(F.sum("size")).first()[0] or 0
    levels = max(0, math.ceil(math.log2(max(1.0, total / shard_words))))
    width = max(block_words, -(-total // MAX_BLOCKS))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = stash(
        targets.withColumn("epochs", epochs)
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
        .withColumn("n_blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / width).cast("long"))),
        "mix-sources",
    )
    dealt = lambda df: keyed(df).join(
        sources.select("skey", "n_blocks", "source_size", "target"), "skey"
    ).withColumn("block", _block(F.col("key"), F.col("n_blocks")))
    blocks = stash(
        _block_table(dealt(sized), sources.select("skey", "idx", "epochs", "rest"), levels, seed), "mix-draws"
    )
    member = (F.col("key") <= F.coalesce("last_key", F.lit(""))) != F.coalesce(
        F.array_contains("swap_keys", F.col("key")), F.lit(False)
    )
    out = dealt(sized if rows is None else rows).join(blocks, ["skey", "block"], "left")
    mine = F.filter(F.coalesce("draws", F.array().cast(blocks.schema["draws"].dataType)), lambda d: ~d["cut"] | member)
    return out.withColumn("draws", mine)


def mix_plan(
    documents: DataFrame, seed: str = SEED, weights=WEIGHTS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, draws.

    ``draws`` lists the (epoch, shard) copies of the document in the mix; ``taken``
    is its size times their number.
    """
    out = _with_draws(None, documents, seed, weights, block_words, shard_words)
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"),
        F.transform("draws", lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"))).alias("draws"),
    )


def mix(
    documents: DataFrame, seed: str = SEED, weights=WEIGHTS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """The mix itself: the columns of ``documents``, one row per drawn copy, the rows of a
    shard together and in a keyed random order."""
    rows = documents.select(
        F.struct("*").alias("doc"), "doc_id", F.col("source").cast("string").alias("source"), F.lit(None).cast("long").alias("size")
    )
    out = _with_draws(rows, documents, seed, weights, block_words, shard_words)
    out = out.select("doc", "key", F.explode("draws").alias("draw")).select("doc", "key", "draw.shard", "draw.epoch")
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), "epoch", "key"))
    out = out.withColumn("order", order).repartition("shard").sortWithinPartitions("shard", "order")
    return out.select("doc.*")
