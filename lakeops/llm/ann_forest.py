"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree hashes a vector to a long string of symbols; a symbol is the axis (with its
sign) that the vector is nearest to after a random rotation. Vectors that share a
long prefix are likely near. A query descends every tree along its own string and
ascends all trees at once, symbol by symbol, until the prefixes it shares there hold
``min_candidates`` entries; at that depth it also visits, in each tree, the prefixes that come next
for it: those whose symbols, at any place, are together the least farther than its own. Deeper
prefixes hold less of the table, so their number grows with the depth (``_width``). All vectors in
those prefixes are compared with the query on the original vectors in double precision.

The sorted arrays of the trees are (tree, prefix) groups of the shuffle. How many vectors a
prefix holds is counted first, at every depth, with grouped counts; so the depth of every
query is known before any vector moves, a crowded prefix is split into parts of
``PART_ROWS`` vectors that its queries all visit, and only prefixes that some query visits
are shuffled. Tasks work on bundles of parts and return the best of each part; nothing is
capped. Of vectors that are equal, only the ``k + 1`` smallest ids can appear in any
result, so only those are entered, and queries with equal vectors are searched once.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and
rows with a null id, take no part; vectors of different lengths are never compared; repeated
rows count once; with few vectors every query ascends to the root and sees them all; equal
distances go to the smaller id. Columns other than the id and the vector are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import stash

TREES = 24
SYMBOLS = 6
PROBES = 3
MIN_CANDIDATES = 1000
PART_ROWS = 1024
BUNDLE_ROWS = 16_384
BEAM_ROWS = 64
SEED = 7


@functools.lru_cache(maxsize=64)
def _rotation(dim: int, tree: int, depth: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, tree, depth]).normal(size=(dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _bits(dim: int) -> int:
    return max(1, (2 * dim - 1).bit_length())


def _symbols(dim: int) -> int:
    return max(1, min(SYMBOLS, 62 // _bits(dim)))


def _symbol(x: np.ndarray, tree: int, depth: int, seed: int) -> np.ndarray:
    """The symbol nearest to each row of ``x``."""
    y = x @ _rotation(x.shape[1], tree, depth, seed)
    return np.argmax(np.concatenate([y, -y], axis=1), axis=1)


def _width(dim: int, depth: int, probes: int) -> int:
    """How many prefixes a query visits in each tree at ``depth``: what keeps recall where one level holds 2 * dim times less."""
    return probes if depth < 2 else probes * max(1, dim // 2) * (1 if depth == 2 else 4)


def _nearest_prefixes(x: np.ndarray, tree: int, depth: int, seed: int, n: int) -> np.ndarray:
    """The ``n`` prefixes of ``depth`` symbols nearest to each row of ``x``, its own among them."""
    dim, blocks = x.shape[1], []
    for start in range(0, len(x), BEAM_ROWS):
        rows = x[start : start + BEAM_ROWS]
        prefix, loss = np.zeros((len(rows), 1), np.int64), np.zeros((len(rows), 1), np.float32)
        for level in range(depth):
            y = rows @ _rotation(dim, tree, level, seed)
            y = np.concatenate([y, -y], axis=1)
            order = np.argsort(-y, axis=1, kind="stable")[:, :n]
            near = np.take_along_axis(y, order, axis=1)
            loss = (loss[:, :, None] + ((near[:, :1] - near) ** 2)[:, None, :]).reshape(len(rows), -1)
            prefix = ((prefix[:, :, None] << _bits(dim)) | order[:, None, :]).reshape(len(rows), -1)
            if loss.shape[1] > n:
                best = np.argpartition(loss, n - 1, axis=1)[:, :n]
                loss, prefix = np.take_along_axis(loss, best, axis=1), np.take_along_axis(prefix, best, axis=1)
        blocks.append(prefix)
    return np.concatenate(blocks)


def _strings(x: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """The hash string of every row in every tree, as a long with the first symbol highest."""
    dim, out = x.shape[1], np.zeros((len(x), trees), np.int64)
    for tree in range(trees):
        for depth in range(_symbols(dim)):
            out[:, tree] = (out[:, tree] << _bits(dim)) | _symbol(x, tree, depth, seed)
    return out


def _by_length(vectors) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield at, np.stack([np.asarray(vectors[i], np.float64) for i in at])


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _hashed(vectors: DataFrame, trees: int, seed: int) -> DataFrame:
    """``vectors`` (id, v) with their length and the hash strings of all trees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            strings = np.zeros((len(rows), trees), np.int64)
            for at, x in _by_length(rows["v"].tolist()):
                strings[at] = _strings(x.astype(np.float32), trees, seed)
            yield rows.assign(dim=rows["v"].map(len).astype("int32"), strings=list(strings))

    return vectors.mapInPandas(run, f"id long, v {vectors.schema['v'].dataType.simpleString()}, dim int, strings array<bigint>")


def _prefixes(hashed: DataFrame, *keep: str) -> DataFrame:
    """One row per tree: ``keep``, dim, tree and the whole string as ``prefix`` at full ``depth``."""
    return hashed.select(*keep, "dim", F.posexplode("strings").alias("tree", "prefix"))


def _depths(dims: list[int]) -> list[tuple[int, int]]:
    return [(dim, depth) for dim in dims for depth in range(_symbols(dim), 0, -1)]


def _at_depth(prefix: Column, dim: int, depth: int) -> Column:
    return F.shiftright(prefix, _bits(dim) * (_symbols(dim) - depth))


def _counts(hashed: DataFrame, dims: list[int]) -> DataFrame:
    """(dim, tree, depth, prefix, n): vectors under every prefix, each depth summed from the one below."""
    whole = stash(_prefixes(hashed).groupBy("dim", "tree", "prefix").agg(F.count("*").alias("n")), "ann-counts")
    parts = [
        whole.filter(F.col("dim") == dim)
        .groupBy("dim", "tree", F.lit(depth).alias("depth"), _at_depth(F.col("prefix"), dim, depth).alias("prefix"))
        .agg(F.sum("n").alias("n"))
        for dim, depth in _depths(dims)
    ]
    return functools.reduce(DataFrame.union, parts)


def _visits(queries: DataFrame, trees: int, probes: int, seed: int) -> DataFrame:
    """(id, dim, tree, depth, prefix) for every prefix a query (id, v, dim, depth) visits."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for key, group in rows.groupby(["dim", "depth"]):
                dim, depth = map(int, key)
                ids = group["id"].to_numpy()
                if depth == 0:
                    yield pd.DataFrame({"id": ids, "dim": dim, "tree": 0, "depth": 0, "prefix": 0})
                    continue
                x = np.stack([np.asarray(v, np.float32) for v in group["v"]])
                for tree in range(trees):
                    near = _nearest_prefixes(x, tree, depth, seed, _width(dim, depth, probes))
                    at = np.repeat(ids, near.shape[1])
                    yield pd.DataFrame({"id": at, "dim": dim, "tree": tree, "depth": depth, "prefix": near.ravel()})

    return queries.mapInPandas(run, "id long, dim int, tree int, depth int, prefix long")


def _nearest(k: int):
    """Per bundle: the ``k`` nearest entries of each part to each query that visits it."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        keys = ["dim", "tree", "depth", "prefix", "part"]
        if rows["is_query"].any() and not rows["is_query"].all():
            for _, part in rows.groupby(keys, sort=False):
                asked, held = part[part["is_query"]], part[~part["is_query"]]
                if asked.empty or held.empty:
                    continue
                ids = held["id"].to_numpy()
                x = np.stack([np.asarray(v, np.float64) for v in held["v"]])
                for query, v in zip(asked["id"].to_numpy(), asked["v"]):
                    off = x - np.asarray(v, np.float64)
                    distance = np.sqrt(np.einsum("ij,ij->i", off, off))
                    if len(ids) > k:  # all entries up to the k-th distance, so that ties are settled by id
                        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
                    else:
                        near = np.arange(len(ids))
                    near = near[np.lexsort((ids[near], distance[near]))][:k]
                    out.append(pd.DataFrame({"query": query, "id": ids[near], "score": distance[near]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "id": [], "score": []})

    return run


def search(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    trees: int = TREES, probes: int = PROBES, min_candidates: int = MIN_CANDIDATES, seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for each row that ``is_query`` selects."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    equal = Window.partitionBy("v").orderBy("id")
    entered = rows.select("id", "v").withColumn("r", F.dense_rank().over(equal)).filter(F.col("r") <= k + 1)
    entered = entered.select("id", "v").distinct()
    hashed = stash(_hashed(entered, trees, seed), "ann-hashed")
    dims = sorted(r["dim"] for r in hashed.select("dim").distinct().collect())
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    asked = rows.filter("asked").select("id", "v").distinct()
    first = asked.groupBy("v").agg(F.min("id").alias("id"))
    same = stash(asked.select(F.col("id").alias("query_id"), "v").join(first, "v").select("query_id", F.col("id").alias("query")), "ann-same")
    queries = stash(_hashed(first.select("id", "v"), trees, seed), "ann-queries")
    counts = stash(_counts(hashed, dims), "ann-depths")
    own = functools.reduce(DataFrame.union, [
        _prefixes(queries, "id").filter(F.col("dim") == dim)
        .select("id", "dim", "tree", F.lit(depth).alias("depth"), _at_depth(F.col("prefix"), dim, depth).alias("prefix"))
        for dim, depth in _depths(dims)
    ])
    found = own.join(counts, ["dim", "tree", "depth", "prefix"]).groupBy("id", "depth").agg(F.sum("n").alias("n"))
    depth = found.filter(F.col("n") >= min_candidates).groupBy("id").agg(F.max("depth").alias("depth"))
    queries = queries.join(depth, "id", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))

    root = hashed.groupBy("dim").agg(F.count("*").alias("n")).select(
        "dim", F.lit(0).alias("tree"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"), "n"
    )
    visits = stash(_visits(queries.select("id", "v", "dim", "depth"), trees, probes, seed), "ann-visits")
    keys = ["dim", "tree", "depth", "prefix"]
    sizes = counts.union(root).join(visits.select(*keys).distinct(), keys, "left_semi")
    sizes = stash(sizes.withColumn("parts", F.ceil(F.col("n") / PART_ROWS).cast("int")), "ann-sizes")
    used = {(r["dim"], r["depth"]) for r in sizes.select("dim", "depth").distinct().collect()}
    moved = sizes.agg(F.sum("n")).first()[0] or 0
    bundles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-moved // BUNDLE_ROWS))

    # every vector under its prefixes at the depths in use; at the root it stands once, under tree 0
    at = F.explode(F.array(*[F.lit(d) for d in sorted({depth for _, depth in used})])).alias("depth")
    entries = _prefixes(hashed, "id", "v").select("id", "v", "dim", "tree", "prefix", at)
    entries = entries.filter((F.col("depth") > 0) | (F.col("tree") == 0))
    shift = functools.reduce(
        lambda c, dim: c.when(F.col("dim") == dim, _bits(dim) * (_symbols(dim) - F.col("depth"))), dims, F.when(F.lit(False), 0)
    )
    prefix = F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.call_function("shiftright", F.col("prefix"), shift))
    entries = entries.withColumn("prefix", prefix.cast("long")).join(sizes, keys)
    entries = entries.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    visits = visits.join(sizes, keys).join(queries.select("id", "v"), "id").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["id", "v", *keys, "part"]
    both = entries.select(*columns, F.lit(False).alias("is_query")).union(visits.select(*columns, F.lit(True).alias("is_query")))
    bundle = F.pmod(F.xxhash64(*keys, "part"), F.lit(bundles))
    best = both.withColumn("bundle", bundle).groupBy("bundle").applyInPandas(_nearest(k + 1), "query long, id long, score double")

    best = best.groupBy("query", "id").agg(F.min("score").alias("score"))
    ranked = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    best = stash(best.withColumn("r", ranked).filter(F.col("r") <= k + 1).drop("r"), "ann-best")
    out = same.join(best, "query").filter(F.col("id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"
    )
