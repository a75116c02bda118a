"""Embedding whitening from exact bit-sliced cross-products.

Each component c of a vector becomes the integer x = floor(64 c) + 1000000. The distinct x vectors (each once) are the fit
list. Per dimension the smallest x is taken off and the rest cut into bit planes; a plane's bits of 64 rows fill one
word. The popcount of the AND of two planes, weighted by both planes' places, adds up to the exact cross-product of two
dimensions. Tasks sum over their rows; Spark adds the sums; the driver gets one matrix (dims x dims). It is centred as integers
(n * cross-products - products of sums) before the first floating-point operation, then decomposed by ``eigh``.

Cross-products travel as limbs of 31 bits, so sums stay exact integers at any number of rows and any range of values.

Edge cases: vectors that are null, hold null or non-finite entries, or entries whose x is no 64-bit integer take no part; so do
empty vectors and those of another length than the most frequent one (of equally frequent ones the longest). Repeated rows and
ids each get their rows. A component without variance (copies of one vector, fewer distinct vectors than dimensions) has no scale: ``whitened`` is null
for it and it is left out of ``identity_error``. An empty table gives no rows. Other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stash

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCK_ROWS = 16_384  # rows whose planes are packed together, a multiple of 64
TILE_PLANES = 512  # planes compared with planes at a time
LIMB = 31
LARGEST = float(2**63 - 2**53)  # beyond it floor(64 c) + 1000000 need not be a 64-bit integer
DEVIATION = "decimal(38,0)"


def integer_vector(vector: Column) -> Column:
    """The x vector (array<long>), or null where the vector takes no part."""
    scaled = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < LARGEST)
    usable = (F.size(vector) > 0) & F.forall(vector, fits)
    return F.when(usable, F.transform(scaled, lambda v: v.cast("long") + SHIFT))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def pack_planes(values: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative columns (rows x dims, uint64), packed 64 rows a word: the planes, and of
    each the dimension and the place of its bit."""
    rows = values.shape[0]
    pad = -rows % 64
    dims = np.repeat(np.arange(len(bits)), bits)
    places = np.concatenate([np.arange(b) for b in bits]) if len(dims) else np.zeros(0, dtype=np.int64)
    planes = np.zeros((len(dims), rows + pad), dtype=np.uint8)
    columns = np.ascontiguousarray(values.T)
    for p, (d, b) in enumerate(zip(dims.tolist(), places.tolist())):
        planes[p, :rows] = (columns[d] >> np.uint64(b)) & np.uint64(1)
    return np.packbits(planes, axis=1).view(np.uint64), dims, places


def cross_products(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """Exact sums over the rows of the products of every two columns, as Python integers (dims x dims)."""
    words, dims, places = pack_planes(values, bits)
    out = np.zeros((len(bits), len(bits)), dtype=object)
    weight = np.array([1 << int(b) for b in places], dtype=object)
    for lo in range(0, len(dims), TILE_PLANES):
        left = slice(lo, lo + TILE_PLANES)
        for lo2 in range(lo, len(dims), TILE_PLANES):
            right = slice(lo2, lo2 + TILE_PLANES)
            counts = np.stack([np.bitwise_count(words[right] & one).sum(axis=1, dtype=np.int64) for one in words[left]])
            width = int(places[left].max()) + int(places[right].max()) + 2 * TILE_PLANES.bit_length() + values.shape[0].bit_length()
            weigh = weight.astype(np.int64) if width < 62 else weight
            counts = counts * weigh[left][:, None] * weigh[right][None, :]
            first, at = np.unique(dims[left], return_index=True)
            second, at2 = np.unique(dims[right], return_index=True)
            sums = np.add.reduceat(np.add.reduceat(counts, at, axis=0), at2, axis=1).astype(object)
            out[np.ix_(first, second)] += sums
            if lo2 > lo:
                out[np.ix_(second, first)] += sums.T
    return out


def _limbs(total: int) -> list[int]:
    out = []
    while total:
        out.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return out


def scatter(fit: DataFrame, low: list[int], bits: list[int]) -> tuple[list[int], np.ndarray]:
    """Sums and cross-products of the columns of ``fit`` (x) above ``low``, as Python integers."""
    d = len(low)
    base = np.array([v & (2**64 - 1) for v in low], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((d, d), dtype=object), np.zeros(d, dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                # differences of 64-bit integers, below 2**64: exact modulo 2**64
                values = _matrix(batch.column(0).slice(at, BLOCK_ROWS)).astype(np.uint64) - base
                total += cross_products(values, bits)
                high, rest = (values >> np.uint64(32)).sum(axis=0), (values & np.uint64(2**32 - 1)).sum(axis=0)
                sums += high.astype(object) * 2**32 + rest.astype(object)
        i, j = np.triu_indices(d)
        found = [(a, b, k, v) for a, b, t in zip(i.tolist(), j.tolist(), total[i, j]) for k, v in enumerate(_limbs(int(t)))]
        found += [(-1, a, k, v) for a, t in enumerate(sums) for k, v in enumerate(_limbs(int(t)))]
        columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], [], []))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "limb", "v"])

    parts = fit.mapInArrow(run, "i long, j long, limb long, v long").groupBy("i", "j", "limb").agg(F.sum("v").alias("v"))
    sums, cross = [0] * d, np.zeros((d, d), dtype=object)
    for r in parts.toLocalIterator():  # one matrix of the dimensions, whatever the number of rows
        if r.i < 0:
            sums[r.j] += r.v << (LIMB * r.limb)
        else:
            cross[r.i, r.j] += r.v << (LIMB * r.limb)
    return sums, np.triu(cross) + np.triu(cross, 1).T


@dataclass(frozen=True)
class Whitening:
    n: int  # distinct vectors
    sums: list[int]  # S, per dimension
    low: list[int]
    high: list[int]
    values: np.ndarray  # eigenvalues kept, falling; 0 where there is no variance
    vectors: np.ndarray  # their unit eigenvectors, as columns
    trace: float


def fit_whitening(fit: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """Eigenvectors of the exact covariance of the rows of ``fit`` (x: array<long> of ``dims`` entries, all distinct)."""
    at = F.posexplode("x").alias("i", "v")
    ranges = fit.select(at).groupBy("i").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
    found = ranges.orderBy("i").collect()  # one row per dimension
    if not found:
        return None
    n, low, high = found[0].n, [r.low for r in found], [r.high for r in found]
    sums, cross = scatter(fit, low, [(b - a).bit_length() for a, b in zip(low, high)])
    above = np.array(sums, dtype=object)
    centred = cross * n - np.outer(above, above)  # n^2 times the covariance, exact
    largest = max((abs(int(v)) for v in centred.diagonal()), default=0)
    power = max(0, largest.bit_length() - 900)  # keeps the division below inside the double range
    as_double = np.array([[int(v) / (n * n << power) for v in row] for row in centred])
    values, vectors = np.linalg.eigh(as_double)
    values, vectors = values[::-1], vectors[:, ::-1]
    values = np.where(values > dims * np.finfo(float).eps * max(values[0], 0.0), values, 0.0) * 2.0**power
    trace = sum(int(v) for v in centred.diagonal()) / (n * n)
    k = min(components, dims)
    return Whitening(n, [s + n * a for s, a in zip(sums, low)], low, high, values[:k].copy(), vectors[:, :k].copy(), float(trace))


def centred_rows(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - S of each row: 64-bit integers where all of them fit, else Python integers."""
    reach = max(max(abs(model.n * v - s) for v in (a, b)) for a, b, s in zip(model.low, model.high, model.sums))
    exact = max(reach, max(abs(s) for s in model.sums), model.n * max(map(abs, (*model.low, *model.high)))) < 2**62
    kind = np.int64 if exact else object
    return x.astype(kind) * model.n - np.array(model.sums, dtype=kind)


def project(centred: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values (rows x components); NaN without variance."""
    deviation = (centred / model.n).astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(model.values > 0, deviation @ model.vectors / np.sqrt(model.values), np.nan)


def _deviations(centred: np.ndarray) -> pa.Array:
    if centred.dtype != object and centred.size:
        largest = int(np.abs(centred).max())
        if centred.shape[1] * largest * largest < 2**63:
            return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
    totals = (sum(int(v) ** 2 for v in row) for row in centred)
    return pa.array([t if t < 10**38 else None for t in totals], pa.decimal128(38, 0))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit rows' covariance minus the identity, over components with variance."""
    live = np.flatnonzero(model.values > 0)
    if not len(live):
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = np.zeros((len(live), len(live))), np.zeros(len(live))
        for batch in batches:
            if batch.num_rows:
                w = project(centred_rows(_matrix(batch.column(0)), model), model)[:, live]
                total += w.T @ w
                sums += w.sum(axis=0)
        rows = [(i, j, float(total[i, j])) for i in range(len(live)) for j in range(len(live))]
        rows += [(-1, j, float(s)) for j, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["i", "j", "v"])

    parts = fit.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # components squared
    cov, mean = np.zeros((len(live), len(live))), np.zeros(len(live))
    for r in parts:
        if r.i < 0:
            mean[r.j] = r.v / model.n
        else:
            cov[r.i, r.j] = r.v / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(len(live))).max())


def whiten(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector that takes part and component: the id, component (from 1, by falling variance), n (distinct
    vectors), deviation (exact, decimal(38,0); null from 10^38 on), whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    named = embeddings.select(F.col(id_column).alias("id"), integer_vector(F.col(vector_column)).alias("x"))
    named = named.where(F.col("x").isNotNull())
    kind = embeddings.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {kind}, component int, n long, deviation {DEVIATION}, whitened double, explained double, identity_error double"
    lengths = named.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).first()  # a few lengths
    if usual is None:
        return spark.createDataFrame([], schema)
    dims = usual.dims
    named = named.where(F.size("x") == dims)
    fit = stash(named.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit, dims, components)
    error = identity_error(fit, model)
    k = len(model.values)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = part.num_rows
                centred = centred_rows(_matrix(part.column(1)), model)
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, model.n)),
                    _deviations(centred).take(each),
                    pa.array(project(centred, model).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ], names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return named.mapInArrow(run, schema)
