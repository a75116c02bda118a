"""Incremental clustering on a Hilbert curve (K2).

Rows are placed on a curve through the cells that quantile cut points of the clustering columns make: cells next to
each other on the curve are neighbours in one column, so a file, a stretch of the curve, is narrow in all
columns. The cut points are taken once and kept beside the dataset, so later runs place new rows on the same curve.

A run rewrites only what needs it. Every file covers an interval of the curve. A sweep over the intervals' ends gives their
depth at each position; files no run has written yet (appends, updates) count as one layer, as they end up sorted
together. These files are rewritten, and with them the clustered files that reach into a stretch deeper than ``max_depth``. All other
files stay referenced as they are.

The curve has at most 65,536 cells whatever the data, so the cell table and the sweep (running sums over cells) are bounded; per-file
intervals are joined to it by cell. Inside a cell rows are ordered by the columns and a hash of the row, so hot
values spread over files. Only the layout depends on all this, never a result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, StructType

from lakeops.functions import fs
from lakeops.operators.layout import SORT_BYTES, TARGET_FILE_BYTES, _cut_points, _n_files, _sort_bytes, dataset_file_sizes
from lakeops.plans.versioned import KIND_INSERT, VersionedDataset

CELL_BITS = 16  # of a cell number, over all columns
COLUMN_BITS = 8  # of one column, at most
MAX_DEPTH = 2


def column_bits(k: int) -> int:
    if not 1 <= k <= CELL_BITS:
        raise ValueError(f"1 to {CELL_BITS} clustering columns, not {k}")
    return min(COLUMN_BITS, CELL_BITS // k)


def hilbert_positions(spark: SparkSession, k: int, bits: int) -> DataFrame:
    """(cell, position) for all cells of a k-dimensional grid of 2**bits buckets a side.

    A cell number holds the bucket of column j in bits j * bits and up. Skilling's transform: per bit plane from the top,
    coordinates are inverted or exchanged with the first one; then Gray-coded and interleaved.
    """
    cells = spark.range(2 ** (k * bits)).withColumnRenamed("id", "cell")
    coordinates = [F.shiftright("cell", j * bits).bitwiseAND(F.lit(2**bits - 1)) for j in range(k)]
    steps = F.array(*[
        F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(k)
    ])

    def step(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        inverted = F.get(x, s["i"]).bitwiseAND(s["q"]) != 0
        swap = F.get(x, F.lit(0)).bitwiseXOR(F.get(x, s["i"])).bitwiseAND(low)
        return F.transform(x, lambda v, j: F.when(inverted, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
            F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    start = F.array(*coordinates).cast("array<bigint>")
    walked = F.aggregate(steps, start, step) if bits > 1 else start
    x = [F.col("x")[j] for j in range(k)]
    gray = [reduce(lambda a, b: a.bitwiseXOR(b), x[: j + 1]) for j in range(k)]
    coded = cells.select("cell", walked.alias("x")).select("cell", *[g.alias(f"g{j}") for j, g in enumerate(gray)])
    flip = F.lit(0).cast("long")
    for b in range(bits - 1, 0, -1):
        hit = F.col(f"g{k - 1}").bitwiseAND(F.lit(1 << b)) != 0
        flip = flip.bitwiseXOR(F.when(hit, F.lit((1 << b) - 1).cast("long")).otherwise(F.lit(0).cast("long")))
    coded = coded.withColumn("flip", flip)
    position = F.lit(0).cast("long")
    for b in range(bits):
        for j in range(k):
            bit = F.shiftright(F.col(f"g{j}").bitwiseXOR(F.col("flip")), b).bitwiseAND(F.lit(1))
            position = position.bitwiseOR(F.shiftleft(bit, b * k + k - 1 - j))
    return coded.select("cell", position.alias("position"))


def _curve(ds: VersionedDataset) -> dict | None:
    """The newest stored curve: columns and their cut points as texts."""
    names = [n for n in fs.list_names(ds.spark, f"{ds.root}/_clustering") if n.endswith(".json")]
    if not names:
        return None
    newest = max(names, key=lambda n: int(n.split("-", 1)[0]))
    return json.loads(fs.read_text(ds.spark, f"{ds.root}/_clustering/{newest}")) | {"name": newest[: -len(".json")]}


def _new_curve(ds: VersionedDataset, df: DataFrame, columns: list[str], version: int) -> dict:
    for c in columns:
        if isinstance(df.schema[c].dataType, (BinaryType, MapType)):
            raise ValueError(f"cannot cluster by column {c}")
    cuts = _cut_points(df, columns, 2 ** column_bits(len(columns)) - 1, as_text=True)  # a bounded number of values a column
    curve = {"columns": columns, "cuts": cuts}
    name = f"{version}-{uuid.uuid4().hex[:12]}"
    fs.create_new(ds.spark, f"{ds.root}/_clustering/{name}.json", json.dumps(curve))
    return curve | {"name": name}


def _with_buckets(df: DataFrame, curve: dict, bits: int) -> DataFrame:
    """``df`` with ``__bucket<j>`` per clustering column: the number of its cuts not above the value (NULL: 0).

    By halving, one projection a step for all columns at once: plain comparisons that Spark compiles. The cuts are constant arrays.
    """
    points = [
        F.from_json(F.lit(json.dumps(cuts)), "array<string>").cast(f"array<{df.schema[c].dataType.simpleString()}>")
        for c, cuts in zip(curve["columns"], curve["cuts"])
    ]
    names = [f"__bucket{j}" for j in range(len(points))]
    out = df.withColumns({n: F.lit(0) for n in names})
    for b in range(bits - 1, -1, -1):
        out = out.withColumns({
            n: F.when(F.get(cuts, F.col(n) + ((1 << b) - 1)) <= F.col(f"`{c}`"), F.col(n) + (1 << b)).otherwise(F.col(n))
            for n, c, cuts in zip(names, curve["columns"], points)
        })
    return out


def with_position(df: DataFrame, curve: dict) -> DataFrame:
    """``df`` with ``__position``, the place of each row's cell on the curve."""
    columns = curve["columns"]
    bits = column_bits(len(columns))
    cell = F.lit(0).cast("long")
    for j in range(len(columns)):
        cell = cell.bitwiseOR(F.shiftleft(F.col(f"__bucket{j}").cast("long"), j * bits))
    cells = hilbert_positions(df.sparkSession, len(columns), bits).select(
        F.col("cell").alias("__cell"), F.col("position").alias("__position")
    )
    placed = _with_buckets(df, curve, bits).withColumn("__cell", cell).drop(*[f"__bucket{j}" for j in range(len(columns))])
    return placed.join(F.broadcast(cells), "__cell").drop("__cell")  # at most 65,536 rows


def _intervals(rows: DataFrame, curve: dict) -> DataFrame:
    """(file_path, lo, hi): the stretch of the curve each file covers."""
    needed = rows.select(*[f"`{c}`" for c in curve["columns"]], "__file")
    return with_position(needed, curve).groupBy(F.col("__file").alias("file_path")).agg(
        F.min("__position").alias("lo"), F.max("__position").alias("hi")
    )


def _ranges_dir(ds: VersionedDataset, curve: dict) -> str:
    return f"{ds.root}/_clustering/{curve['name']}"


def depth_by_position(intervals: DataFrame) -> DataFrame:
    """(position, depth) at each position where an interval [lo, hi) begins or ends, up to the next one.

    ``intervals`` has lo, hi and ``young``: all young ones count as one layer.
    """
    young = F.col("young").cast("long")
    ends = intervals.select(F.inline(F.array(
        F.struct(F.col("lo").alias("position"), (1 - young).alias("old"), young.alias("new")),
        F.struct(F.col("hi").alias("position"), (young - 1).alias("old"), (-young).alias("new")),
    )))
    steps = ends.groupBy("position").agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
    along = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)  # one row per cell at most
    layer = F.when(F.sum("new").over(along) > 0, F.lit(1)).otherwise(F.lit(0))
    return steps.select("position", (F.sum("old").over(along) + layer).alias("depth"))


def files_to_rewrite(intervals: DataFrame, max_depth: int) -> DataFrame:
    """The intervals of young files, and of those that reach into a stretch deeper than ``max_depth``."""
    depth = depth_by_position(intervals)
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    deep = depth.select("position", F.coalesce(F.sum((F.col("depth") > max_depth).cast("long")).over(before), F.lit(0)).alias("deep"))
    at = lambda end: deep.select(F.col("position").alias(end), F.col("deep").alias(f"deep_{end}"))
    return intervals.join(at("lo"), "lo").join(at("hi"), "hi").where("young or deep_hi > deep_lo").drop("deep_lo", "deep_hi")


def cluster(ds: VersionedDataset, columns: Sequence[str] | None = None, target_file_bytes: int = TARGET_FILE_BYTES,
            max_depth: int = MAX_DEPTH) -> int:
    """Cluster what is not clustered yet, as one OPTIMIZE commit (its parameters say how many of how many files were rewritten).

    ``columns`` may be left out after the first run; other columns than before start a new curve, on which no
    file lies yet. ``max_depth``: how many files may cover a position before they are merged.
    """
    base = ds.latest()
    curve = _curve(ds)
    if columns is None and curve is None:
        raise ValueError("name the clustering columns the first time")
    if curve is None or (columns is not None and list(columns) != curve["columns"]):
        curve = _new_curve(ds, ds._read_commit(base), list(columns), base.version + 1)
    names = ",".join(curve["columns"])
    sizes = dataset_file_sizes(ds, base.version)
    stored = None
    if fs.exists(ds.spark, _ranges_dir(ds, curve)):
        stored = ds.spark.read.option("recursiveFileLookup", "true").parquet(_ranges_dir(ds, curve))
    if stored is None:  # all files are young, wherever they lie
        found = sizes.select("file_path", "file_size", F.lit(True).alias("young"))
    else:
        old_files = sizes.join(stored, "file_path").select("file_path", "lo", "hi", F.lit(False).alias("young"))
        new_names = [r[0] for r in sizes.join(stored, "file_path", "left_anti").select("file_path").collect()]  # files of new commits
        young = _intervals(ds._read_commit(base, ("__file",), new_names), curve).withColumn("young", F.lit(True))
        intervals = old_files.unionByName(young)
        found = files_to_rewrite(intervals, max_depth).select("file_path", "young").join(sizes, "file_path").select("file_path", "file_size", "young")
    picked = found.collect()  # one row per file taken out
    total = sizes.count()
    report = {"clusterBy": names, "numFiles": total, "numRemovedFiles": len(picked), "numYoungFiles": sum(r.young for r in picked)}
    if not picked:
        return ds._next(base, "OPTIMIZE", base.version, parameters=report)
    rows = ds._read_commit(base, files=[r.file_path for r in picked])
    hashable = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (MapType, StructType))]
    order = [F.col(f"`{c}`") for c in curve["columns"]]
    n_files = max(_n_files(sum(r.file_size for r in picked), target_file_bytes), _n_files(_sort_bytes(rows), SORT_BYTES))
    placed = with_position(rows, curve)
    out = (
        placed.repartitionByRange(n_files, "__position", *order, F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
        .sortWithinPartitions("__position", *order).drop("__position")
    )
    entry = ds._write(base, out, base.version + 1)[KIND_INSERT]
    # before the commit; should it fail, these rows name files no version holds
    _intervals(ds._read_folders(base, [entry], ("__file",)), curve).write.parquet(
        f"{_ranges_dir(ds, curve)}/{base.version + 1}-{uuid.uuid4().hex[:12]}"
    )
    everything = len(picked) == total
    return ds._next(base, "OPTIMIZE", None if everything else base.version, [entry],
                    [] if everything else sorted(r.file_path for r in picked), parameters=report)
