"""Layout of versioned datasets: compaction, clustering, file statistics,
file skipping and the list of unreferenced files (K1-K5, A13).

- ``compact`` packs the files smaller than half the target size into bins, one task and one new
  file each; big files stay referenced as they are. Files of a clustered dataset are packed
  with their neighbours. Rows are unchanged, so the commit carries no change rows. Partition
  values are kept apart with a rebalance, which splits large ones.
- ``cluster_by`` rewrites the snapshot range-partitioned on the clustering key
  and sorted inside each file, so per-file min/max become narrow. The range
  key carries a deterministic hash of the row as a tiebreak: a value holding a
  third of all rows is spread over several output files instead of one task.
  Several columns are interleaved into a Morton (Z-order) key built from
  quantile buckets with Column arithmetic (no UDF): cut points of a bounded sample,
  compared with Spark's own ordering, so any orderable type works, long texts
  and NaN included. They only shape the layout, never a result.
- Clustered files hold at most about ``target_file_bytes`` on disk and ``SORT_BYTES`` as rows in a sort,
  so the memory of the task that writes one does not grow with the table, nor with how well its rows compress.
- Per-file statistics of the clustering columns are computed once, right
  after the clustering write (one pass over just those columns), and stored
  beside the version; ``files_between`` compares them in Spark and brings only
  the surviving file names to the driver.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DecimalType, MapType, StringType, StructType, VariantType

from lakeops.functions import fs
from lakeops.functions.literals import literal_df
from lakeops.plans.versioned import KIND_INSERT, VersionedDataset

TARGET_FILE_BYTES = 128 * 1024 * 1024
SORT_BYTES = 256 * 1024 * 1024  # rows of one clustered file as a sort holds them, about
SORT_ROW_BYTES = 32  # of one row in a sort, beside the row itself
ZORDER_BITS = 4  # at least 16 quantile buckets per column
ZORDER_MAX_BITS = 8  # at most 256: more cells than files for any two or more columns
ZORDER_SAMPLE_ROWS = 20_000


def dataset_file_sizes(ds: VersionedDataset, version: int | None = None) -> DataFrame:
    """(file_path, file_size, num_rows) of a version's files; metadata columns only (taken per
    scan, so partitioned datasets made of several folders work too)."""
    c = ds.latest() if version is None else ds.commit_at(version)
    return (
        ds._read_commit(c, meta=("__file", "__size"))
        .groupBy(F.col("__file").alias("file_path"), F.col("__size").alias("file_size"))
        .agg(F.count(F.lit(1)).alias("num_rows"))
    )


def _n_files(total_bytes: int, target: int) -> int:
    return max(1, math.ceil(total_bytes / target))


def _varies(kind: DataType) -> bool:
    """Whether values of the type differ in size (Spark's hash aggregation keeps no minimum of those)."""
    return isinstance(kind, (StringType, BinaryType, ArrayType, MapType, StructType, VariantType))


def _sort_bytes(df: DataFrame) -> int:
    """Bytes of all rows as a sort holds them: 8 a field, and the contents of those that differ in size."""
    fields = df.schema.fields
    row = 8 * (len(fields) + math.ceil(len(fields) / 64)) + SORT_ROW_BYTES
    row += 16 * sum(isinstance(f.dataType, DecimalType) and f.dataType.precision > 18 for f in fields)
    total = F.count(F.lit(1)) * row
    for f in fields:
        if _varies(f.dataType):
            col = F.col(f"`{f.name}`")
            plain = isinstance(f.dataType, (StringType, BinaryType))
            size = F.octet_length(col if plain else F.to_json(F.struct(col)))
            total += F.coalesce(F.sum(F.ceil(size / 8) * 8), F.lit(0))
    return df.agg(total.alias("bytes")).first()[0]


def pack_bins(sizes: Sequence[int], target: int, keep_order: bool) -> list[list[int]]:
    """Positions of ``sizes`` grouped into bins of about ``target``: neighbours in order, or first-fit by
    decreasing size. Bins of one file are left out, as there is nothing to merge."""
    bins: list[list[int]] = []
    room: list[int] = []
    if keep_order:
        for i, size in enumerate(sizes):
            if not bins or room[-1] < size:
                bins.append([])
                room.append(target)
            bins[-1].append(i)
            room[-1] -= size
    else:
        first = 0  # bins before it are too full for any file
        least = min(sizes, default=0)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            while first < len(bins) and room[first] < least:
                first += 1
            at = next((b for b in range(first, len(bins)) if room[b] >= sizes[i]), len(bins))
            if at == len(bins):
                bins.append([])
                room.append(target)
            bins[at].append(i)
            room[at] -= sizes[i]
    return [b for b in bins if len(b) > 1]


class _Order:
    """How a dataset's files lie by their clustering: a place per file, how rows sort, and what to store of new files."""

    def __init__(self, ds: VersionedDataset, base):
        from lakeops.operators import clustering  # builds on this module

        self.ds, self.clustering = ds, clustering
        self.curve = clustering._curve(ds)
        self.stats = None if self.curve else stats_of(ds, base.version)
        self.columns = [c[: -len("__min")] for c in self.stats.columns if c.endswith("__min")] if self.stats is not None else []
        if self.curve:
            stored = ds.spark.read.option("recursiveFileLookup", "true").parquet(clustering._ranges_dir(ds, self.curve))
            self.places = stored.select("file_path", F.struct("lo", "hi").alias("place"))
        elif self.columns:
            ends = [F.col(f"`{c}__{end}`") for c in self.columns[:1] for end in ("min", "max")]
            self.places = self.stats.select("file_path", F.struct(*ends).alias("place"))
        else:
            self.places = None

    def sorted(self, rows: DataFrame) -> DataFrame:
        """Rows of each partition in the order of the clustering."""
        columns = [F.col(f"`{c}`") for c in (self.curve["columns"] if self.curve else self.columns)]
        if self.curve:
            return rows.sortWithinPartitions("__position", *columns)
        return rows.sortWithinPartitions(*columns) if columns else rows

    def store(self, entry_rows: DataFrame, removed: Sequence[str], version: int) -> None:
        """Before the commit: what later reads need to know of the new files."""
        if self.curve:
            intervals = self.clustering._intervals(entry_rows, self.curve)
            intervals.write.parquet(f"{self.clustering._ranges_dir(self.ds, self.curve)}/{version}-{uuid.uuid4().hex[:12]}")
        elif self.columns:
            new = file_stats(entry_rows.select(*[f"`{n}`" for n in self.columns], "__file"), self.columns)
            rest = self.stats.where(~F.col("file_path").isin(list(removed)))
            rest.unionByName(new).write.mode("overwrite").parquet(_stats_dir(self.ds, version))


def compact(ds: VersionedDataset, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """OPTIMIZE: pack files smaller than half of ``target_file_bytes`` into files of about that size.

    Each bin of files becomes one file, written by one task. Files of a clustered dataset are packed with their neighbours in
    the order of the clustering and their rows merged in that order, so a key is held by no more files than before; any others
    first-fit by decreasing size. A file that fits no other stays as it is.
    """
    base = ds.latest()
    sizes = dataset_file_sizes(ds, base.version).where(F.col("file_size") < target_file_bytes // 2)
    order = _Order(ds, base)
    nothing = lambda: ds._next(base, "OPTIMIZE", base.version, parameters={"numRemovedFiles": 0})
    if base.partition_cols:  # files of one partition value belong together: the write rebalances by it
        small = sizes.select("file_path", "file_size").collect()  # one row per file taken out
        if len(small) < 2:
            return nothing()
        removed = sorted(r.file_path for r in small)
        rows = ds._read_commit(base, files=removed)
        n_bins = None
    else:
        placed = sizes.join(order.places, "file_path", "left") if order.places is not None else sizes.withColumn("place", F.lit(None))
        # one row per small file; those without a place behind the others
        small = placed.orderBy(F.col("place").isNull(), "place", "file_path").select("file_path", "file_size", F.col("place").isNotNull().alias("known")).collect()
        bins = []
        for known in (True, False):
            part = [r for r in small if r.known == known]
            bins += [[part[i].file_path for i in b] for b in pack_bins([r.file_size for r in part], target_file_bytes, known)]
        if not bins:
            return nothing()
        removed = sorted(f for b in bins for f in b)
        bin_of = pa.table({"__file": [f for b in bins for f in b], "__bin": [i for i, b in enumerate(bins) for _ in b]})
        rows = ds._read_commit(base, ("__file",), removed)
        if order.curve:
            rows = order.clustering.with_position(rows, order.curve)
        # as many rows as files taken out
        rows = rows.join(F.broadcast(ds.spark.createDataFrame(bin_of)), "__file").repartitionById(len(bins), F.col("__bin").cast("int"))
        rows = order.sorted(rows).drop("__file", "__bin", "__position")
        n_bins = len(bins)
    entry = ds._write(base, rows, base.version + 1)[KIND_INSERT]
    order.store(ds._read_folders(base, [entry], ("__file",)), removed, base.version + 1)
    report = {"numRemovedFiles": len(removed)} | ({"numAddedFiles": n_bins} if n_bins else {})
    return ds._next(base, "OPTIMIZE", base.version, [entry], removed, parameters=report)


def zorder_bits(n_files: int, k: int) -> int:
    """Quantile bits per column: enough cells for ``n_files`` files, within the fixed bounds."""
    return max(ZORDER_BITS, min(ZORDER_MAX_BITS, math.ceil(math.log2(max(n_files, 2)) / k) + 1))


def _cut_points(df: DataFrame, columns: Sequence[str], n: int, as_text: bool = False) -> list[list]:
    """``n`` ascending quantiles of each column, from a sample of about ZORDER_SAMPLE_ROWS rows (``as_text``: cast to text).

    Sorted in Spark, so texts, NaN and dates order as they do in the data; only the cut
    points reach the driver.
    """
    share = min(1.0, ZORDER_SAMPLE_ROWS / max(1, df.count()))  # a count of Parquet footers
    sample = df.select(*[f"`{c}`" for c in columns]).sample(share, 42)
    places = F.sequence(F.lit(1), F.lit(n))

    def cuts(c: str) -> Column:
        ordered = F.sort_array(F.collect_list(F.col(f"`{c}`")))
        at = F.transform(places, lambda i: F.get(ordered, F.floor(i * F.size(ordered) / (n + 1)).cast("int")))
        found = F.array_distinct(F.filter(at, lambda x: x.isNotNull()))
        return found.cast("array<string>") if as_text else found

    return list(sample.agg(*[cuts(c).alias(f"c{i}") for i, c in enumerate(columns)]).first())


def _bucket(col: Column, cuts: Sequence, first: int = 0) -> Column:
    """Number of ``cuts`` not above the value, as a binary tree of comparisons (NULL: 0)."""
    if not cuts:
        return F.lit(first)
    mid = len(cuts) // 2
    return F.when(col >= F.lit(cuts[mid]), _bucket(col, cuts[mid + 1 :], first + mid + 1)).otherwise(
        _bucket(col, cuts[:mid], first)
    )


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = ZORDER_BITS) -> DataFrame:
    """``df`` with ``__zkey``: the Morton key of per-column quantile buckets, with the bits
    interleaved by shifts and ORs."""
    cuts = _cut_points(df, columns, 2**bits - 1)
    z = F.lit(0).cast("long")
    for j, (c, points) in enumerate(zip(columns, cuts)):
        bucket = _bucket(F.col(f"`{c}`"), points).cast("long")
        for i in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(bucket, i).bitwiseAND(F.lit(1)), i * len(columns) + j))
    return df.withColumn("__zkey", z)


def cluster_by(ds: VersionedDataset, columns: Sequence[str], n_files: int | None = None,
               target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """OPTIMIZE ... ZORDER BY (columns): rewrite clustered, then store per-file stats."""
    base = ds.latest()
    columns = list(columns)
    df = ds._read_commit(base)
    if n_files is None:
        total = dataset_file_sizes(ds, base.version).agg(F.sum("file_size")).first()[0] or 0
        n_files = max(_n_files(total, target_file_bytes), _n_files(_sort_bytes(df), SORT_BYTES))
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    tiebreak = F.xxhash64(*[F.col(f"`{c}`") for c in hashable])  # deterministic under task retries
    if len(columns) == 1:
        key = F.col(f"`{columns[0]}`")
        out = df.repartitionByRange(n_files, key, tiebreak).sortWithinPartitions(key)
    else:
        out = (
            zorder_key(df, columns, bits=zorder_bits(n_files, len(columns)))
            .repartitionByRange(n_files, F.col("__zkey"), tiebreak)
            .sortWithinPartitions("__zkey")
            .drop("__zkey")
        )
    entry = ds._write(base, out, base.version + 1)[KIND_INSERT]
    # before the commit: a version is never seen without the stats of its files
    _store_stats(ds, ds._read_folders(base, [entry], ("__file",)), columns, base.version + 1)
    return ds._next(base, "OPTIMIZE", None, [entry], parameters={"zOrderBy": ",".join(columns), "numFiles": n_files})


def file_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per-file row count, and min / max / null count of each column (K3).

    ``df`` is a plain scan, or a dataset read that carries ``__file``. Spark would sort all rows by file for the least of
    texts and other values that differ in size; so of those the distinct values per file are taken first, by hashing.
    """
    path = F.col("__file") if "__file" in df.columns else F.col("_metadata.file_path")
    rows = df.withColumn("file_path", path)
    aggs, varying = [F.count(F.lit(1)).alias("num_rows")], []
    for c in columns:
        col = F.col(f"`{c}`")
        if _varies(df.select(col).schema[0].dataType):
            varying.append(c)
        else:
            aggs += [F.min(col).alias(f"{c}__min"), F.max(col).alias(f"{c}__max"), F.count_if(col.isNull()).alias(f"{c}__nulls")]
    out = rows.groupBy("file_path").agg(*aggs)
    for c in varying:
        values = rows.groupBy("file_path", F.col(f"`{c}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
        # always true; without it Spark takes the step before for needless where only the ends are asked for
        values = values.where("n > 0")
        nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        out = out.join(values.groupBy("file_path").agg(  # one row per file on both sides
            F.min("value").alias(f"{c}__min"), F.max("value").alias(f"{c}__max"), nulls.alias(f"{c}__nulls")
        ), "file_path")
    return out.select("file_path", "num_rows", *[f"`{c}__{x}`" for c in columns for x in ("min", "max", "nulls")])


def dataset_file_stats(ds: VersionedDataset, columns: Sequence[str], version: int | None = None) -> DataFrame:
    c = ds.latest() if version is None else ds.commit_at(version)
    return file_stats(ds._read_commit(c, meta=("__file",)).select(*[f"`{n}`" for n in columns], "__file"), columns)


def _stats_dir(ds: VersionedDataset, version: int) -> str:
    return f"{ds.root}/_stats/version={version}"


def _store_stats(ds: VersionedDataset, rows: DataFrame, columns: Sequence[str], version: int) -> str:
    path = _stats_dir(ds, version)
    stats = file_stats(rows.select(*[f"`{n}`" for n in columns], "__file"), columns)
    stats.write.mode("overwrite").parquet(path)  # AQE sizes the output
    return path


def write_file_stats(ds: VersionedDataset, columns: Sequence[str], version: int) -> str:
    return _store_stats(ds, ds._read_commit(ds.commit_at(version), meta=("__file",)), columns, version)


def stats_of(ds: VersionedDataset, version: int | None = None) -> DataFrame | None:
    """Stored per-file stats of the newest clustered version <= ``version``."""
    v = ds.latest_version() if version is None else version
    stored = sorted(
        (int(n.split("=", 1)[1]) for n in fs.list_names(ds.spark, f"{ds.root}/_stats") if n.startswith("version=")),
        reverse=True,
    )
    for sv in stored:
        if sv <= v:
            return ds.spark.read.parquet(_stats_dir(ds, sv))
    return None


def version_files(ds: VersionedDataset, version: int | None = None) -> DataFrame:
    """(file_path) of a version's files that hold rows."""
    c = ds.latest() if version is None else ds.commit_at(version)
    return ds._read_commit(c, ("__file",)).select(F.col("__file").alias("file_path")).distinct()


def skipping(ds: VersionedDataset, column: str, lo, hi, version: int | None = None) -> DataFrame | None:
    """(file_path, hit) per file of a version: whether it may hold a value of ``column`` in [lo, hi].

    Stats stored at the last clustering carry forward: a file they cover is a hit if
    its [min, max] overlaps, under Spark's ordering and the column's type; a file
    written later is always one. No value is in a range with a NULL end. None
    without stats for the column.
    """
    c = ds.latest() if version is None else ds.commit_at(version)
    stats = stats_of(ds, c.version)
    if stats is None or f"{column}__min" not in stats.columns:
        return None
    kind = c.schema[column].dataType
    lo, hi = F.lit(lo).cast(kind), F.lit(hi).cast(kind)
    stats = stats.select("file_path", F.lit(True).alias("covered"), F.coalesce(
        (F.col(f"`{column}__min`") <= hi) & (F.col(f"`{column}__max`") >= lo), F.lit(False)
    ).alias("overlaps"))
    return version_files(ds, c.version).join(stats, "file_path", "left").select(
        "file_path", (F.col("covered").isNull() | F.col("overlaps")).alias("hit")
    )


def files_between(ds: VersionedDataset, column: str, lo, hi, version: int | None = None) -> list[str] | None:
    """Names of the files ``skipping`` finds hit, the only ones brought to the driver; None without stats."""
    found = skipping(ds, column, lo, hi, version)
    return None if found is None else sorted(r[0] for r in found.where("hit").select("file_path").collect())


def point_lookup(ds: VersionedDataset, column: str, value, version: int | None = None) -> DataFrame:
    """Rows with ``column = value``, reading only the files that can hold it; the predicate is also
    pushed into the scan."""
    c = ds.latest() if version is None else ds.commit_at(version)
    files = files_between(ds, column, value, value, c.version)
    return ds._read_commit(c, files=files).where(F.col(f"`{column}`") == F.lit(value).cast(c.schema[column].dataType))


def _plain(path: str) -> str:
    return re.sub(r"^file:/+", "file:///", path)


def unreferenced_files(ds: VersionedDataset, retain_from_version: int = 0) -> DataFrame:
    """Files under ``data/`` and ``_staging/`` that no retained commit refers to (what a vacuum would remove).

    Retained commits are those >= ``retain_from_version`` (default: all); the latest is always
    kept. Listing only: nothing is deleted. A file is referenced if it lies in a folder of a
    retained commit's snapshot that has not taken it out, or in one of its change folders. Staged
    merge sources are never referenced: they serve only while their merge runs.
    """
    retain_from_version = min(retain_from_version, ds.latest_version())
    retained = [c for c in ds._commits() if c.version >= retain_from_version]
    snapshots = [ds.snapshot(c) for c in retained]
    folders = {p for mine, _ in snapshots for p in mine}
    feed = {p for c in retained for _, p, _ in c.changes if p is not None}
    gone, held = {f for _, removed in snapshots for f in removed}, set()
    for mine, removed in snapshots:
        out, mine = set(removed), [_plain(p) for p in mine]
        held.update(f for f in gone if f not in out and any(_plain(f).startswith(f"{p}/") for p in mine))
    gone = {_plain(f) for f in gone - held if not any(_plain(f).startswith(f"{_plain(p)}/") for p in feed)}
    entries = sorted({_plain(p).rstrip("/") for p in folders | feed})
    listed = None
    for folder in ("data", "_staging"):
        if fs.exists(ds.spark, f"{ds.root}/{folder}"):
            one = (
                ds.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{ds.root}/{folder}")
                .select(F.regexp_replace("path", r"^file:/+", "file:///").alias("path"))  # `content` is never read
            )
            listed = one if listed is None else listed.union(one)
    if listed is None:
        return literal_df(ds.spark, [], "path string")
    parts = F.split(F.col("path"), "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    named = literal_df(ds.spark, [(e,) for e in entries], "entry string")
    hit = listed.select("path", F.explode(prefixes).alias("entry")).join(named, "entry", "left_semi").select("path").distinct()
    if gone:
        hit = hit.where(~F.col("path").isin(sorted(gone)))
    return listed.join(hit, "path", "left_anti")
