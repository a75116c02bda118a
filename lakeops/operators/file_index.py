"""Per-file value filters beside min/max: lookups on several columns read the files that can hold all values (K3, K4).

An index build covers the folders of a version that no earlier build covers, in two passes over the indexed columns only:

- ``files``: one row per file with its row count and the smallest and largest value of each column;
- ``bits``: a Bloom filter per file and column, built by an aggregation. A value picks one 64-bit word of the filter and four
  bits in it; the words of a file are the ``bit_or`` of its values, so rows are combined before the shuffle and a word travels
  once per task. Only words with a bit set are stored, as rows (column, file, word), sorted by word.

A lookup takes a conjunction of ``=``, ``IN`` and range conditions on any of the columns. It reads the words its values pick (a pushed-down filter on
the word), keeps the files in which all bits of at least one value of each condition are set and whose [min, max] allows it, and
reads those files only. Files written after the last build are always read. Filters never miss a value; they name a file in
vain for about one value in two hundred.

Data files are immutable and never reused, so an index row stays right for every version that holds the file, and an append only needs
its own folder indexed. A build becomes visible by its commit row, written last.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from lakeops.functions import fs
from lakeops.functions.literals import lit_value, literal_df
from lakeops.plans.versioned import Commit, VersionedDataset, norm_path

WORD_BITS = 64
BITS_PER_VALUE = 16
BITS_SET = 4
LISTED_NAMES = 1000  # up to so many file names narrow the listing of a lookup


@dataclass(frozen=True)
class Between:
    """A range condition; an end that is None is open."""

    lo: object = None
    hi: object = None
    include_lo: bool = True
    include_hi: bool = True


@dataclass(frozen=True)
class Build:
    """One index build: where it is, the columns and folders it covers, and the words per filter."""

    path: str
    columns: list[str]
    folders: list[str]
    n_words: int


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _word(value: Column, n_words: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n_words)).cast("long")


def _mask(value: Column) -> Column:
    h = F.xxhash64(value, F.lit(1))
    places = [F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_SET)]
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def builds_of(ds: VersionedDataset) -> list[Build]:
    """All finished builds, oldest first."""
    out = []
    for name in fs.list_names(ds.spark, f"{ds.root}/_index"):
        path = f"{ds.root}/_index/{name}"
        if fs.exists(ds.spark, f"{path}/build.json"):
            row = json.loads(fs.read_text(ds.spark, f"{path}/build.json"))
            out.append((row["number"], Build(path, row["columns"], row["folders"], row["n_words"])))
    return [b for _, b in sorted(out, key=lambda x: (x[0], x[1].path))]


def _covering(ds: VersionedDataset, c: Commit) -> tuple[dict[str, Build], list[str], list[str]]:
    """The build that covers each folder of a version, the folders without one, and the files taken out."""
    folders, removed = ds.snapshot(c)
    found: dict[str, Build] = {}
    for b in builds_of(ds):
        for f in b.folders:
            found[f] = b  # the newest one counts
    return {f: found[f] for f in folders if f in found}, [f for f in folders if f not in found], removed


def build_index(ds: VersionedDataset, columns: Sequence[str], rebuild: bool = False) -> int:
    """Index the folders of the latest version that no build with these columns covers (``rebuild``: all of
    them). Returns the number of folders indexed."""
    c, columns = ds.latest(), list(columns)
    for name in columns:
        if isinstance(c.schema[name].dataType, (MapType, VariantType, ArrayType, StructType)):
            raise ValueError(f"column {name} has no single value to look up")
    covered, open_folders, _ = _covering(ds, c)
    short = [f for f, b in covered.items() if rebuild or not set(columns) <= set(b.columns)]
    folders = [*open_folders, *short]
    if not folders:
        return 0
    rows = ds._read_folders(c, folders, ("__file",)).select("__file", *[_c(n).alias(f"v{i}") for i, n in enumerate(columns)])
    path = f"{ds.root}/_index/{c.version}-{uuid.uuid4().hex[:12]}"
    ranges = [x for i in range(len(columns)) for x in (F.min(f"v{i}").alias(f"lo{i}"), F.max(f"v{i}").alias(f"hi{i}"))]
    files = rows.groupBy(F.col("__file").alias("file_path")).agg(F.count(F.lit(1)).alias("num_rows"), *ranges)
    files.withColumn("file_id", F.xxhash64("file_path")).write.parquet(f"{path}/files")
    stored = ds.spark.read.parquet(f"{path}/files")
    largest = stored.agg(F.max("num_rows")).first()[0] or 0  # one number
    n_words = max(1, -(-largest * BITS_PER_VALUE // WORD_BITS))
    marks = F.array(*[
        F.when(F.col(f"v{i}").isNotNull(), F.struct(F.lit(i).alias("column"), _word(F.col(f"v{i}"), n_words).alias("word"),
                                                    _mask(F.col(f"v{i}")).alias("mask")))
        for i in range(len(columns))
    ])
    marked = rows.select(F.xxhash64("__file").alias("file_id"), F.inline(F.array_compact(marks)))
    words = marked.groupBy("column", "file_id", "word").agg(F.bit_or("mask").alias("bits"))
    words.sortWithinPartitions("column", "word").write.parquet(f"{path}/bits")
    row = {"number": c.version, "columns": columns, "folders": folders, "n_words": n_words}
    fs.create_new(ds.spark, f"{path}/build.json", json.dumps(row))
    return len(folders)


def _values(condition, kind: DataType) -> list[Column] | None:
    """The values an equality or IN names, in the column's type (None for a range)."""
    if isinstance(condition, Between):
        return None
    listed = condition if isinstance(condition, (list, tuple, set, frozenset)) else [condition]
    return [lit_value(v, kind) for v in listed if v is not None]


def predicate(conditions: Mapping[str, object], schema: StructType) -> Column:
    """The conditions as a filter on rows; NULL equals nothing."""
    out = F.lit(True)
    for name, cond in conditions.items():
        kind, col = schema[name].dataType, _c(name)
        if isinstance(cond, Between):
            if cond.lo is not None:
                lo = lit_value(cond.lo, kind)
                out = out & (col >= lo if cond.include_lo else col > lo)
            if cond.hi is not None:
                hi = lit_value(cond.hi, kind)
                out = out & (col <= hi if cond.include_hi else col < hi)
            out = out & col.isNotNull()
        else:
            values = _values(cond, kind)
            out = out & (col.isin(*values) if values else F.lit(False))
    return out


def _hits(ds: VersionedDataset, b: Build, folders: list[str], removed: list[str], conditions, schema: StructType) -> DataFrame:
    """(file_path, hit) of a build's files that belong to the version."""
    files = ds.spark.read.parquet(f"{b.path}/files")
    if set(folders) != set(b.folders):
        plain = F.regexp_replace("file_path", r"^file:/+", "file:///")
        files = files.where(reduce(lambda x, y: x | y, [plain.startswith(f"{norm_path(f)}/") for f in folders]))
    if removed:
        files = files.where(~F.col("file_path").isin(removed))
    probes, tests = [], []
    for name, cond in conditions.items():
        if name not in b.columns:
            continue
        i = b.columns.index(name)
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        values = _values(cond, schema[name].dataType)
        if values is None:
            test = lo.isNotNull()
            if cond.lo is not None:
                at = lit_value(cond.lo, schema[name].dataType)
                test = test & (hi >= at if cond.include_lo else hi > at)
            if cond.hi is not None:
                at = lit_value(cond.hi, schema[name].dataType)
                test = test & (lo <= at if cond.include_hi else lo < at)
        else:
            test = F.lit(False)
            for v in values:
                number = len(probes)
                probes.append(F.struct(F.lit(number).alias("probe"), F.lit(i).alias("column"), _word(v, b.n_words).alias("word"),
                                       _mask(v).alias("mask")))
                test = test | (F.array_contains("found", number) & (lo <= v) & (hi >= v))
        tests.append(F.coalesce(test, F.lit(False)))
    hit = reduce(lambda x, y: x & y, tests, F.lit(True))
    if not probes:
        return files.select("file_path", hit.alias("hit"))
    asked = ds.spark.range(1).select(F.inline(F.array(*probes)))
    wanted = [(r.column, r.word) for r in asked.select("column", "word").distinct().collect()]  # as many as values asked for
    words = ds.spark.read.parquet(f"{b.path}/bits").where(F.col("word").isin(sorted({w for _, w in wanted})))
    found = words.join(F.broadcast(asked), ["column", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    found = found.groupBy("file_id").agg(F.collect_set("probe").alias("found"))
    return files.join(found, "file_id", "left").select("file_path", hit.alias("hit"))


def _indexed_hits(ds: VersionedDataset, c: Commit, covered: Mapping[str, Build], removed: list[str], conditions) -> DataFrame:
    parts = [
        _hits(ds, b, [f for f, own in covered.items() if own.path == b.path], removed, conditions, c.schema)
        for b in {b.path: b for b in covered.values()}.values()
    ]
    return reduce(DataFrame.union, parts) if parts else literal_df(ds.spark, [], "file_path string, hit boolean")


def files_to_read(ds: VersionedDataset, conditions: Mapping[str, object], version: int | None = None) -> DataFrame:
    """(file_path, hit) per file of a version: whether it can hold rows that meet all conditions."""
    c = ds.latest() if version is None else ds.commit_at(version)
    covered, open_folders, removed = _covering(ds, c)
    hits = _indexed_hits(ds, c, covered, removed, conditions)
    if not open_folders:
        return hits
    rest = ds._read_folders(c, open_folders, ("__file",)).select(F.col("__file").alias("file_path")).distinct()
    if removed:
        rest = rest.where(~F.col("file_path").isin(removed))
    return hits.union(rest.select("file_path", F.lit(True)))


def lookup(ds: VersionedDataset, conditions: Mapping[str, object], version: int | None = None) -> DataFrame:
    """Rows that meet all ``conditions`` (column -> value, list of values, or ``Between``), reading only the files
    that can hold them. Only the names of those files reach the driver."""
    c = ds.latest() if version is None else ds.commit_at(version)
    covered, open_folders, removed = _covering(ds, c)
    rows = []
    if covered:
        hits = [r[0] for r in _indexed_hits(ds, c, covered, removed, conditions).where("hit").select("file_path").collect()]
        if hits:
            names = {f.rsplit("/", 1)[1] for f in hits}
            if len(names) > LISTED_NAMES or not all(re.fullmatch(r"[A-Za-z0-9_.-]+", x) for x in names):
                names = set()  # the filter on paths alone leaves the other files out
            rows.append(ds._read_folders(c, list(covered), ("__file",), names).where(F.col("__file").isin(sorted(hits))))
    if open_folders:
        rest = ds._read_folders(c, open_folders, ("__file",))
        rows.append(rest.where(~F.col("__file").isin(removed)) if removed else rest)
    if not rows:
        return ds._read_folders(c, []).where(F.lit(False))
    return reduce(DataFrame.unionByName, rows).drop("__file").where(predicate(conditions, c.schema))
