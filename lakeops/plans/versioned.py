"""Versioned Parquet datasets: a folder convention, not a storage engine.

Layout under ``root``::

    data/<version>-<uid>/...        immutable Parquet written by one commit, never reused
    log/version=<n>/commit.json     one row per commit, written LAST by exclusive create
    _staging/<version>-<uid>/       merge sources materialised once (deterministic re-reads)

A commit row records what the commit changed, not the whole table: the version it
starts from (``base``; none for an empty start), the data *entries* (folders) it adds
and the files it takes out of earlier entries, and the change-feed entries of that
commit: a folder of change rows, or a whole earlier snapshot by its number. A
version's snapshot is folded from the rows down its chain of bases. So an
overwrite, a delete of all rows or a restore is a row of constant size.

Row-level update / delete / merge use file-level copy-on-write: one job finds
the files holding matching rows (``_metadata.file_path``), and only those files
are read, transformed and rewritten; every other file stays as it is. Files
are left out, or picked, by a filter on ``_metadata.file_path``, which Spark applies to
the file listing, so partitioned folders keep their base path and columns. With the change feed on, the rewrite writes one folder partitioned by row
kind (keep / pre / post / insert / delete) in a single pass; the snapshot
references the keep/post/insert parts, the change feed the pre/post/insert/
delete parts, so post-images are stored once.

Single writer per dataset: the log row of version n is created exclusively
(create-if-absent), so a second writer of the same version fails instead of
overwriting. A crash before the log row leaves unreferenced folders that no
reader sees (``layout.unreferenced_files`` lists them).
"""

from __future__ import annotations

import datetime as _dt
import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    _parse_datatype_json_string,
)

from lakeops.functions import fs
from lakeops.functions.columns import as_column, is_true
from lakeops.functions.literals import empty_df, literal_df
from lakeops.operators import rowops
from lakeops.sources.files import bind_by_position

KIND = "__kind"
KIND_KEEP, KIND_PRE, KIND_POST, KIND_INSERT, KIND_DELETE = "keep", "pre", "post", "insert", "delete"
# Public change-type names of a row-level change feed.
CHANGE_TYPE = {
    KIND_INSERT: "insert",
    KIND_DELETE: "delete",
    KIND_PRE: "update_preimage",
    KIND_POST: "update_postimage",
}
# Plan nodes whose rows do not depend on how a plan is run.
STABLE_NODES = frozenset({"LogicalRelation", "Filter", "Project", "SubqueryAlias", "LocalRelation", "Range", "Union"})
DATA_KINDS = (KIND_KEEP, KIND_POST, KIND_INSERT)
# What a commit did to rows, by name in its metrics.
KEPT, UPDATED, INSERTED, DELETED = "rows_kept", "rows_updated", "rows_inserted", "rows_deleted"
# Column names this module uses beside the data.
RESERVED = frozenset({KIND, "__file", "__row", "__size"})
CHANGE_FEED_PROPERTY = "enableChangeDataFeed"
CHANGE_FEED_DEFAULT_CONF = "lakeops.properties.defaults.enableChangeDataFeed"

LOG_SCHEMA = StructType(
    [
        StructField("ts_ms", LongType()),
        StructField("operation", StringType()),
        StructField("parameters", MapType(StringType(), StringType())),
        StructField("schema_json", StringType()),
        StructField("partition_cols", ArrayType(StringType())),
        StructField("properties", MapType(StringType(), StringType())),
        StructField("generated", MapType(StringType(), StringType())),
        StructField("not_null", ArrayType(StringType())),
        StructField("base", IntegerType()),
        StructField("added", ArrayType(StringType())),
        StructField("removed", ArrayType(StringType())),
        StructField("feed", BooleanType()),
        StructField(
            "changes",
            ArrayType(StructType([
                StructField("change_type", StringType()), StructField("path", StringType()),
                StructField("snapshot", IntegerType()),
            ])),
        ),
        StructField("metrics", MapType(StringType(), LongType())),
        StructField("num_rows", LongType()),
        StructField("version", IntegerType()),  # from the log/version=<n> folder
    ]
)


class VersionError(ValueError):
    """Unknown version, empty timestamp range, dataset (not) existing."""


class ConcurrentCommitError(RuntimeError):
    """Another writer committed the same version first."""


class AmbiguousMergeError(ValueError):
    """Several source rows match one target row."""


def norm_path(p: str) -> str:
    # `_metadata.file_path` says file:/x, inputFiles() and Hadoop say file:///x.
    return re.sub(r"^file:/+", "file:///", p)


def _as_schema(schema: str | StructType) -> StructType:
    if isinstance(schema, StructType):
        return schema
    return StructType.fromDDL(schema)


@dataclass(frozen=True)
class Commit:
    version: int
    ts_ms: int | None
    operation: str
    parameters: dict
    schema: StructType
    partition_cols: list[str]
    properties: dict
    generated: dict
    not_null: list[str]
    base: int | None = None  # version whose snapshot this one starts from
    added: list[str] = field(default_factory=list)  # folders
    removed: list[str] = field(default_factory=list)  # files of earlier folders, as _metadata.file_path names them
    # (change type, folder of change rows, or else the version all of whose rows changed)
    changes: list[tuple[str, str | None, int | None]] = field(default_factory=list)
    feed: bool = True  # the changes are complete: recorded, or there are none
    metrics: dict[str, int] = field(default_factory=dict)  # rows the commit wrote or took out, by what happened to them
    num_rows: int | None = None  # rows of the version; None where an older commit did not say

    @property
    def change_feed(self) -> bool:
        # Any key ending in the property name counts (a format prefix before it is fine).
        return any(
            k.rsplit(".", 1)[-1] == CHANGE_FEED_PROPERTY and str(v).lower() == "true" for k, v in self.properties.items()
        )


class Written(dict):
    """{row kind: folder} of one write, and the number of rows of each kind."""

    def __init__(self, rows: Mapping[str, int]):
        super().__init__()
        self.rows = dict(rows)


def row_metrics(rows: Mapping[str, int], **more: int) -> dict[str, int]:
    """Commit metrics from rows by kind (pre-images are the old form of updated rows)."""
    named = {KEPT: KIND_KEEP, UPDATED: KIND_POST, INSERTED: KIND_INSERT, DELETED: KIND_DELETE}
    return {m: rows[k] for m, k in named.items() if rows.get(k)} | {m: n for m, n in more.items() if n}


def _nullable(t: DataType) -> DataType:
    """The type with every nested part nullable, as Parquet gives it back."""
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _nullable(f.dataType), True, f.metadata) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(_nullable(t.elementType), True)
    if isinstance(t, MapType):
        return MapType(_nullable(t.keyType), _nullable(t.valueType), True)
    return t


def _check_names(schema: StructType) -> None:
    taken = sorted(RESERVED & set(schema.fieldNames()))
    if taken:
        raise ValueError(f"reserved column names: {taken}")


class VersionedDataset:
    """Handle on a versioned dataset rooted at a path (shared storage).

    Mutations are eager (they commit when called); reads are lazy DataFrames
    pinned to the version they resolved, so later commits never change them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = norm_path(fs.qualify(spark, root)).rstrip("/")
        # Commits are immutable once written: cache them, read only unseen versions.
        self._cache: dict[int, Commit] = {}

    # ------------------------------------------------------------------ log
    @property
    def log_dir(self) -> str:
        return f"{self.root}/log"

    def exists(self) -> bool:
        return bool(fs.list_names(self.spark, self.log_dir))

    def _commits(self) -> list[Commit]:
        names = fs.list_names(self.spark, self.log_dir)  # one listing call, no job
        versions = {int(n.split("=", 1)[1]) for n in names if n.startswith("version=")}
        if not versions:
            raise VersionError(f"no versioned dataset at {self.root}")
        unseen = sorted(versions - self._cache.keys())
        if unseen:
            paths = [f"{self.log_dir}/version={v}" for v in unseen]
            rows = (
                self.spark.read.schema(LOG_SCHEMA).option("basePath", self.log_dir).json(paths).collect()
            )  # one row per new commit, as long as what it changed
            for c in self._parse(rows):
                self._cache[c.version] = c
        return [self._cache[v] for v in sorted(versions)]

    def log_frame(self) -> DataFrame:
        """All commit rows as a DataFrame (LOG_SCHEMA)."""
        return self.spark.read.schema(LOG_SCHEMA).json(self.log_dir)

    def snapshot(self, c: Commit) -> tuple[list[str], list[str]]:
        """The folders of a version and the files in them that no longer belong to it."""
        chain = [c]
        while chain[-1].base is not None:
            chain.append(self.commit_at(chain[-1].base))
        added = [p for x in reversed(chain) for p in x.added]
        return added, [f for x in reversed(chain) for f in x.removed]

    @staticmethod
    def _parse(rows) -> list[Commit]:
        out = []
        for r in sorted(rows, key=lambda r: r.version):
            out.append(
                Commit(
                    version=r.version,
                    ts_ms=r.ts_ms,
                    operation=r.operation,
                    parameters=dict(r.parameters or {}),
                    schema=_parse_datatype_json_string(r.schema_json),
                    partition_cols=list(r.partition_cols or []),
                    properties=dict(r.properties or {}),
                    generated=dict(r.generated or {}),
                    not_null=list(r.not_null or []),
                    base=r.base,
                    added=list(r.added or []),
                    removed=list(r.removed or []),
                    changes=[(c.change_type, c.path, c.snapshot) for c in (r.changes or [])],
                    feed=bool(r.feed),
                    metrics=dict(r.metrics or {}),
                    num_rows=r.num_rows,
                )
            )
        return out

    def latest(self) -> Commit:
        return self._commits()[-1]

    def latest_version(self) -> int:
        return self.latest().version

    def commit_at(self, version: int) -> Commit:
        if version in self._cache:
            return self._cache[version]
        for c in self._commits():
            if c.version == version:
                return c
        raise VersionError(f"version {version} does not exist in {self.root}")

    def _write_log(self, c: Commit) -> int:
        """Commit: one JSON row at ``log/version=<n>/commit.json``, created exclusively."""
        now = int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1000)
        row = {
            "ts_ms": now,
            "operation": c.operation,
            "parameters": {k: str(v) for k, v in c.parameters.items()},
            "schema_json": c.schema.json(),
            "partition_cols": list(c.partition_cols),
            "properties": {k: str(v) for k, v in c.properties.items()},
            "generated": dict(c.generated),
            "not_null": list(c.not_null),
            "base": c.base,
            "added": list(c.added),
            "removed": list(c.removed),
            "feed": c.feed,
            "changes": [{"change_type": t, "path": p, "snapshot": v} for t, p, v in c.changes],
            "metrics": dict(c.metrics),
            "num_rows": c.num_rows,
        }
        try:
            fs.create_new(self.spark, f"{self.log_dir}/version={c.version}/commit.json", json.dumps(row) + "\n")
        except fs.AlreadyExists as e:
            raise ConcurrentCommitError(f"version {c.version} of {self.root} already committed") from e
        self._cache[c.version] = replace(c, ts_ms=now)
        return c.version

    def _next(self, base: Commit, operation: str, start: int | None, added: Sequence[str] = (), removed: Sequence[str] = (),
              changes: Sequence[tuple[str, str | None, int | None]] = (), parameters=None,
              metrics: Mapping[str, int] | None = None, **kw) -> int:
        """Commit the version after ``base``: the snapshot of version ``start`` (None: no rows)
        without ``removed``, plus ``added``. ``changes`` are what the commit changes, kept
        if the feed is on; with the feed off a commit that changes rows has no feed. ``metrics`` are its
        rows by kind; the rows of the version follow from them and ``start``."""
        changes, metrics = list(changes), dict(metrics or {})
        if operation == "OPTIMIZE":  # the same rows in other files
            num_rows = base.num_rows
        elif start is None:
            num_rows = metrics.get(INSERTED, 0)
        else:
            num_rows = self.commit_at(start).num_rows
            if num_rows is not None and start == base.version:
                num_rows += metrics.get(INSERTED, 0) - metrics.get(DELETED, 0)
        return self._write_log(Commit(
            version=base.version + 1,
            ts_ms=None,
            operation=operation,
            parameters=dict(parameters or {}),
            schema=kw.get("schema", base.schema),
            partition_cols=kw.get("partition_cols", base.partition_cols),
            properties=kw.get("properties", base.properties),
            generated=kw.get("generated", base.generated),
            not_null=kw.get("not_null", base.not_null),
            base=start,
            added=list(added),
            removed=list(removed),
            changes=changes if base.change_feed else [],
            feed=base.change_feed or not changes,
            metrics=metrics,
            num_rows=num_rows,
        ))

    # --------------------------------------------------------------- create
    @classmethod
    def create(
        cls,
        spark: SparkSession,
        root: str,
        schema: str | StructType,
        partition_by: Sequence[str] = (),
        properties: Mapping[str, str] | None = None,
        generated: Mapping[str, str] | None = None,
        not_null: Sequence[str] = (),
        mode: str = "create",
    ) -> "VersionedDataset":
        """Create a dataset (version 0, no rows) — or replace it with a new version.

        ``mode``: ``create`` (error if present), ``replace`` (error if absent),
        ``create_or_replace``, ``create_if_not_exists`` (no-op if present).
        Nullability in ``schema`` (``NOT NULL`` / ``nullable=False``) is added to
        ``not_null``; Parquet itself does not enforce it, our writes do.
        """
        ds = cls(spark, root)
        st = _as_schema(schema)
        nn = list(dict.fromkeys([*not_null, *[f.name for f in st.fields if not f.nullable]]))
        st = _nullable(st)
        _check_names(st)
        props = with_feed_default(spark, properties)
        for c in [*partition_by, *(generated or {}), *nn]:
            if c not in st.fieldNames():
                raise ValueError(f"unknown column {c!r}")
        present = ds.exists()
        if mode == "create" and present:
            raise VersionError(f"dataset already exists at {ds.root}")
        if mode == "replace" and not present:
            raise VersionError(f"no dataset to replace at {ds.root}")
        if mode == "create_if_not_exists" and present:
            return ds
        if mode not in ("create", "replace", "create_or_replace", "create_if_not_exists"):
            raise ValueError(f"unknown mode {mode!r}")
        common = dict(
            schema=st, partition_cols=list(partition_by), properties=props, generated=dict(generated or {}), not_null=nn
        )
        if present:
            base = ds.latest()
            op = "REPLACE TABLE" if mode == "replace" else "CREATE OR REPLACE TABLE"
            # Every old row goes; the feed reads them under the old version's schema.
            ds._next(base, op, None, changes=[(KIND_DELETE, None, base.version)], metrics=ds._all_deleted(base), **common)
        else:
            ds._write_log(Commit(0, None, "CREATE TABLE", {}, num_rows=0, **common))
        return ds

    @classmethod
    def for_path(cls, spark: SparkSession, root: str) -> "VersionedDataset":
        ds = cls(spark, root)
        if not ds.exists():
            raise VersionError(f"no versioned dataset at {ds.root}")
        return ds

    forPath = for_path  # noqa: N815  (reference spelling)

    @classmethod
    def from_dataframe(cls, spark, root, df: DataFrame, partition_by=(), properties=None, replace_existing: bool = False,
                       **kw) -> "VersionedDataset":
        """CREATE [OR REPLACE] TABLE ... AS SELECT: one commit holding ``df``'s rows."""
        ds = cls(spark, root)
        present = ds.exists()
        if present and not replace_existing:
            raise VersionError(f"dataset already exists at {ds.root}")
        st = StructType([StructField(f.name, _nullable(f.dataType), True) for f in df.schema.fields])
        _check_names(st)
        c = Commit(0, None, "CREATE TABLE AS SELECT", {}, st, list(partition_by), with_feed_default(spark, properties),
                   dict(kw.get("generated") or {}), list(kw.get("not_null") or []))
        version = ds.latest_version() + 1 if present else 0
        out = ds._write(c, ds._conform(c, df), version)
        entry, metrics = out[KIND_INSERT], row_metrics(out.rows)
        if present:
            base = ds.latest()
            ds._next(base, "CREATE OR REPLACE TABLE AS SELECT", None, [entry],
                     changes=[(KIND_DELETE, None, base.version), (KIND_INSERT, entry, None)], schema=st,
                     metrics=metrics | ds._all_deleted(base), partition_cols=c.partition_cols, properties=c.properties, generated=c.generated, not_null=c.not_null)
        else:
            changes = [(KIND_INSERT, entry, None)] if c.change_feed else []
            ds._write_log(replace(c, added=[entry], changes=changes, feed=c.change_feed, metrics=metrics,
                                  num_rows=metrics.get(INSERTED, 0)))
        return ds

    def _all_deleted(self, base: Commit) -> dict[str, int]:
        """Metrics of a commit that takes out every row of ``base`` (none where their number is unknown)."""
        return {DELETED: base.num_rows} if base.num_rows else {}

    @classmethod
    def save(cls, spark, root, df: DataFrame, mode: str = "errorifexists", **kw) -> "VersionedDataset":
        """``df.write.mode(mode).save(root)``: version 0 if nothing is there, else a new version."""
        ds = cls(spark, root)
        if not ds.exists():
            return cls.from_dataframe(spark, root, df, **kw)
        if mode == "overwrite":
            ds.overwrite(df)
        elif mode == "append":
            ds.append(df)
        elif mode in ("error", "errorifexists"):
            raise VersionError(f"dataset already exists at {ds.root}")
        elif mode != "ignore":
            raise ValueError(f"unknown mode {mode!r}")
        return ds

    @classmethod
    def adopt_parquet(cls, spark, root, parquet_path: str, partition_by=(), properties=None) -> "VersionedDataset":
        """Make an existing Parquet dataset version 0 without copying it (CONVERT).

        The partition columns of a partitioned folder (``p=value`` folders) are recorded.
        """
        ds = cls(spark, root)
        if ds.exists():
            raise VersionError(f"dataset already exists at {ds.root}")
        src = norm_path(fs.qualify(spark, parquet_path))
        schema = spark.read.parquet(src).schema
        found, folder = [], src
        while nested := [n for n in fs.list_names(spark, folder) if re.fullmatch(r"[^_.=][^=]*=.*", n)]:
            found.append(nested[0].split("=", 1)[0])
            folder = f"{folder}/{nested[0]}"
        if partition_by and list(partition_by) != found:
            raise ValueError(f"{src} is partitioned by {found}, not by {list(partition_by)}")
        props = with_feed_default(spark, properties)
        _check_names(schema)
        n = spark.read.parquet(src).count()  # from the file footers
        c = Commit(0, None, "CONVERT", {"source": src}, schema, found, props, {}, [], added=[src], num_rows=n)
        changes = [(KIND_INSERT, src, None)] if c.change_feed else []
        ds._write_log(replace(c, changes=changes, feed=c.change_feed))
        return ds

    # ----------------------------------------------------------------- read
    def _read_folders(self, c: Commit, folders: Sequence[str], meta: Sequence[str] = (), names: Iterable[str] = ()) -> DataFrame:
        """Rows of whole folders, in schema order.

        ``meta`` adds hidden file metadata per scan: ``"__file"`` (file path), ``"__row"``
        (row index inside the file), ``"__size"``. It must be taken on each scan, before any union.
        ``names``: only files called so are listed (names without special characters of a glob).
        """
        if not folders:
            empty = empty_df(self.spark, c.schema)
            for m in meta:
                empty = empty.withColumn(m, F.lit(None).cast("string" if m == "__file" else "bigint"))
            return empty
        r = self.spark.read.schema(c.schema)
        if names:
            r = r.option("pathGlobFilter", "{" + ",".join(sorted(names)) + "}")
        if not c.partition_cols:
            return _with_meta(r.parquet(*folders), c, meta)
        # Partitioned folders of different commits cannot be read in one call;
        # read each with its own basePath (pruning works per branch).
        parts = [_with_meta(r.option("basePath", p).parquet(p), c, meta) for p in folders]
        return reduce(DataFrame.unionByName, parts)

    def _read_commit(self, c: Commit, meta: Sequence[str] = (), files: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version; with ``files``, of those of its files only.

        Files are left out or picked by their path, which prunes the listing: no file
        name is passed to a reader, so partition columns stay.
        """
        folders, removed = self.snapshot(c)
        if files is None and not removed:
            return self._read_folders(c, folders, meta)
        rows = self._read_folders(c, folders, tuple(dict.fromkeys(("__file", *meta))))
        if removed:
            rows = rows.where(~F.col("__file").isin(removed))
        if files is not None:
            files = list(files)
            rows = rows.where(F.col("__file").isin(files)) if files else rows.where(F.lit(False))
        return rows if "__file" in meta else rows.drop("__file")

    def to_df(self, version: int | None = None, timestamp: str | _dt.datetime | None = None) -> DataFrame:
        """Snapshot as a DataFrame: latest, ``version`` or the version current at
        ``timestamp`` (time travel, read-only)."""
        if timestamp is not None:
            version = self.version_as_of_timestamp(timestamp)
        c = self.latest() if version is None else self.commit_at(version)
        return self._read_commit(c)

    def toDF(self, version: int | None = None) -> DataFrame:  # noqa: N802  (reference spelling)
        return self.to_df(version)

    def restoreToVersion(self, version: int) -> int:  # noqa: N802
        return self.restore(version)

    def version_as_of_timestamp(self, ts: str | _dt.datetime) -> int:
        t = self._millis(ts)
        older = [c.version for c in self._commits() if c.ts_ms <= t]
        if not older:
            raise VersionError(f"no version at or before {ts}")
        return max(older)

    def _millis(self, ts: str | _dt.datetime) -> int:
        """A time as Spark reads it: text in the session's time zone, a datetime as Spark
        takes one (naive ones as ``collect`` gives them), in milliseconds."""
        at = F.lit(ts if isinstance(ts, _dt.datetime) else str(ts)).cast("timestamp")
        return self.spark.range(1).select(F.unix_millis(at)).first()[0]

    def history(self, limit: int | None = None) -> DataFrame:
        """One row per commit, newest first (``limit`` = last n commits)."""
        h = self.log_frame().select(
            "version",
            F.timestamp_millis("ts_ms").alias("timestamp"),
            "operation",
            F.col("parameters").alias("operation_parameters"),
            F.size("added").alias("num_added"),
            F.size("removed").alias("num_removed"),
            "metrics",
            "num_rows",
        ).orderBy(F.desc("version"))
        return h.limit(limit) if limit is not None else h

    # ------------------------------------------------------------ writing
    def _new_dir(self, version: int, prefix: str = "data") -> str:
        return f"{self.root}/{prefix}/{version}-{uuid.uuid4().hex[:12]}"

    def _conform(self, c: Commit, df: DataFrame, by_position: bool = False, passthrough: Sequence[str] = (),
                 recompute_generated: bool = False) -> DataFrame:
        """Bind to the schema, compute generated columns, guard NOT NULL — all inside the
        write job (``raise_error``), so no extra pass over the data.

        Supplied values of generated columns are verified (appends); with
        ``recompute_generated`` (row rewrites) they are dropped and recomputed from
        the new row.
        """
        names = c.schema.fieldNames()
        if recompute_generated:
            df = df.drop(*[g for g in c.generated if g in df.columns])
        if by_position:
            if len(df.columns) == len(names) - len([g for g in c.generated if g not in df.columns]) and len(
                df.columns
            ) < len(names):
                df = df.toDF(*[n for n in names if n not in c.generated])
            else:
                df = bind_by_position(df, c.schema)
        missing = [n for n in names if n not in df.columns and n not in c.generated]
        extra = [n for n in df.columns if n not in names and n not in passthrough]
        if missing or extra:
            raise ValueError(f"schema mismatch: missing {missing}, unexpected {extra}")
        cols = []
        for f in c.schema.fields:
            if f.name in c.generated:
                g = F.expr(c.generated[f.name]).cast(f.dataType)
                if f.name in df.columns:
                    v = _c(f.name).cast(f.dataType)
                    g = F.when(
                        ~v.eqNullSafe(g), F.raise_error(F.lit(f"generated column {f.name} does not match its expression"))
                    ).otherwise(v)
                cols.append(g.alias(f.name))
            else:
                cols.append(_c(f.name).cast(f.dataType).alias(f.name))
        out = df.select(*cols, *passthrough)
        if c.not_null:
            guarded = []
            for f in c.schema.fields:
                col = _c(f.name)
                if f.name in c.not_null:
                    col = F.when(col.isNull(), F.raise_error(F.lit(f"NOT NULL violated by column {f.name}"))).otherwise(col)
                guarded.append(col.alias(f.name))
            out = out.select(*guarded, *passthrough)
        return out

    def _write(self, c: Commit, df: DataFrame, version: int, by_kind: bool = False) -> "Written":
        """Write rows as one new immutable folder. Returns {kind: entry path}, with the rows written by kind.

        Rows are counted inside the write job, right before the writer, where a task's counts are taken
        once however often it runs. A row-kind column is counted by and, unless ``by_kind``, left out.
        """
        path = self._new_dir(version)
        parts = ([KIND] if by_kind else []) + list(c.partition_cols)
        if c.partition_cols:
            # one partition value's rows together, so not every task writes every folder;
            # large values are split again by AQE
            df = df.hint("rebalance", *[_c(p) for p in c.partition_cols])
        seen = Observation()
        kinds = (KIND_KEEP, KIND_PRE, KIND_POST, KIND_INSERT, KIND_DELETE) if KIND in df.columns else ()
        counts = [F.count_if(F.col(KIND) == k).alias(k) for k in kinds] or [F.count(F.lit(1)).alias(KIND_INSERT)]
        df = df.observe(seen, *counts)
        if kinds and not by_kind:
            df = df.drop(KIND)
        w = df.write.mode("errorifexists")
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(path)
        out = Written({k: int(n) for k, n in seen.get.items() if n})
        if not by_kind:
            out[KIND_INSERT] = path
        else:
            names = [n for n in fs.list_names(self.spark, path) if n.startswith(f"{KIND}=")]
            out.update((n.split("=", 1)[1], f"{path}/{n}") for n in names)
        return out

    def append(self, df: DataFrame, by_position: bool = False, operation: str = "WRITE") -> int:
        """INSERT INTO: previous entries + one new folder; nothing is rewritten."""
        base = self.latest()
        out = self._write(base, self._conform(base, df, by_position), base.version + 1)
        entry = out[KIND_INSERT]
        return self._next(base, operation, base.version, [entry], changes=[(KIND_INSERT, entry, None)],
                          parameters={"mode": "Append"}, metrics=row_metrics(out.rows))

    def insert_values(self, rows: Iterable[tuple]) -> int:
        """INSERT INTO t VALUES (...), bound by position."""
        base = self.latest()
        writable = [f for f in base.schema.fields if f.name not in base.generated]
        df = literal_df(self.spark, rows, StructType([StructField(f.name, f.dataType) for f in writable]))
        return self.append(df, operation="WRITE")

    def overwrite(self, df: DataFrame, by_position: bool = False, operation: str = "WRITE") -> int:
        """Replace all rows; old folders stay for time travel (never overwrite in place)."""
        base = self.latest()
        out = self._write(base, self._conform(base, df, by_position), base.version + 1)
        entry = out[KIND_INSERT]
        changes = [(KIND_DELETE, None, base.version), (KIND_INSERT, entry, None)]
        return self._next(base, operation, None, [entry], changes=changes, parameters={"mode": "Overwrite"},
                          metrics=row_metrics(out.rows) | self._all_deleted(base))

    # ------------------------------------------------- file-level rewrite
    def _with_file(self, c: Commit, row: bool = False) -> DataFrame:
        return self._read_commit(c, meta=("__file", "__row") if row else ("__file",))

    def _rewrite(self, base: Commit, operation: str, cond: Column, transform, params: dict) -> int:
        """Shared body of update/delete: find files, rewrite them, commit."""
        # Paths of the files to rewrite, as many as the commit takes out, with the rows that match.
        found = self._with_file(base).where(cond).groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()
        if not found:
            return self._next(base, operation, base.version, parameters=params)
        touched, matched = sorted(r["__file"] for r in found), sum(r["n"] for r in found)
        old = self._read_commit(base, files=touched)
        by_kind = base.change_feed
        out = self._write(base, transform(old, by_kind), base.version + 1, by_kind=by_kind)
        data = [out[k] for k in DATA_KINDS if k in out]
        changes = [(k, out[k], None) for k in (KIND_PRE, KIND_POST, KIND_INSERT, KIND_DELETE) if k in out]
        rows = row_metrics(out.rows | ({KIND_DELETE: matched} if operation == "DELETE" else {}))
        return self._next(base, operation, base.version, data, touched, changes if by_kind else [(KIND_POST, None, None)], params,
                          metrics=rows)

    def update(self, set: Mapping[str, str | Column], condition: str | Column | None = None) -> int:
        """UPDATE t SET ... WHERE p. Rows where p is NULL are left alone; every SET
        expression sees the old row."""
        base = self.latest()
        cond = is_true(condition) if condition is not None else F.lit(True)
        set_cols = {rowops.column_name(k, base.schema.fieldNames()): as_column(v) for k, v in set.items()}
        unknown = [k for k in set_cols if k not in base.schema.fieldNames()]
        if unknown:
            raise ValueError(f"unknown columns in SET: {unknown}")

        def transform(old: DataFrame, by_kind: bool) -> DataFrame:
            if by_kind:
                return self._conform(base, rowops.update_kinds(old, set_cols, cond), passthrough=[KIND],
                                     recompute_generated=True)
            marked = old.withColumn(KIND, F.when(cond, F.lit(KIND_POST)).otherwise(F.lit(KIND_KEEP)))
            return self._conform(base, rowops.update_rows(marked, set_cols, F.col(KIND) == KIND_POST), passthrough=[KIND],
                                 recompute_generated=True)

        return self._rewrite(base, "UPDATE", cond, transform, {"predicate": str(condition)})

    def delete(self, condition: str | Column | None = None) -> int:
        """DELETE FROM t [WHERE p]. Rows where p is NULL are kept."""
        base = self.latest()
        if condition is None:
            return self._next(base, "DELETE", None, changes=[(KIND_DELETE, None, base.version)], parameters={},
                              metrics=self._all_deleted(base))
        cond = is_true(condition)

        def transform(old: DataFrame, by_kind: bool) -> DataFrame:
            rows = rowops.delete_kinds(old, cond)
            return rows if by_kind else rows.where(F.col(KIND) == KIND_KEEP)

        return self._rewrite(base, "DELETE", cond, transform, {"predicate": str(condition)})

    # ---------------------------------------------------------------- merge
    def alias(self, name: str) -> "_AliasedTarget":
        return _AliasedTarget(self, name)

    def merge(self, source: DataFrame, condition: str | Column | Sequence[str], target_alias: str = "t",
              source_alias: str | None = None, null_safe: bool = False) -> "MergeBuilder":
        return MergeBuilder(self, source, condition, target_alias, source_alias or dataframe_alias(source) or "s", null_safe)

    # --------------------------------------------------- restore, clones
    def _differing(self, a: Commit, b: Commit) -> tuple[DataFrame, DataFrame]:
        """Rows of the files only ``a`` holds and of the files only ``b`` holds.

        Files both versions share hold identical rows and cancel in any multiset
        difference, so they are never read. What differs follows from the commit rows:
        folders only one version has, and files only one version took out.
        """
        (fa, ra), (fb, rb) = self.snapshot(a), self.snapshot(b)

        def only(c: Commit, mine, my_removed, theirs, their_removed) -> DataFrame:
            own = self._read_folders(c, [p for p in mine if p not in set(theirs)], ("__file",))
            if my_removed:
                own = own.where(~F.col("__file").isin(my_removed))
            shared, gone = [p for p in mine if p in set(theirs)], sorted(set(their_removed) - set(my_removed))
            if shared and gone:
                own = own.unionByName(self._read_folders(c, shared, ("__file",)).where(F.col("__file").isin(gone)))
            return own.drop("__file")

        return only(a, fa, ra, fb, rb), only(b, fb, rb, fa, ra)

    def diff(self, old_version: int, new_version: int, keys: Sequence[str] | None = None, columns: bool = False) -> DataFrame:
        """What changed between two versions (J8): by key (``rowops.diff_by_key``; with ``columns``, which
        columns of a changed row) or, without keys, as a multiset of rows (``rowops.diff_rows``). Reads the
        files the two versions do not share (plus the key columns of the rest). Versions of
        different schemas are aligned by column name."""
        a, b = self.commit_at(old_version), self.commit_at(new_version)
        only_old, only_new = self._differing(a, b)
        if keys is None:
            return rowops.diff_rows(only_old, only_new)
        return rowops.diff_by_key(self._read_commit(a), self._read_commit(b), keys,
                                  changed_rows=(only_old, only_new), columns=columns)

    def restore(self, version: int) -> int:
        """RESTORE: a new version equal to ``version``; no data copied.

        With the change feed on, the change rows are the multiset difference of
        the two versions, computed over the files they do not share only.
        """
        base = self.latest()
        old = self.commit_at(version)
        changes, metrics = [], {}
        if base.change_feed:
            if base.schema == old.schema:
                cur_only, old_only = self._differing(base, old)
                diff = cur_only.exceptAll(old_only).withColumn(KIND, F.lit(KIND_DELETE)).unionByName(
                    old_only.exceptAll(cur_only).withColumn(KIND, F.lit(KIND_INSERT))
                )
                out = self._write(base, diff, base.version + 1, by_kind=True)
                metrics = row_metrics(out.rows)
                changes = [(k, out[k], None) for k in (KIND_INSERT, KIND_DELETE) if k in out]
            else:  # schema changed: every current row goes, every old row comes back
                changes = [(KIND_DELETE, None, base.version), (KIND_INSERT, None, old.version)]
        else:
            changes = [(KIND_INSERT, None, old.version)]
        return self._next(
            base, "RESTORE", old.version, changes=changes, parameters={"version": version}, metrics=metrics,
            schema=old.schema, partition_cols=old.partition_cols, generated=old.generated, not_null=old.not_null,
        )

    def clone(self, target_root: str, shallow: bool = True, version: int | None = None) -> "VersionedDataset":
        """SHALLOW CLONE shares the files (log row only); DEEP CLONE copies them.
        Either way the clone has its own history: later writes never touch the source."""
        src = self.latest() if version is None else self.commit_at(version)
        tgt = VersionedDataset(self.spark, target_root)
        if tgt.exists():
            raise VersionError(f"dataset already exists at {tgt.root}")
        paths, removed = self.snapshot(src)
        if not shallow:
            paths, removed = ([tgt._write(src, self._read_commit(src), 0)[KIND_INSERT]] if paths else []), []
        changes = [(KIND_INSERT, None, 0)] if src.change_feed and paths else []
        op = "SHALLOW CLONE" if shallow else "DEEP CLONE"
        tgt._write_log(
            Commit(0, None, op, {"source": self.root, "sourceVersion": src.version}, src.schema, src.partition_cols,
                   src.properties, src.generated, src.not_null, None, paths, removed, changes, src.change_feed or not paths,
                   num_rows=src.num_rows)
        )
        return tgt

    # ---------------------------------------------------------- change feed
    def changes(self, starting_version: int, ending_version: int | None = None) -> DataFrame:
        """Row-level changes of commits ``starting_version..ending_version`` (inclusive;
        the end clamps to the latest version). Columns: data + ``_change_type``,
        ``_commit_version``, ``_commit_timestamp``."""
        commits = self._commits()
        latest = commits[-1].version
        if starting_version > latest:
            raise VersionError(f"starting version {starting_version} is after the latest version {latest}")
        end = latest if ending_version is None else min(ending_version, latest)
        return self._changes_of([c for c in commits if starting_version <= c.version <= end])

    def changes_between_timestamps(self, start: str | _dt.datetime, end: str | _dt.datetime | None = None) -> DataFrame:
        commits = self._commits()
        lo, hi = self._millis(start), (self._millis(end) if end is not None else None)
        if lo > commits[-1].ts_ms:
            raise VersionError(f"starting timestamp {start} is after the latest commit")
        chosen = [c for c in commits if c.ts_ms >= lo and (hi is None or c.ts_ms <= hi)]
        if not chosen:
            raise VersionError(f"no commit between {start} and {end}")
        return self._changes_of(chosen)

    def _changes_of(self, commits: Sequence[Commit]) -> DataFrame:
        """Change rows of ``commits``. Raises where a commit changed rows while the feed was off, or
        where a column changed its type between them: the feed is complete or an error."""
        if not commits:
            raise VersionError("empty version range")
        silent = [c.version for c in commits if not c.feed]
        if silent:
            raise VersionError(f"the change feed was off in versions {silent} of {self.root}")
        latest = commits[-1]
        # Folders of the same schema, kind and layout are read in one scan; which commit a row is of
        # follows from its file: the folder's name starts with the version.
        groups: dict[tuple, list[tuple[Commit, str]]] = {}
        whole = []
        for c in commits:
            for kind, folder, version in c.changes:
                if folder is None:
                    whole.append((c, kind, self.commit_at(version)))
                else:
                    key = (kind, c.schema.json(), tuple(c.partition_cols), f"{self.root}/data/{c.version}-" in folder or c.version)
                    groups.setdefault(key, []).append((c, folder))
        parts = []
        times = F.create_map(*[x for c in commits for x in (F.lit(c.version), F.lit(c.ts_ms))])
        for (kind, _, _, own), found in groups.items():
            first = found[0][0]
            if own is True:
                rows = self._read_folders(first, [p for _, p in found], ("__file",))
                number = F.regexp_extract("__file", r".*/data/(\d+)-[0-9a-f]{12}/", 1).cast("int")
            else:
                rows = self._read_folders(first, [p for _, p in found], ("__file",))
                number = F.lit(first.version)
            parts.append((first.schema, kind, rows.withColumn("__v", number).drop("__file")))
        for c, kind, of in whole:
            parts.append((of.schema, kind, self._read_commit(of).withColumn("__v", F.lit(c.version))))
        types: dict[str, str] = {}
        for st, _, _ in parts:
            for f in st.fields:
                if types.setdefault(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
                    raise VersionError(f"column {f.name} changes its type within the version range")
        if not parts:
            parts = [(latest.schema, KIND_INSERT, empty_df(self.spark, latest.schema).withColumn("__v", F.lit(0)))]
        out = [
            rows.select(
                *[_c(n) for n in st.fieldNames()], F.lit(CHANGE_TYPE[kind]).alias("_change_type"),
                F.col("__v").cast("bigint").alias("_commit_version"),
                F.timestamp_millis(times[F.col("__v")]).alias("_commit_timestamp"),
            )
            for st, kind, rows in parts
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), out)

    def set_properties(self, **props: str) -> int:
        """ALTER TABLE ... SET TBLPROPERTIES: a metadata-only commit."""
        base = self.latest()
        merged = {**base.properties, **{k: str(v) for k, v in props.items()}}
        return self._next(base, "SET TBLPROPERTIES", base.version, parameters=props, properties=merged)


def with_feed_default(spark: SparkSession, properties: Mapping[str, str] | None) -> dict[str, str]:
    """Table properties with the session's default for the change feed."""
    props = dict(properties or {})
    if not any(k.rsplit(".", 1)[-1] == CHANGE_FEED_PROPERTY for k in props):
        default = spark.conf.get(CHANGE_FEED_DEFAULT_CONF, None)
        if default is not None:
            props[CHANGE_FEED_PROPERTY] = default
    return props


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def dataframe_alias(df: DataFrame) -> str | None:
    """The name given by ``df.alias(name)``, if the DataFrame's top node is that alias."""
    plan = df._jdf.queryExecution().analyzed()
    return str(plan.alias()) if plan.nodeName() == "SubqueryAlias" else None


def is_stable(df: DataFrame) -> bool:
    """Whether every evaluation gives the same rows: scans, filters and projections of stored rows, no more."""
    plan = df._jdf.queryExecution().analyzed()
    if not plan.deterministic():
        return False
    stack = [plan]
    while stack:
        node = stack.pop()
        if node.nodeName() not in STABLE_NODES:
            return False
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return True


class _AliasedTarget:
    def __init__(self, ds: VersionedDataset, name: str):
        self.ds, self.name = ds, name

    def merge(self, source: DataFrame, condition, source_alias: str | None = None) -> "MergeBuilder":
        """``source_alias`` defaults to the source's own ``df.alias(...)``, else ``s``."""
        return MergeBuilder(self.ds, source, condition, self.name, source_alias or dataframe_alias(source) or "s")


class MergeBuilder:
    """``merge(source, cond).when_matched_update(set=...).when_not_matched_insert_all().execute()``.

    Null keys never match: such source rows are inserted and target rows kept.
    More than one source row for one target row raises ``AmbiguousMergeError``.
    """

    def __init__(self, ds, source, condition, target_alias, source_alias, null_safe: bool = False):
        self.ds, self.source, self.condition = ds, source, condition
        self.ta, self.sa = target_alias, source_alias
        self.null_safe = null_safe  # named keys: NULL matches NULL
        self.update_set: dict | None = None
        self.update_all = False
        self.insert_values: dict | None = None
        self.insert_all = False

    # The same builder under the reference's method names, so its calls port unchanged.
    def whenMatchedUpdate(self, set):  # noqa: N802
        return self.when_matched_update(set)

    def whenMatchedUpdateAll(self):  # noqa: N802
        return self.when_matched_update_all()

    def whenNotMatchedInsert(self, values):  # noqa: N802
        return self.when_not_matched_insert(values)

    def whenNotMatchedInsertAll(self):  # noqa: N802
        return self.when_not_matched_insert_all()

    def _prune_by_stats(self, base: Commit, source: DataFrame, keys: Sequence[str] | None) -> list[str] | None:
        """Target files that can match, when the merge key is one column with stored per-file
        stats (a clustered dataset): those whose [min, max] overlaps the source's key range.
        None = scan all."""
        if not keys or len(keys) != 1 or self.null_safe:
            return None
        from lakeops.operators import layout  # layout builds on this module

        lo, hi = source.agg(F.min(_c(keys[0])), F.max(_c(keys[0]))).first()  # two values
        return layout.files_between(self.ds, keys[0], lo, hi, base.version)

    def when_matched_update(self, set: Mapping[str, str | Column]) -> "MergeBuilder":
        names = self.ds.latest().schema.fieldNames()
        self.update_set = {rowops.column_name(k, names): v for k, v in set.items()}  # 't.c' and 'c' both name target c
        return self

    def when_matched_update_all(self) -> "MergeBuilder":
        self.update_all = True
        return self

    def when_not_matched_insert(self, values: Mapping[str, str | Column]) -> "MergeBuilder":
        names = self.ds.latest().schema.fieldNames()
        self.insert_values = {rowops.column_name(k, names): v for k, v in values.items()}
        return self

    def when_not_matched_insert_all(self) -> "MergeBuilder":
        self.insert_all = True
        return self

    def execute(self, properties: Mapping[str, str] | None = None, stage_source: bool | None = None) -> int:
        """Run the merge as one commit; ``properties`` are set in that same commit.

        The source is read more than once (match check, rewrite, inserts). One that is only
        scans, filters and projections of stored rows is re-read; any other (joins,
        aggregates, limits, ``rand()``, UDFs) is first written once to ``_staging``, so every
        pass and every task retry sees the same rows. ``stage_source`` forces either way.
        """
        ds = self.ds
        base = ds.latest()
        source = self.source
        if stage_source is None:
            stage_source = not is_stable(source)
        if stage_source:
            stage = ds._new_dir(base.version + 1, "_staging")
            source.write.mode("errorifexists").parquet(stage)
            source = ds.spark.read.schema(self.source.schema).parquet(stage)

        condition = self.condition
        if not isinstance(condition, (list, tuple)):
            condition = rowops.equal_keys(condition, self.ta, self.sa) or condition
        keys = list(condition) if isinstance(condition, (list, tuple)) else None
        target = ds._with_file(base, row=True)
        pruned = self._prune_by_stats(base, source, keys)
        if pruned is not None:
            target = ds._read_commit(base, ("__file", "__row"), pruned)
        plan = rowops.merge_plan(
            target, source, condition, self.ta, self.sa, base.schema.fieldNames(),
            update_set=self.update_set, update_all=self.update_all,
            insert_values=self.insert_values, insert_all=self.insert_all, optional=list(base.generated),
            null_safe=self.null_safe,
        )
        props = {**base.properties, **{k: str(v) for k, v in (properties or {}).items()}}
        if plan.update is None:  # no target row changes: an append of the source rows without a match
            rows = plan.inserts(target)
            if rows is None:
                return ds._next(base, "MERGE", base.version, parameters={"predicate": str(self.condition)}, properties=props)
            if ds.snapshot(base)[0]:
                _refuse_pairing(rows)
            out = ds._write(base, ds._conform(base, rows.drop(KIND), recompute_generated=True), base.version + 1)
            if not out.rows:
                return ds._next(base, "MERGE", base.version, parameters={"predicate": str(self.condition)}, properties=props)
            return ds._next(base, "MERGE", base.version, [out[KIND_INSERT]], changes=[(KIND_INSERT, out[KIND_INSERT], None)],
                            parameters={"predicate": str(self.condition)}, metrics=row_metrics(out.rows), properties=props)
        touched_df = plan.touched_files("__file", "__row")
        if ds.snapshot(base)[0]:  # an empty target pairs with nothing
            _refuse_pairing(touched_df)
        # One job: per touched file, the largest number of source rows matched by one target row.
        per_file = touched_df.collect()  # one row per touched file
        if any(r["n"] > 1 for r in per_file):
            raise AmbiguousMergeError("several source rows match the same target row")
        touched = sorted(r["__file"] for r in per_file)
        old = ds._read_commit(base, files=touched) if touched else empty_df(ds.spark, base.schema)
        by_kind = base.change_feed
        rows = plan.rows(old, with_kind=True, emit_pre=by_kind)
        out = ds._write(base, ds._conform(base, rows, passthrough=[KIND], recompute_generated=True), base.version + 1, by_kind=by_kind)
        data = [out[k] for k in DATA_KINDS if k in out]
        changes = [(k, out[k], None) for k in (KIND_PRE, KIND_POST, KIND_INSERT) if k in out]
        return ds._next(base, "MERGE", base.version, data, touched, changes if by_kind else [(KIND_POST, None, None)],
                        {"predicate": str(self.condition)}, metrics=row_metrics(out.rows), properties=props)


def _refuse_pairing(joined: DataFrame) -> None:
    """The source has no join of its own here (it would have been staged): only the condition can give one."""
    physical = joined._jdf.queryExecution().executedPlan().toString()  # planning only, no job
    if "NestedLoopJoin" in physical or "CartesianProduct" in physical:
        raise ValueError(
            "merge condition needs an equality between a target and a source column "
            "(without one every target row is compared with every source row)"
        )


def _with_meta(df: DataFrame, c: Commit, meta: Sequence[str]) -> DataFrame:
    cols = [F.col(f"`{n}`") for n in c.schema.fieldNames()]
    extra = {"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index"),
             "__size": F.col("_metadata.file_size")}
    return df.select(*cols, *[extra[m].alias(m) for m in meta])


class DatasetBuilder:
    """Column-by-column definition of a dataset (B4, B5, B9)::

        DatasetBuilder.create(spark).location(root)
            .add_column("c1", "INT", nullable=False)
            .add_column("c2", IntegerType(), generated_always_as="c1 + 1")
            .partitioned_by("c1").property("enableChangeDataFeed", "true")
            .execute()

    ``create`` fails if the dataset exists, ``replace`` if it does not;
    ``create_or_replace`` and ``create_if_not_exists`` as their names say.
    """

    def __init__(self, spark: SparkSession, mode: str):
        self.spark, self.mode = spark, mode
        self._root: str | None = None
        self._fields: list[StructField] = []
        self._generated: dict[str, str] = {}
        self._not_null: list[str] = []
        self._partition: list[str] = []
        self._props: dict[str, str] = {}

    @classmethod
    def create(cls, spark):
        return cls(spark, "create")

    @classmethod
    def replace(cls, spark):
        return cls(spark, "replace")

    @classmethod
    def create_or_replace(cls, spark):
        return cls(spark, "create_or_replace")

    @classmethod
    def create_if_not_exists(cls, spark):
        return cls(spark, "create_if_not_exists")

    def location(self, root: str) -> "DatasetBuilder":
        self._root = root
        return self

    def table_name(self, name: str, catalog=None) -> "DatasetBuilder":
        """Address the dataset by name in ``catalog`` (default: ``Catalog.default``, under
        the session's warehouse folder)."""
        self._name, self._catalog = name, catalog
        return self

    def add_column(self, name: str, data_type, nullable: bool = True,
                   generated_always_as: str | None = None) -> "DatasetBuilder":
        t = StructType.fromDDL(f"`{name}` {data_type}").fields[0].dataType if isinstance(data_type, str) else data_type
        self._fields.append(StructField(name, t, True))
        if not nullable:
            self._not_null.append(name)
        if generated_always_as:
            self._generated[name] = generated_always_as
        return self

    def add_columns(self, schema: StructType) -> "DatasetBuilder":
        for f in schema.fields:
            self.add_column(f.name, f.dataType, f.nullable)
        return self

    def partitioned_by(self, *cols: str) -> "DatasetBuilder":
        self._partition = list(cols)
        return self

    def property(self, key: str, value: str) -> "DatasetBuilder":
        self._props[key] = str(value)
        return self

    def execute(self) -> VersionedDataset:
        kw = dict(partition_by=self._partition, properties=self._props, generated=self._generated,
                  not_null=self._not_null, mode=self.mode)
        if getattr(self, "_name", None):
            from lakeops.plans.catalog import Catalog  # the catalog builds on this module

            cat = self._catalog or Catalog.default(self.spark)
            return cat.create(self._name, StructType(self._fields), **kw)
        if self._root is None:
            raise ValueError("location(root) or table_name(name) is required")
        return VersionedDataset.create(self.spark, self._root, StructType(self._fields), **kw)

    # Reference spellings.
    createOrReplace = create_or_replace  # noqa: N815
    createIfNotExists = create_if_not_exists  # noqa: N815

    def tableName(self, name, catalog=None):  # noqa: N802
        return self.table_name(name, catalog)

    def addColumn(self, colName, dataType, nullable=True, generatedAlwaysAs=None):  # noqa: N802, N803
        return self.add_column(colName, dataType, nullable, generatedAlwaysAs)

    def addColumns(self, cols):  # noqa: N802
        return self.add_columns(cols)

    def partitionedBy(self, *cols):  # noqa: N802
        return self.partitioned_by(*cols)
