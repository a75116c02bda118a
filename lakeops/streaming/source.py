"""The change feed as a streaming data source (A9, L4, L5), on Spark's Python data source API.

    spark.readStream.format("lakeops_changes").option("root", root).option("startingVersion", 0).load()

Offsets are versions: a micro-batch holds the commits between two of them, so a restart from a checkpoint delivers each commit
once. A partition is one file of change rows, read as Arrow batches by a task straight from where the commit put it. Nothing is copied
and no other query runs: stopping the returned query stops everything.

Commits made with the feed off, or under another schema than the starting version's, end the stream with an error, as in the batch
feed. Files are opened with ``pyarrow.fs``, so the dataset must be in a file system that it knows (local or mounted, HDFS, S3, GCS);
for any other, ``changes.deliver_changes`` reads the same rows with Spark's own readers.

This module is sent to the Python workers by value: it imports nothing of this package.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

FORMAT = "lakeops_changes"
# Public change-type names, by the row kind a commit records.
CHANGE_TYPES = {"insert": "insert", "delete": "delete", "pre": "update_preimage", "post": "update_postimage"}


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _plain(uri: str) -> str:
    return re.sub(r"^file:/+", "file:///", uri)


class Log:
    """The commit rows of a dataset, read without Spark (the planner of a Python source has no session)."""

    def __init__(self, root: str):
        self.root = root
        self.rows: dict[int, dict] = {}

    def versions(self) -> list[int]:
        from pyarrow import fs

        system, path = _file_system(f"{self.root}/log")
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted(int(f.base_name.split("=", 1)[1]) for f in found if f.base_name.startswith("version="))

    def commit(self, version: int) -> dict:
        if version not in self.rows:
            system, path = _file_system(f"{self.root}/log/version={version}/commit.json")
            with system.open_input_stream(path) as f:
                self.rows[version] = json.loads(f.read())
        return self.rows[version]

    def snapshot(self, version: int) -> tuple[list[str], set[str]]:
        """The folders of a version, and the files in them that do not belong to it."""
        folders, gone, at = [], set(), version
        while at is not None:
            row = self.commit(at)
            folders = [*row["added"], *folders]
            gone |= {name for f in row["removed"] for name in (_plain(f), unquote(_plain(f)))}  # Spark names files as URIs
            at = row["base"]
        return folders, gone


def files_in(folder: str) -> Iterator[str]:
    """Data files under a folder, as paths inside it."""
    from pyarrow import fs

    system, path = _file_system(folder)
    for f in system.get_file_info(fs.FileSelector(path, recursive=True)):
        inside = f.path[len(path.rstrip("/")) + 1 :]
        if f.is_file and not any(re.match(r"[_.]", part) and "=" not in part for part in inside.split("/")):
            yield inside


@dataclass
class ChangeFile(InputPartition):
    folder: str
    file: str  # path inside the folder
    values: dict  # partition columns, as texts (None: null)
    change_type: str
    version: int
    ts_ms: int


class ChangeFeedReader(DataSourceStreamReader):
    def __init__(self, options, schema: StructType):
        self.log = Log(_plain(options["root"]).rstrip("/"))
        self.first = int(options.get("startingversion", options.get("startingVersion", 0)))
        self.out = schema
        self.data = StructType(schema.fields[:-3])

    def initialOffset(self) -> dict:  # noqa: N802
        return {"version": self.first - 1}

    def latestOffset(self, *_) -> dict:  # noqa: N802
        versions = self.log.versions()
        return {"version": max(versions[-1] if versions else -1, self.first - 1)}

    def partitions(self, start: dict, end: dict) -> list[ChangeFile]:
        out = []
        for version in range(start["version"] + 1, end["version"] + 1):
            row = self.log.commit(version)
            if not row["feed"]:
                raise ValueError(f"the change feed was off in version {version} of {self.log.root}")
            for change in row["changes"]:
                of = row if change["path"] else self.log.commit(change["snapshot"])
                if StructType.fromJson(json.loads(of["schema_json"])).simpleString() != self.data.simpleString():
                    raise ValueError(f"version {version} of {self.log.root} has another schema than the stream")
                folders, gone = ([change["path"]], set()) if change["path"] else self.log.snapshot(change["snapshot"])
                for folder in folders:
                    for file in files_in(folder):
                        if f"{_plain(folder).rstrip('/')}/{file}" in gone:
                            continue
                        named = dict(p.split("=", 1) for p in file.split("/")[:-1] if "=" in p)
                        values = {
                            unquote(c): None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v)
                            for c, v in named.items() if unquote(c) in of["partition_cols"]
                        }
                        out.append(ChangeFile(folder, file, values, CHANGE_TYPES[change["change_type"]], version, row["ts_ms"]))
        return out

    def read(self, partition: ChangeFile):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_type

        system, folder = _file_system(partition.folder)
        with system.open_input_file(f"{folder.rstrip('/')}/{partition.file}") as source:
            file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            stored = [f.name for f in self.data.fields if f.name in file.schema_arrow.names]
            for batch in file.iter_batches(columns=stored):
                n, columns = batch.num_rows, []
                for f in self.data.fields:
                    kind = to_arrow_type(f.dataType)
                    if f.name in stored:
                        columns.append(batch.column(stored.index(f.name)).cast(kind))
                    else:
                        value = partition.values.get(f.name)
                        columns.append(pa.nulls(n, kind) if value is None else pa.array([value] * n).cast(kind))
                stamp = pa.array([partition.ts_ms] * n, pa.timestamp("ms", "UTC")).cast(pa.timestamp("us", "UTC"))
                columns += [pa.array([partition.change_type] * n), pa.array([partition.version] * n, pa.int64()), stamp]
                yield pa.RecordBatch.from_arrays(columns, names=self.out.fieldNames())

    def commit(self, end: dict) -> None:
        pass


class ChangeFeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        log = Log(_plain(self.options["root"]).rstrip("/"))
        first = int(self.options.get("startingversion", self.options.get("startingVersion", 0)))
        versions = log.versions()
        if not versions:
            raise ValueError(f"no versioned dataset at {log.root}")
        data = StructType.fromJson(json.loads(log.commit(min(first, versions[-1]))["schema_json"]))
        return StructType([
            *data.fields, StructField("_change_type", StringType()), StructField("_commit_version", LongType()),
            StructField("_commit_timestamp", TimestampType()),
        ])

    def streamReader(self, schema: StructType) -> ChangeFeedReader:  # noqa: N802
        return ChangeFeedReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make ``format("lakeops_changes")`` known to the session."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangeFeedSource)


def change_stream(spark: SparkSession, root: str, starting_version: int = 0) -> DataFrame:
    """Streaming DataFrame of the change rows of all commits from ``starting_version`` on."""
    register(spark)
    return spark.readStream.format(FORMAT).option("root", root).option("startingVersion", starting_version).load()
