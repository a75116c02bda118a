"""Names for versioned datasets (A5, B19): ``name -> root`` under a base folder.

Append-only: every create or drop writes one small JSON row under
``<base>/_names/name=<name>/``; the newest row wins. Dropping forgets the name
and never deletes data, so a dropped dataset stays readable by path.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from lakeops.functions import fs
from lakeops.plans.versioned import VersionedDataset, VersionError


class Catalog:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    @classmethod
    def default(cls, spark: SparkSession) -> "Catalog":
        """The catalog under the session's ``spark.sql.warehouse.dir`` (shared on a cluster)."""
        return cls(spark, f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/lakeops")

    def _names_dir(self) -> str:
        return f"{self.base}/_names"

    def _record(self, name: str, root: str | None) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        seq = f"{now:%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        row = {"ts": now.strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z", "seq": seq, "root": root}
        fs.create_new(self.spark, f"{self._names_dir()}/name={name}/{seq}.json", json.dumps(row) + "\n")

    def root_of(self, name: str) -> str | None:
        """Root of the newest record for ``name`` (records are named by time, so the
        newest is the largest file name); None when unknown or dropped."""
        folder = f"{self._names_dir()}/name={name}"
        records = [n for n in fs.list_names(self.spark, folder) if n.endswith(".json")]
        if not records:
            return None
        return json.loads(fs.read_text(self.spark, f"{folder}/{max(records)}")).get("root")

    def create(self, name: str, schema, **kw) -> VersionedDataset:
        """CREATE TABLE name (...): a new root for a new name; ``mode`` as in VersionedDataset.create."""
        mode = kw.pop("mode", "create")
        root = self.root_of(name)
        if root is None:
            if mode == "replace":
                raise VersionError(f"no dataset named {name}")
            root = f"{self.base}/{name}-{uuid.uuid4().hex[:8]}"
            ds = VersionedDataset.create(self.spark, root, schema, mode="create", **kw)
            self._record(name, ds.root)
            return ds
        return VersionedDataset.create(self.spark, root, schema, mode=mode, **kw)

    def register(self, name: str, ds: VersionedDataset) -> VersionedDataset:
        if self.root_of(name) is not None:
            raise VersionError(f"name {name} already in use")
        self._record(name, ds.root)
        return ds

    def for_name(self, name: str) -> VersionedDataset:
        root = self.root_of(name)
        if root is None:
            raise VersionError(f"no dataset named {name}")
        return VersionedDataset.for_path(self.spark, root)

    forName = for_name  # noqa: N815  (reference spelling)

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self.for_name(name).to_df(version)

    def table_changes(self, name: str, start, end=None) -> DataFrame:
        """``table_changes('name', start[, end])``: versions (int) or timestamps (str / datetime)."""
        ds = self.for_name(name)
        if isinstance(start, int) and (end is None or isinstance(end, int)):
            return ds.changes(start, end)
        return ds.changes_between_timestamps(start, end)

    def create_view(self, name: str) -> None:
        """Temp view of the latest version, for ``SELECT * FROM name``."""
        self.table(name).createOrReplaceTempView(name)

    def save_as(self, name: str, df: DataFrame, mode: str = "errorifexists", partition_by=()) -> VersionedDataset:
        """``df.write.mode(m).saveAsTable(name)``: create on first use, else append or
        overwrite (a new version; old versions stay readable)."""
        root = self.root_of(name)
        if root is None:
            ds = VersionedDataset.from_dataframe(
                self.spark, f"{self.base}/{name}-{uuid.uuid4().hex[:8]}", df, partition_by=partition_by
            )
            self._record(name, ds.root)
            return ds
        ds = VersionedDataset.for_path(self.spark, root)
        if mode in ("error", "errorifexists"):
            raise VersionError(f"dataset {name} already exists")
        if mode == "overwrite":
            ds.overwrite(df)
        elif mode == "append":
            ds.append(df)
        elif mode != "ignore":
            raise ValueError(f"unknown mode {mode!r}")
        return ds

    def clone(self, name: str, new_name: str, shallow: bool = True, version: int | None = None) -> VersionedDataset:
        """CREATE TABLE new_name [SHALLOW | DEEP] CLONE name [VERSION AS OF version]."""
        if self.root_of(new_name) is not None:
            raise VersionError(f"name {new_name} already in use")
        ds = self.for_name(name).clone(f"{self.base}/{new_name}-{uuid.uuid4().hex[:8]}", shallow, version)
        self._record(new_name, ds.root)
        return ds

    def drop(self, name: str, if_exists: bool = True) -> None:
        """DROP TABLE [IF EXISTS]: forget the name; files stay."""
        if self.root_of(name) is None:
            if if_exists:
                return
            raise VersionError(f"no dataset named {name}")
        self._record(name, None)
