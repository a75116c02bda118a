"""A replica of a dataset kept by key from its change feed (M6).

A batch of change rows, whole or in part, in any order and any number of times, is reduced to the last change of each key
(one ``max_by`` per key, combined before the shuffle) and merged into another versioned dataset. The replica keeps, per key, the source
version it is at, deleted keys included; only a change of a later version is let through. So a repeated batch makes
no commit, and an old batch that arrives late cannot undo a newer one.

The keys name at most one row per version of the source. Within a version the row written last counts (an insert or post-image
before a delete or pre-image). NULL keys are keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from lakeops.plans.versioned import VersionedDataset
from lakeops.session import scratch_dir

AT, DELETED = "_source_version", "_deleted"


class KeyedSink:
    def __init__(self, replica: VersionedDataset, keys: Sequence[str]):
        self.replica, self.keys = replica, list(keys)

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str]) -> "KeyedSink":
        """An empty replica for rows of ``schema``."""
        fields = [*schema.fields, StructField(AT, LongType()), StructField(DELETED, BooleanType())]
        return cls(VersionedDataset.create(spark, root, StructType(fields)), keys)

    def _same(self, a: str, b: str):
        out = F.lit(True)
        for k in self.keys:
            out = out & F.col(f"{a}.`{k}`").eqNullSafe(F.col(f"{b}.`{k}`"))
        return out

    def apply(self, changes: DataFrame) -> bool:
        """Merge change rows in. False if none of them is newer than the replica."""
        data = [n for n in self.replica.latest().schema.fieldNames() if n not in (AT, DELETED)]
        there = F.col("_change_type").isin("insert", "update_postimage")
        row = F.struct(*[F.col(f"`{n}`") for n in data])
        rank = F.struct(F.col("_commit_version"), there, F.xxhash64(row))  # the hash settles ties between equal ranks
        last = changes.groupBy(*[F.col(f"`{k}`") for k in self.keys]).agg(
            F.max_by(row, rank).alias("row"), F.max(F.struct(F.col("_commit_version").alias("v"), there.alias("there"))).alias("at")
        )
        last = last.select(
            *[F.col(f"`{k}`") for k in self.keys], *[F.col(f"row.`{n}`").alias(n) for n in data if n not in self.keys],
            F.col("at.v").alias(AT), (~F.col("at.there")).alias(DELETED),
        ).select(*[F.col(f"`{n}`") for n in data], AT, DELETED)
        held = self.replica.to_df().select(*[F.col(f"`{k}`") for k in self.keys], AT)
        newer = last.alias("s").join(held.alias("t"), self._same("s", "t") & (F.col(f"t.{AT}") >= F.col(f"s.{AT}")), "left_anti")
        spark = self.replica.spark
        path = scratch_dir(spark, "keyed-batch")
        newer.write.parquet(path)  # the same rows for the check and for the merge
        newer = spark.read.schema(self.replica.latest().schema).parquet(path)
        if newer.isEmpty():
            return False
        self.replica.merge(newer, self.keys, null_safe=True).when_matched_update_all().when_not_matched_insert_all().execute()
        return True

    def writer(self):
        """For ``changes.deliver_changes``."""
        return lambda changes, versions: self.apply(changes)

    def rows(self) -> DataFrame:
        """The source's rows, as far as changes have arrived."""
        return self.replica.to_df().where(~F.col(DELETED)).drop(AT, DELETED)
