"""Streaming change feed of a versioned dataset (A9, L4, L5, M6).

The stream is driven by the dataset's *log*: the log row of a version is
written last, so a version becomes visible to the stream only once committed
(an orphan folder of a failed commit never shows up). Each micro-batch holds
the new log rows; ``foreachBatch`` reads the change rows of just those
versions (metadata from the driver, rows on the executors) and hands them to a
writer. Offsets live in the checkpoint: a restart delivers only new commits.

``foreachBatch`` is at-least-once; the writers here are idempotent because they
key their output on the commit version (dynamic partition overwrite), so a
replayed batch rewrites the same partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops.plans.versioned import LOG_SCHEMA, VersionedDataset
from lakeops.streaming import source
from lakeops.streaming.lines import foreach_batch

ChangeWriter = Callable[[DataFrame, list[int]], None]


def commit_stream(ds: VersionedDataset) -> DataFrame:
    """Streaming DataFrame of log rows (one per commit)."""
    return ds.spark.readStream.schema(LOG_SCHEMA).json(ds.log_dir)


def parquet_change_writer(sink: str) -> ChangeWriter:
    """Write change rows under ``sink/_commit_version=<v>`` (replay-safe)."""

    def write(changes: DataFrame, versions: list[int]) -> None:
        (changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_commit_version").parquet(sink))

    return write


def deliver_changes(ds: VersionedDataset, writer: ChangeWriter, checkpoint: str, starting_version: int = 0,
                    interval: str | None = None) -> StreamingQuery:
    """Stream the change rows of every commit >= ``starting_version`` into ``writer``."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        versions = sorted(r.version for r in batch.select("version").collect() if r.version >= starting_version)
        if not versions:
            return
        wanted = set(versions)
        commits = [c for c in ds._commits() if c.version in wanted]
        writer(ds._changes_of(commits), versions)

    return foreach_batch(commit_stream(ds), on_batch, checkpoint, interval)


def change_stream(ds: VersionedDataset, starting_version: int = 0) -> DataFrame:
    """The change feed as a streaming DataFrame, to filter, aggregate and write like any other: a data
    source with versions as offsets (``streaming.source``); no copy of the rows, no other query."""
    return source.change_stream(ds.spark, ds.root, starting_version)


def read_change_sink(spark, sink: str) -> DataFrame:
    """Rows written by ``parquet_change_writer``; the version folder name becomes BIGINT again."""
    return spark.read.parquet(sink).withColumn("_commit_version", F.col("_commit_version").cast("bigint"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("n"))
