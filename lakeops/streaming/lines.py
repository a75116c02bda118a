"""Line streams (A10, L1-L3): Structured Streaming over a folder of text files.

The reference's receiver-based DStream on a socket becomes a file-source stream:
new files dropped into a folder are read as lines (``value``), in micro-batches,
with offsets in a checkpoint so a restart resumes without loss or repeats.
``socket_lines`` exists for parity but is never exercised here (no ports).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PREVIEW_ROWS = 10  # records shown per batch, like a DStream's pprint()


def line_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    """Lines of the text files that arrive in ``folder`` (column ``value``).

    ``max_files_per_trigger`` bounds a micro-batch. Other file-source options pass
    through, e.g. ``cleanSource="archive", sourceArchiveDir=...`` to move processed
    files away so the folder listing stays short on a long-running stream.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(folder)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Socket source (test-only in Spark: no fault tolerance); kept for API parity."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def _trigger(w, interval: str | None):
    # interval=None: process what is there and stop (tests, batch-like runs);
    # otherwise fixed micro-batches, e.g. "1 second" as in the reference.
    return w.trigger(availableNow=True) if interval is None else w.trigger(processingTime=interval)


def to_parquet(sdf: DataFrame, sink: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append every micro-batch to a Parquet folder (exactly-once file sink)."""
    w = sdf.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    return _trigger(w, interval).outputMode("append").start()


def preview_batches(sdf: DataFrame, sink: str, checkpoint: str, n: int = PREVIEW_ROWS,
                    interval: str | None = None) -> StreamingQuery:
    """First ``n`` records of each micro-batch, kept per batch id (idempotent on replay)."""

    def write_preview(batch: DataFrame, batch_id: int) -> None:
        (batch.limit(n).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    w = sdf.writeStream.foreachBatch(write_preview).option("checkpointLocation", checkpoint)
    return _trigger(w, interval).start()


def run(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Block until an availableNow query finished; re-raise its failure. If it is still
    running after ``timeout_s`` it is stopped and ``TimeoutError`` raised (a caller must
    never read a half-written sink as if it were complete)."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} still running after {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()
    return query


def foreach_batch(sdf: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                  interval: str | None = None) -> StreamingQuery:
    w = sdf.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return _trigger(w, interval).start()
