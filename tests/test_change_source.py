"""The change feed as a streaming source: offsets are versions, files are read in place."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from lakeops.functions import fs
from lakeops.plans.versioned import VersionedDataset
from lakeops.streaming import changes, lines

FEED = {"enableChangeDataFeed": "true"}


def _table(spark, ids):
    return spark.range(*ids).select(
        "id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("näme "), F.col("id"))).alias("n/a=e"), (F.col("id") / 3).cast("decimal(12,4)").alias("d"),
        F.timestamp_seconds(F.col("id") * 86_399).alias("ts"), F.expr("cast(timestamp_seconds(id) as timestamp_ntz)").alias("local"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("day"), F.array(F.col("id"), F.lit(None)).alias("list"),
        F.struct(F.col("id").alias("x"), F.lit("y").alias("y")).alias("s"), F.create_map(F.lit("k"), F.col("id")).alias("m"),
        (F.col("id") % 2 == 0).alias("even"), F.encode(F.lit("b"), "UTF-8").alias("raw"), F.col("id").cast("float").alias("f"),
    )


def _files(spark, root):
    return sorted(r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path").collect())


def _read(spark, sink):
    return spark.read.parquet(sink)


def test_each_commit_is_delivered_once_across_restarts_and_nothing_is_copied(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/ds", _table(spark, (0, 40)).repartition(3), properties=FEED)
    sink, ck = f"{tmp_root}/sink", f"{tmp_root}/ck"
    run = lambda: lines.run(lines.to_parquet(changes.change_stream(ds), sink, ck))
    run()
    ds.append(_table(spark, (40, 45)))
    ds.update({"f": "f + 1"}, "id % 7 = 3")
    before = _files(spark, ds.root)
    run()
    run()  # nothing new
    ds.delete("id > 41")
    run()
    assert set(before) <= set(_files(spark, ds.root)) and sorted(fs.list_names(spark, tmp_root)) == ["ck", "ds", "sink"]
    assert not fs.exists(spark, f"{ds.root}/feed")
    got = _read(spark, sink)
    expected = ds.changes(0)
    assert got.schema.simpleString() == expected.schema.simpleString()
    assert rows(got) == rows(expected) and got.count() == 40 + 5 + 12 + 3


def test_starting_version_snapshots_and_partitions(spark, tmp_root):
    df = _table(spark, (0, 30)).withColumn("p", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b/"), F.col("id") % 3))).drop("m")
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/ds", df, partition_by=["p", "day"], properties=FEED)
    ds.delete("id = 4")
    ds.update({"f": "-1"}, "id = 5")
    ds.overwrite(df.where("id < 2"))  # every row of version 2 goes: read from its files, without those taken out
    lines.run(lines.to_parquet(changes.change_stream(ds, 1), f"{tmp_root}/sink", f"{tmp_root}/ck"))
    assert rows(_read(spark, f"{tmp_root}/sink").select(ds.changes(1).columns)) == rows(ds.changes(1))


def test_a_running_stream_sees_commits_and_stops(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/ds", spark.range(3), properties=FEED)
    seen = f"{tmp_root}/sink"
    query = lines.to_parquet(changes.change_stream(ds), seen, f"{tmp_root}/ck", interval="200 milliseconds")
    active = [q.id for q in spark.streams.active]
    query.processAllAvailable()
    ds.append(spark.range(3, 8))
    query.processAllAvailable()
    assert _read(spark, seen).count() == 8
    query.stop()
    assert active == [query.id] and spark.streams.active == []  # no other query was started


def test_gaps_and_other_schemas_end_the_stream(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/a", spark.range(3), properties=FEED)
    ds.set_properties(enableChangeDataFeed="false")
    ds.append(spark.range(3, 5))
    with pytest.raises(StreamingQueryException, match="feed was off"):
        lines.run(lines.to_parquet(changes.change_stream(ds), f"{tmp_root}/s1", f"{tmp_root}/c1"))
    other = VersionedDataset.from_dataframe(spark, f"{tmp_root}/b", spark.range(3), properties=FEED)
    VersionedDataset.from_dataframe(spark, f"{tmp_root}/b", spark.range(3).withColumn("x", F.lit(1)), replace_existing=True, properties=FEED)
    with pytest.raises(StreamingQueryException, match="another schema"):
        lines.run(lines.to_parquet(changes.change_stream(other), f"{tmp_root}/s2", f"{tmp_root}/c2"))
