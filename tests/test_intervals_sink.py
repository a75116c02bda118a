"""Validity intervals, and the replica kept by key."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.plans.intervals import state_at, validity_intervals
from lakeops.plans.versioned import VersionedDataset, VersionError
from lakeops.streaming import changes, lines
from lakeops.streaming.keyed_sink import KeyedSink

FEED = {"enableChangeDataFeed": "true"}


def _busy(spark, root):
    """Several copies of rows, a hot row, null keys, updates back and forth, deletes, an overwrite, a restore."""
    rng = random.Random(8)
    some = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b"])) for _ in range(60)] + [(7, "hot")] * 200
    ds = VersionedDataset.from_dataframe(spark, root, spark.createDataFrame(some, "k INT, v STRING").repartition(3), properties=FEED)
    ds.update({"v": "'c'"}, "k = 1 and v = 'a'")
    ds.append(spark.createDataFrame([(7, "hot")] * 50 + [(1, "a")], "k INT, v STRING"))
    ds.delete("k = 2")
    ds.update({"v": "'a'"}, "v = 'c'")
    ds.delete("v = 'hot'")
    ds.overwrite(ds.to_df().where("k is not null"))
    ds.restore(1)
    return ds


def test_the_state_at_every_version_falls_out_of_the_intervals(spark, tmp_root):
    ds = _busy(spark, tmp_root)
    found = validity_intervals(ds).cache()
    for v in range(ds.latest_version() + 1):
        assert rows(state_at(found, v)) == rows(ds.to_df(v))
    hot = found.where("v = 'hot'").orderBy("valid_from").collect()
    assert [(r.copies, r.valid_from, r.valid_to) for r in hot] == [(200, 0, 2), (250, 2, 5), (200, 7, None)]
    for a, b in itertools.pairwise(found.where("k = 1 and v = 'a'").orderBy("valid_from").collect()):
        assert a.valid_to is not None and a.valid_to <= b.valid_from
    part = validity_intervals(ds, 2, 4)
    assert rows(state_at(part, 3)) == rows(ds.to_df(3)) and part.where("valid_from < 2 or valid_to > 4").count() == 0


def test_intervals_need_the_feed_and_one_schema(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/a", spark.range(3))
    ds.append(spark.range(2))
    with pytest.raises(VersionError):
        validity_intervals(ds)
    assert validity_intervals(ds, 1).count() == 3
    VersionedDataset.from_dataframe(spark, ds.root, spark.range(3).withColumn("x", F.lit(1)), replace_existing=True)
    with pytest.raises(ValueError):
        validity_intervals(ds, 1)


def _keyed(spark, root):
    ds = VersionedDataset.from_dataframe(spark, root, spark.range(40).select(
        F.when(F.col("id") > 0, F.col("id")).alias("id"), (F.col("id") % 4).alias("a.b"), F.lit("x").alias("t")), properties=FEED)
    ds.update({"t": "concat(t, '1')"}, "`a.b` = 1")
    ds.delete("id % 5 = 0")
    ds.append(spark.createDataFrame([(5, 9, "back"), (100, 1, "new")], "id BIGINT, `a.b` BIGINT, t STRING"))
    ds.update({"t": "concat(t, '2')"}, "id is null or id = 5 or `a.b` = 1")
    ds.delete("id = 100")
    return ds


def test_batches_out_of_order_and_repeated_give_the_source(spark, tmp_root):
    ds = _keyed(spark, f"{tmp_root}/ds")
    for i, order in enumerate([[(0, 5)], [(4, 5), (0, 3), (1, 2)], [(3, 3), (5, 5), (1, 1), (0, 0), (4, 4), (2, 2), (0, 5)]]):
        sink = KeyedSink.create(spark, f"{tmp_root}/r{i}", ds.latest().schema, ["id"])
        for lo, hi in order:
            sink.apply(ds.changes(lo, hi).orderBy(F.rand(3)))
        assert rows(sink.rows()) == rows(ds.to_df())
        versions = sink.replica.latest_version()
        assert not sink.apply(ds.changes(0)) and not sink.apply(ds.changes(2, 2)) and sink.replica.latest_version() == versions


def test_as_a_stream_writer(spark, tmp_root):
    ds = _keyed(spark, f"{tmp_root}/ds")
    sink = KeyedSink.create(spark, f"{tmp_root}/r", ds.latest().schema, ["id"])
    lines.run(changes.deliver_changes(ds, sink.writer(), f"{tmp_root}/ck"))
    ds.update({"t": "'late'"}, "id = 7")
    lines.run(changes.deliver_changes(ds, sink.writer(), f"{tmp_root}/ck"))
    assert rows(sink.rows()) == rows(ds.to_df())
