"""Statistics kept from changes equal a full computation after inserts, updates and deletes."""

import random

from pyspark.sql import functions as F

from conftest import rows
from lakeops.plans.incremental import KeyStats, covered_version
from lakeops.plans.versioned import VersionedDataset

FEED = {"enableChangeDataFeed": "true"}


def _full(df, key="k"):
    exact = F.col("x").cast("decimal(38,6)")
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("x").alias("n_values"), F.sum(exact).cast("decimal(38,6)").alias("total"),
        (F.sum(exact).cast("decimal(38,6)").cast("double") / F.count("x")).alias("mean"), F.min(exact).alias("least"), F.max(exact).alias("most"),
    )


def _same(stats, ds):
    assert rows(stats.current()) == rows(_full(ds.to_df()).withColumn("mean", F.when(F.col("n_values") > 0, F.col("mean"))))


def test_equal_to_a_full_computation_after_any_changes(spark, tmp_root):
    rng = random.Random(11)
    row = lambda i: (i, rng.choice([None, "a", "b", "c", "hot", "hot", "hot"]), rng.choice([None, 1.5, -2.25, rng.random() * 100]))
    make = lambda n, at: spark.createDataFrame([row(at + i) for i in range(n)], "id INT, k STRING, x DOUBLE")
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/base", make(60, 0), properties=FEED)
    stats = KeyStats.create(spark, f"{tmp_root}/agg", ds.to_df(), ["k"], "x", 0)
    _same(stats, ds)
    steps = [
        lambda: ds.append(make(20, 100)),
        lambda: ds.delete("x = (select max(x) from range(1)) or x > 60"),
        lambda: ds.delete("x > 50"),
        lambda: ds.update({"x": "-x", "k": "case when k = 'a' then 'new' else k end"}, "id % 3 = 0"),
        lambda: ds.delete("k = 'b'"),
        lambda: ds.append(make(5, 200).withColumn("k", F.lit("b"))),
        lambda: ds.update({"x": "null"}, "k = 'c'"),
    ]
    del steps[1]
    for step in steps:
        step()
        v = ds.latest_version()
        assert stats.apply(ds.changes(1), v)  # all changes again: those applied are left out
        _same(stats, ds)
        assert not stats.apply(ds.changes(1), v)


def test_a_batch_of_many_commits_and_a_crash_between_the_two_datasets(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/base", spark.range(200).select(
        F.concat(F.lit("k"), F.col("id") % 7).alias("k"), (F.col("id") / 2).alias("x")), properties=FEED)
    stats = KeyStats.create(spark, f"{tmp_root}/agg", ds.to_df(), ["k"], "x", 0)
    ds.delete("x > 90")
    ds.append(spark.range(3).select(F.lit("k1").alias("k"), F.lit(-5.0).alias("x")))
    values, old = stats.values, stats.stats.latest_version()
    stats.apply(ds.changes(1), 2)
    _same(stats, ds)
    # as if the commit of the statistics had been lost
    stats.stats.restore(old)
    stats.stats.set_properties(sourceVersion="0")
    assert covered_version(values) == 2 and stats.covered() == 0
    ds.update({"x": "1000.0"}, "k = 'k3' and x < 5")
    assert stats.apply(ds.changes(1), 3)
    _same(stats, ds)


def test_integer_values_and_several_keys(spark, tmp_root):
    df = spark.range(50).select((F.col("id") % 2).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("b"), F.col("id").alias("x"))
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/base", df, properties=FEED)
    stats = KeyStats.create(spark, f"{tmp_root}/agg", ds.to_df(), ["a", "b"], "x", 0)
    ds.delete("x > 40 or b is null")
    stats.apply(ds.changes(1), 1)
    got = rows(stats.current().select("a", "b", "n_rows", "total", "least", "most"))
    assert [(a, b, n, int(t), int(lo), int(hi)) for a, b, n, t, lo, hi in got] == rows(
        ds.to_df().groupBy("a", "b").agg(F.count("x"), F.sum("x"), F.min("x"), F.max("x")))
