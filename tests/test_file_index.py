"""Lookups on several columns through per-file value filters."""

import datetime

import pytest
from pyspark.sql import functions as F

from lakeops.operators import file_index as fi
from lakeops.plans.versioned import VersionedDataset


def _dataset(spark, root, files=16, rows=4000):
    """Unclustered texts, numbers, days, nulls and a column with a dot in its name."""
    k = spark.range(rows).select(F.col("id").alias("k"), (F.xxhash64("id") % 400).alias("h"))
    df = k.select(
        "k", F.concat(F.lit("name-"), F.when(F.col("h") % 7 != 0, F.col("h"))).alias("name"), (F.xxhash64("k", F.lit(3)) % 300).alias("a.b"),
        F.date_add(F.lit(datetime.date(2020, 1, 1)), F.pmod("h", F.lit(90)).cast("int")).alias("day"),
        F.when(F.col("k") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("k") / 4).alias("x"),
    )
    return VersionedDataset.from_dataframe(spark, root, df.repartition(files, "k"))


def _hits(ds, cond):
    return {r.file_path for r in fi.files_to_read(ds, cond).where("hit").collect()}


def _holding(ds, pred):
    return {r[0] for r in ds._read_commit(ds.latest(), ("__file",)).where(pred).select("__file").distinct().collect()}


def test_two_columns_open_fewer_files_than_either(spark, tmp_root):
    ds = _dataset(spark, tmp_root)
    assert fi.build_index(ds, ["name", "a.b"]) == 1 and fi.build_index(ds, ["name", "a.b"]) == 0
    row = ds.to_df().where("name is not null").orderBy("k").first()
    one, two = _hits(ds, {"name": row.name}), _hits(ds, {"a.b": row["a.b"]})
    both = _hits(ds, {"name": row.name, "a.b": row["a.b"]})
    assert both == one & two and len(both) < min(len(one), len(two)) and len(one) < 16
    got = fi.lookup(ds, {"name": row.name, "a.b": row["a.b"]})
    whole = ds.to_df().where((F.col("name") == row.name) & (F.col("`a.b`") == row["a.b"]))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, whole.collect())) and whole.count() > 0
    assert {p.rsplit("/", 1)[1] for p in got.inputFiles()} == {p.rsplit("/", 1)[1] for p in both}  # only these are read


@pytest.mark.parametrize("cond, pred", [
    ({"name": "name-3"}, "name = 'name-3'"),
    ({"name": ["name-3", "name-11", None]}, "name in ('name-3', 'name-11')"),
    ({"name": None}, "false"),
    ({"name": []}, "false"),
    ({"name": "missing"}, "false"),
    ({"day": datetime.date(2020, 1, 9), "name": "name-8"}, "day = date'2020-01-09' and name = 'name-8'"),
    ({"day": fi.Between(datetime.date(2020, 3, 1), None, include_lo=False), "k": fi.Between(10, 900)}, "day > date'2020-03-01' and k between 10 and 900"),
    ({"x": float("nan"), "k": [5, 6, 10]}, "x = double('nan') and k in (5, 6, 10)"),
    ({"k": 17, "unindexed": 1}, "k = 17 and unindexed = 1"),
])
def test_rows_equal_a_full_scan_and_no_file_is_missed(spark, tmp_root, cond, pred):
    df = _dataset(spark, f"{tmp_root}/src").to_df().withColumn("unindexed", F.lit(1))
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/ds", df.repartition(8, "k"))
    fi.build_index(ds, ["name", "a.b", "day", "x", "k"])
    assert sorted(map(repr, fi.lookup(ds, cond).collect())) == sorted(map(repr, ds.to_df().where(pred).collect()))
    assert _holding(ds, pred) <= _hits(ds, cond)


def test_index_grows_with_appends_and_follows_rewrites(spark, tmp_root):
    ds = _dataset(spark, tmp_root)
    fi.build_index(ds, ["name"])
    new = ds.to_df().where("name = 'name-3'").withColumn("k", F.col("k") + 100_000).coalesce(1)
    ds.append(new)
    n = ds.to_df().where("name = 'name-3'").count()
    appended = _holding(ds, "k >= 100000")
    assert appended <= _hits(ds, {"name": "name-5"})  # not indexed yet: always read
    assert fi.lookup(ds, {"name": "name-3"}).count() == n
    assert fi.build_index(ds, ["name"]) == 1 and not appended & _hits(ds, {"name": "name-5"})
    assert fi.lookup(ds, {"name": "name-3"}).count() == n
    ds.update({"name": "'name-5'"}, "name = 'name-3' and k < 100000")
    assert fi.lookup(ds, {"name": "name-3"}).count() == ds.to_df().where("name = 'name-3'").count() > 0
    assert fi.lookup(ds, {"name": "name-5"}).count() == ds.to_df().where("name = 'name-5'").count()
    assert fi.lookup(ds, {"name": "name-3"}, version=0).count() == ds.to_df(0).where("name = 'name-3'").count()
    assert fi.build_index(ds, ["name", "day"]) > 1  # a column more: its folders are indexed again
    assert fi.lookup(ds, {"name": "name-5", "day": datetime.date(2020, 1, 6)}).count() == ds.to_df().where(
        "name = 'name-5' and day = date'2020-01-06'").count()
    ds.overwrite(ds.to_df().where("k % 2 = 0"))
    assert fi.lookup(ds, {"name": "name-5"}).count() == ds.to_df().where("name = 'name-5'").count()


def test_few_files_are_named_in_vain(spark, tmp_root):
    """One value a file; a thousand values that are in none of them."""
    ds = VersionedDataset.from_dataframe(spark, tmp_root, spark.range(20_000).repartition(4, "id").select(F.col("id").cast("string").alias("v")))
    fi.build_index(ds, ["v"])
    (b,) = fi.builds_of(ds)
    bits = spark.read.parquet(f"{b.path}/bits")
    absent = spark.range(20_000, 24_000).select(F.col("id").cast("string").alias("v"))
    asked = absent.select(fi._word(F.col("v"), b.n_words).alias("word"), fi._mask(F.col("v")).alias("mask"))
    vain = bits.join(asked, "word").where("(bits & mask) = mask").count()
    assert vain / (4000 * 4) < 0.01


def test_partitioned_empty_and_refused(spark, tmp_root):
    df = spark.range(600).select("id", (F.col("id") % 3).alias("p"), F.concat(F.lit("t"), F.col("id") % 50).alias("t"))
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/p", df, partition_by=["p"])
    fi.build_index(ds, ["t", "p"])
    assert fi.lookup(ds, {"t": "t7", "p": 1}).count() == df.where("t = 't7' and p = 1").count()
    empty = VersionedDataset.create(spark, f"{tmp_root}/e", "a STRING, m MAP<STRING, INT>")
    assert fi.build_index(empty, ["a"]) == 0 and fi.lookup(empty, {"a": "x"}).count() == 0
    with pytest.raises(ValueError):
        fi.build_index(empty, ["m"])
