"""Rows per commit in the history, merges that only insert, diffs across schemas, SET names."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import clustering, layout, rowops
from lakeops.plans.versioned import VersionedDataset

FEED = {"enableChangeDataFeed": "true"}


def _metrics(ds):
    return {r.version: (r.operation, r.metrics or {}, r.num_rows) for r in ds.history().collect()}


@pytest.mark.parametrize("props", [{}, FEED])
def test_history_says_what_each_commit_did_in_rows(spark, tmp_root, props):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, spark.range(100).withColumn("v", F.col("id") % 10).repartition(4), properties=props)
    ds.append(spark.range(100, 130).withColumn("v", F.lit(0).cast("long")))
    ds.update({"v": "-1"}, "v = 3")
    ds.delete("id < 5")
    src = spark.range(125, 140).withColumn("v", F.lit(7).cast("long"))
    ds.merge(src, ["id"]).when_matched_update({"v": "s.v"}).when_not_matched_insert_all().execute()
    ds.delete("id = 1000")
    layout.compact(ds)
    clustering.cluster(ds, ["v"])
    ds.restore(1)
    ds.overwrite(ds.to_df().where("v = 0"))
    ds.merge(spark.range(50, 150).withColumn("v", F.lit(1).cast("long")), ["id"]).when_not_matched_insert_all().execute()
    ds.delete()
    m = _metrics(ds)
    assert [m[v][2] for v in sorted(m)] == [ds.to_df(v).count() for v in sorted(m)]  # rows of the version, none of them scanned for it
    assert m[0][1] == {"rows_inserted": 100} and m[1][1] == {"rows_inserted": 30}
    assert m[2][1]["rows_updated"] == 10 and m[3][1]["rows_deleted"] == 5
    assert m[4][1]["rows_updated"] == 5 and m[4][1]["rows_inserted"] == 10
    assert m[5][1] == {} and m[6][1] == {} and m[9][1] == {"rows_inserted": 40, "rows_deleted": 130}
    assert m[10][1] == {"rows_inserted": 65} and m[11] == ("DELETE", {"rows_deleted": 105}, 0)
    for v in (2, 3, 4):  # what was not touched in the rewritten files was carried over
        assert m[v][1].get("rows_kept", 0) <= m[v - 1][2]
    clone = ds.clone(f"{tmp_root}-clone", version=2)
    assert _metrics(clone)[0][2] == 130


def test_merge_that_only_inserts_appends(spark, tmp_root):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n")], "k INT, v STRING").coalesce(1)
    ds = VersionedDataset.from_dataframe(spark, tmp_root, base, properties=FEED)
    src = spark.createDataFrame([(1, "x"), (1, "y"), (9, "z"), (9, "z"), (None, "m")], "k INT, v STRING")
    ds.merge(src, ["k"]).when_not_matched_insert_all().execute()  # two source rows for key 1: no row of the target changes
    assert rows(ds.to_df()) == rows(base.union(spark.createDataFrame([(9, "z"), (9, "z"), (None, "m")], "k INT, v STRING")))
    last = ds.latest()
    assert last.removed == [] and last.base == 0 and last.metrics == {"rows_inserted": 3}
    assert rows(ds.changes(1).select("k", "v", "_change_type")) == rows(spark.createDataFrame(
        [(9, "z", "insert"), (9, "z", "insert"), (None, "m", "insert")], "k INT, v STRING, c STRING"))
    ds.merge(src.where("k = 1"), "t.k = s.k").when_not_matched_insert({"k": "s.k", "v": "'new'"}).execute()
    assert ds.latest().added == [] and ds.latest_version() == 2
    with pytest.raises(ValueError):
        ds.merge(src, "t.k < s.k").when_not_matched_insert_all().execute()


def test_diff_aligns_versions_of_different_schemas(spark, tmp_root):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, "c", 7)], "k INT, v STRING, gone INT")
    ds = VersionedDataset.from_dataframe(spark, tmp_root, old)
    new = spark.createDataFrame([(1, "a", 1.5), (2, "x", None), (4, "d", 2.0)], "k BIGINT, v STRING, w DOUBLE")
    VersionedDataset.from_dataframe(spark, tmp_root, new, replace_existing=True)
    got = rows(ds.diff(0, 1, ["k"], columns=True))
    assert got == [(1, "changed", ["w", "gone"]), (2, "changed", ["v", "gone"]), (3, "removed", None), (4, "added", None)]
    assert rows(ds.diff(0, 1, ["k"])) == [(1, "changed"), (2, "changed"), (3, "removed"), (4, "added")]
    assert ds.diff(0, 1).columns == ["k", "v", "w", "gone", "change", "copies"] and ds.diff(0, 1).count() == 6
    assert ds.diff(1, 1, ["k"]).count() == 0


def test_diff_of_one_schema_names_columns(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (2, "b", 1), (None, "n", 3)], "k INT, `a.b` STRING, c INT")
    new = spark.createDataFrame([(1, "a", 4), (2, "b", 1), (None, "m", 3)], "k INT, `a.b` STRING, c INT")
    assert rows(rowops.diff_by_key(old, new, ["k"], columns=True)) == sorted(
        [(1, "changed", ["c"]), (2, "changed", None), (None, "changed", ["a.b"])], key=repr)
    text = new.withColumn("c", F.col("c").cast("string"))
    assert rows(rowops.diff_by_key(new, text, ["k"])) == []
    dates = new.withColumn("c", F.lit("x"))
    assert rowops.diff_by_key(new, dates, ["k"]).count() == 3


def test_set_names_and_reserved_names(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, spark.createDataFrame([(1, "a", 2)], "k INT, `C d` STRING, v INT"))
    ds.update({"`C d`": "'b'", "V": "v + 1"}, "k = 1")
    ds.merge(spark.createDataFrame([(1, 9)], "k INT, n INT"), ["k"]).when_matched_update({"t.`C d`": "'c'", "t.V": "s.n"}).execute()
    assert rows(ds.to_df()) == [(1, "c", 9)]
    with pytest.raises(ValueError):
        ds.update({"nothing": "1"})
    with pytest.raises(ValueError):
        VersionedDataset.create(spark, f"{tmp_root}-k", "__kind STRING, a INT")


def test_empty_writes_are_counted_as_none(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, spark.range(0))
    ds.append(spark.createDataFrame([], "id LONG"))
    ds.overwrite(spark.range(5).where("id > 10"))
    ds.append(spark.range(3).join(spark.range(10, 12), "id"))
    assert [m[2] for m in _metrics(ds).values()] == [0, 0, 0, 0]
