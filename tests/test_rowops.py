"""Pure row-level transforms: SET sees the old row, NULL predicates, merge plan shape, diff."""

from pyspark.sql import functions as F

from conftest import rows
from lakeops.operators import rowops


def test_update_sees_old_row(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k INT, x STRING, y STRING")
    out = rowops.update_rows(df, {"x": F.col("y"), "y": "x"})
    assert rows(out) == [(1, "b", "a")]


def test_update_and_delete_null_predicate(spark):
    df = spark.createDataFrame([(1, "TPA"), (2, "JFK"), (3, None)], "k INT, dest STRING")
    upd = rowops.update_rows(df, {"dest": "'TPA'"}, "dest != 'TPA'")
    assert rows(upd) == [(1, "TPA"), (2, "TPA"), (3, None)]  # NULL Dest untouched
    dele = rowops.delete_rows(df, "dest = 'JFK'")
    assert rows(dele) == sorted([(1, "TPA"), (3, None)], key=repr)  # NULL predicate kept
    assert df.where(F.col("dest") != "JFK").count() == 1  # the filter drops NULL too


def test_update_kinds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    out = rowops.update_kinds(df, {"v": "'z'"}, "k = 1")
    assert rows(out) == [(1, "a", "pre"), (1, "z", "post"), (2, "b", "keep")]


def test_merge_rows_without_full_outer_join(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k INT, v STRING")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k INT, v STRING")
    out = rowops.merge_rows(t, s, ["k"], update_set={"v": "s.v"}, insert_all=True)
    assert rows(out) == sorted([(1, "a"), (2, "B"), (None, "n"), (3, "C"), (None, "N")], key=repr)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "NestedLoop" not in plan


def test_diff_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k INT, v STRING")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k INT, v STRING")
    assert rows(rowops.diff_by_key(old, new, ["k"])) == [(1, "removed"), (2, "changed"), (4, "added")]
    assert rows(rowops.diff_rows(old, new)) == [(1, "a", "removed", 1), (2, "B", "added", 1), (2, "b", "removed", 1), (4, "d", "added", 1)]


def test_diff_non_unique_and_null_keys_without_pairs(spark):
    # A key with many rows on both sides: a pairwise join would emit 300 x 300 rows.
    old = spark.range(300).selectExpr("7 as k", "id as v").union(spark.createDataFrame([(None, 1)], "k INT, v BIGINT"))
    new = spark.range(301).selectExpr("7 as k", "id as v").union(spark.createDataFrame([(None, 1)], "k INT, v BIGINT"))
    assert rows(rowops.diff_by_key(old, new, ["k"])) == [(7, "changed")]  # NULL key unchanged: not reported
    assert rows(rowops.diff_rows(old, new)) == [(7, 300, "added", 1)]
    dup = rowops.diff_rows(spark.createDataFrame([(1,), (1,), (1,)], "x INT"), spark.createDataFrame([(1,)], "x INT"))
    assert rows(dup) == [(1, "removed", 2)]
    plan = rowops.diff_by_key(old, new, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
