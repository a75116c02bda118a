"""Compaction, clustering, skipping, hot values, unreferenced files."""

import re

import pytest
from pyspark.sql import functions as F

from lakeops.functions import fs
from lakeops.operators import layout
from lakeops.plans.versioned import VersionedDataset


def small_appends(spark, root, n=4):
    ds = VersionedDataset.create(spark, root, "k BIGINT, g BIGINT, s STRING")
    for i in range(n):
        ds.append(spark.range(i * 1000, (i + 1) * 1000).select("id", (F.col("id") % 7).alias("g"), F.col("id").cast("string")).toDF("k", "g", "s"))
    return ds


def n_files(ds):
    return layout.version_files(ds).count()


def test_compact_rows_unchanged_fewer_files(spark, tmp_root):
    ds = small_appends(spark, tmp_root)
    before, files_before = sorted(ds.to_df().collect()), n_files(ds)
    layout.compact(ds)
    assert sorted(ds.to_df().collect()) == before
    assert n_files(ds) < files_before
    assert ds.latest().operation == "OPTIMIZE" and ds.latest().changes == []


def test_cluster_and_skip(spark, tmp_root):
    ds = small_appends(spark, tmp_root)
    assert layout.files_between(ds, "k", 1500, 1500) is None  # no stats yet
    layout.cluster_by(ds, ["k"], n_files=8)
    assert layout.version_files(ds).count() == 8 and len(layout.files_between(ds, "k", 1500, 1500)) == 1
    assert [r.k for r in layout.point_lookup(ds, "k", 1500).collect()] == [1500]


def test_zorder_two_columns(spark, tmp_root):
    ds = small_appends(spark, tmp_root)
    n = ds.to_df().count()
    layout.cluster_by(ds, ["k", "g"], n_files=8)
    assert ds.to_df().count() == n
    assert len(layout.files_between(ds, "k", 10, 10)) < layout.version_files(ds).count()


def test_hot_value_spreads_over_files(spark, tmp_root):
    # One value holds half of all rows: the hash tiebreak splits it over several files.
    ds = VersionedDataset.create(spark, tmp_root, "k BIGINT, v BIGINT")
    ds.append(spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")))
    layout.cluster_by(ds, ["k"], n_files=8)
    assert len(layout.files_between(ds, "k", 7, 7)) >= 3
    assert layout.point_lookup(ds, "k", 7).count() == 2001  # 2000 even ids + id 7 itself


def test_unreferenced_files(spark, tmp_root):
    ds = small_appends(spark, tmp_root, n=2)
    assert layout.unreferenced_files(ds).count() == 0
    # A write that never committed (crash before the log row) leaves an orphan folder.
    spark.range(5).toDF("k").write.parquet(f"{ds.root}/data/99-orphan")
    orphans = [r.path for r in layout.unreferenced_files(ds).collect()]
    assert orphans and all("99-orphan" in p for p in orphans)
    # Overwrite: old files are still referenced by old versions, so nothing to drop.
    ds.overwrite(ds.to_df().where("k < 10"))
    assert all("99-orphan" in r.path for r in layout.unreferenced_files(ds).collect())
    assert fs.exists(spark, f"{ds.root}/data/99-orphan")  # listing only, nothing deleted
    # Retaining only the latest version: the files only old versions used become droppable.
    old_only = {r.path for r in layout.unreferenced_files(ds, retain_from_version=ds.latest_version()).collect()}
    assert len(old_only) > 1 and all("/data/" in p for p in old_only)
    assert not any(p in old_only for p in ds.to_df().inputFiles())


def test_stats_carry_forward_after_append(spark, tmp_root):
    ds = small_appends(spark, tmp_root, n=2)
    layout.cluster_by(ds, ["k"], n_files=4)
    ds.append(spark.createDataFrame([(1500, 0, "new")], "k BIGINT, g BIGINT, s STRING"))
    new_files = layout.version_files(ds).count() - 4  # files the append wrote (not covered by the stats)
    # one clustered file by stats + every uncovered file
    assert new_files >= 1 and len(layout.files_between(ds, "k", 1500, 1500)) == 1 + new_files
    assert layout.point_lookup(ds, "k", 1500).count() == 2


def test_time_travel_by_timestamp(spark, tmp_root):
    import time

    ds = VersionedDataset.create(spark, tmp_root, "k INT")
    ds.insert_values([(1,)])
    ts = ds.history().where("version = 1").first().timestamp
    time.sleep(0.01)
    ds.insert_values([(2,)])
    assert ds.to_df(timestamp=ts).count() == 1 and ds.to_df().count() == 2


def test_merge_scans_only_files_overlapping_the_source_keys(spark, tmp_root):
    ds = small_appends(spark, tmp_root)  # k = 0..3999
    layout.cluster_by(ds, ["k"], n_files=8)
    src = spark.createDataFrame([(1500, 0, "x"), (1510, 0, "y"), (99999, 1, "new")], "k BIGINT, g BIGINT, s STRING")
    # a sampled range bound may fall inside [1500, 1510]
    assert 1 <= len(layout.files_between(ds, "k", 1500, 1510)) <= 2
    assert len(ds.merge(src, ["k"])._prune_by_stats(ds.latest(), src, ["k"])) < 8
    ds.merge(src, "t.k = s.k").when_matched_update({"s": "s.s"}).when_not_matched_insert_all().execute()
    out = {r.k: r.s for r in ds.to_df().where("k in (1500, 1510, 99999, 1501)").collect()}
    assert out == {1500: "x", 1510: "y", 99999: "new", 1501: "1501"}
    assert ds.to_df().count() == 4001


def test_zorder_keys_refine_each_other_and_order_text_and_nan(spark):
    df = spark.range(2000).select((F.col("id") * 7 % 1000).alias("a"), (F.col("id") % 13).alias("b"))
    assert layout.zorder_bits(8, 2) == 4 and layout.zorder_bits(800_000, 2) == 8
    small, big = layout.zorder_key(df, ["a", "b"], bits=4), layout.zorder_key(df, ["a", "b"], bits=7)
    j = small.withColumnRenamed("__zkey", "zs").join(big.withColumnRenamed("__zkey", "zb"), ["a", "b"])
    assert j.count() >= 2000 and small.select("__zkey").distinct().count() > 100
    # texts that agree in a long beginning, and NaN, still spread over the cells
    urls = spark.range(1000).select(
        F.format_string("https://www.example.com/%04d", "id").alias("u"),
        F.when(F.col("id") % 3 == 0, float("nan")).otherwise(F.col("id").cast("double")).alias("x"),
    )
    cells = layout.zorder_key(urls, ["u", "x"], bits=4)
    assert cells.select("__zkey").distinct().count() > 30


def test_skipping_compares_as_spark_does(spark, tmp_root):
    nan = float("nan")
    rows_ = [(5.0, "2024-01-02", "b"), (nan, "2024-01-03", "c"), (7.0, None, "d")]
    df = spark.createDataFrame(rows_, "x DOUBLE, d STRING, s STRING").select("x", F.col("d").cast("date"), "s").coalesce(1)
    ds = VersionedDataset.from_dataframe(spark, tmp_root, df)
    layout.write_file_stats(ds, ["x", "d", "s"], 0)
    assert [r.s for r in layout.point_lookup(ds, "x", 5.0).collect()] == ["b"]
    assert [r.s for r in layout.point_lookup(ds, "x", nan).collect()] == ["c"]
    assert [r.s for r in layout.point_lookup(ds, "d", "2024-01-03").collect()] == ["c"]  # text against a date column
    assert layout.files_between(ds, "x", 1.0, 2.0) == [] and layout.point_lookup(ds, "x", 1.0).count() == 0
    src = spark.createDataFrame([(5.0, "2024-01-02", "B")], "x DOUBLE, d STRING, s STRING").select("x", F.col("d").cast("date"), "s")
    ds.merge(src, ["x"]).when_matched_update_all().when_not_matched_insert_all().execute()
    assert ds.to_df().count() == 3


def test_compaction_keeps_partitions_and_splits_large_ones(spark, tmp_root):
    ds = VersionedDataset.create(spark, tmp_root, "k BIGINT, p STRING", partition_by=["p"])
    for i in range(4):
        ds.append(spark.range(i * 10, i * 10 + 10).select("id", F.lit("hot")).toDF("k", "p"))
    assert layout.version_files(ds).count() == 4
    layout.compact(ds)
    assert layout.version_files(ds).count() < 4 and ds.to_df().where("p = 'hot'").count() == 40
    assert layout.point_lookup(ds, "k", 7).first().p == "hot"


def test_bins(spark):
    assert layout.pack_bins([5, 5, 5, 5], 10, True) == [[0, 1], [2, 3]]
    assert layout.pack_bins([9, 5, 4, 1, 8], 10, False) == [[0, 3], [1, 2]]
    assert layout.pack_bins([9, 9], 10, False) == [] and layout.pack_bins([], 10, True) == []


def _hold(ds, column):
    """Files that can hold each of some values."""
    return [layout.skipping(ds, column, v, v).where("hit").count() for v in (3, 400, 777, 1500, 3999)]


def test_compaction_keeps_a_clustered_dataset_clustered(spark, tmp_root):
    ds = small_appends(spark, tmp_root)
    layout.cluster_by(ds, ["k"], n_files=16)
    before, rows, size = _hold(ds, "k"), sorted(ds.to_df().collect()), layout.dataset_file_sizes(ds).agg(F.max("file_size")).first()[0]
    layout.compact(ds, 4 * size)
    assert n_files(ds) in (4, 5, 6) and sorted(ds.to_df().collect()) == rows
    assert int(ds.latest().parameters["numRemovedFiles"]) == 16
    assert all(a <= b for a, b in zip(_hold(ds, "k"), before))
    ordered = ds._read_commit(ds.latest(), ("__file", "__row")).orderBy("__file", "__row").collect()
    assert all(a.k <= b.k for a, b in zip(ordered, ordered[1:]) if a["__file"] == b["__file"])  # in key order inside each file


def test_compaction_follows_the_curve(spark, tmp_root):
    from lakeops.operators import clustering

    ds = small_appends(spark, tmp_root)
    total = layout.dataset_file_sizes(ds).agg(F.sum("file_size")).first()[0]
    clustering.cluster(ds, ["k", "g"], total // 16)
    spans = lambda: [
        (r.lo, r.hi) for r in clustering._intervals(ds._read_commit(ds.latest(), ("__file",)), clustering._curve(ds)).collect()]
    depth = lambda p: sum(lo <= p <= hi for lo, hi in spans())
    before = [depth(p) for p in (100, 20_000, 50_000)]
    n, size = n_files(ds), layout.dataset_file_sizes(ds).agg(F.max("file_size")).first()[0]
    layout.compact(ds, 4 * size)
    assert n_files(ds) < n and all(a <= b for a, b in zip([depth(p) for p in (100, 20_000, 50_000)], before))
    clustering.cluster(ds, target_file_bytes=total // 16)
    assert int(ds.latest().parameters["numYoungFiles"]) == 0 and ds.to_df().count() == 4000  # the packed files are known to the curve


def _scan_side(df):
    """The nodes of a plan from each of its scans up to the first exchange above."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [re.search("[A-Z]", x).start() if re.search("[A-Z]", x) else 0 for x in lines]
    found = []
    for i, line in enumerate(lines):
        if "Scan parquet" in line:
            at = depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < at:
                    if lines[j][depth[j] :].startswith("Exchange"):
                        break
                    at = depth[j]
                    found.append(lines[j][at:].split("(")[0].split(" ")[0])
    return found


def test_file_stats_of_texts_sort_no_rows(spark, tmp_root):
    """Spark sorts rows to find the least text of a group; only distinct values per file may come to that."""
    df = spark.range(400).select(
        F.col("id").alias("k"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("é"), F.col("id") % 7)).alias("a.b"),
        F.lit(None).cast("string").alias("none"), F.struct((F.col("id") % 3).alias("x")).alias("s"),
    )
    ds = VersionedDataset.from_dataframe(spark, tmp_root, df.repartition(3, "k"))
    columns = ["a.b", "k", "none", "s"]
    stats = layout.dataset_file_stats(ds, columns)
    assert stats.columns == ["file_path", "num_rows", *[f"{c}__{x}" for c in columns for x in ("min", "max", "nulls")]]
    want = {}
    for r in ds._read_commit(ds.latest(), ("__file",)).collect():
        want.setdefault(r["__file"], []).append(r)
    got = {r.file_path: r for r in stats.collect()}
    assert got.keys() == want.keys()
    for path, rows in want.items():
        for c in columns:
            values = [r[c] for r in rows if r[c] is not None]
            ends = (min(values), max(values)) if values else (None, None)
            assert (got[path][f"{c}__min"], got[path][f"{c}__max"], got[path][f"{c}__nulls"]) == (*ends, len(rows) - len(values))
        assert got[path].num_rows == len(rows)
    for asked in (stats, stats.select("file_path", "`a.b__min`", "`a.b__max`")):  # also where the optimizer prunes
        nodes = _scan_side(asked)
        assert nodes.count("HashAggregate") >= 3 and not any("Sort" in n for n in nodes), nodes


@pytest.mark.parametrize("columns", [["k"], ["k", "t"]])
def test_clustered_files_hold_a_bounded_number_of_bytes_in_a_sort(spark, tmp_root, monkeypatch, columns):
    """Rows that compress well would otherwise meet in one file, and so in one task's sort, however many they are."""
    df = spark.range(20_000).select((F.col("id") % 2_000).alias("k"), F.lit("x" * 100).alias("t"))
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/small", df.limit(10))
    assert layout._sort_bytes(ds.to_df()) == 10 * (3 * 8 + layout.SORT_ROW_BYTES + 104)
    ds = VersionedDataset.from_dataframe(spark, f"{tmp_root}/ds", df)
    monkeypatch.setattr(layout, "SORT_BYTES", 400_000)
    layout.cluster_by(ds, columns)
    held = [r.num_rows for r in layout.dataset_file_sizes(ds).collect()]
    assert sum(held) == 20_000 and len(held) == 8 and max(held) < 5_000
    assert sorted(ds.to_df().groupBy("k").count().collect()) == sorted(df.groupBy("k").count().collect())


def test_bytes_in_a_sort_of_every_type(spark):
    df = spark.sql("""select 1 as i, 'abc' as s, cast(null as string) as n, array(1, 2) as a, map('k', 1) as m, cast(1 as decimal(30, 2)) as d,
        named_struct('x', 'y') as st, parse_json('{"a": 1}') as v, x'00' as b, interval 1 month as y""")
    assert 10 * 8 < layout._sort_bytes(df) < 400 and layout._sort_bytes(df.limit(0)) == 0
