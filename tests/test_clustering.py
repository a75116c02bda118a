"""Hilbert-curve clustering: the curve, the sweep, and how little a later run rewrites."""

import itertools

import pytest
from pyspark.sql import functions as F

from lakeops.operators import clustering, layout
from lakeops.plans.versioned import VersionedDataset


@pytest.mark.parametrize("k, bits", [(1, 3), (1, 8), (2, 1), (2, 4), (2, 6), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_one_column(spark, k, bits):
    rows = clustering.hilbert_positions(spark, k, bits).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(2 ** (k * bits))) and len({r.cell for r in rows}) == len(rows)
    at = [tuple(r.cell >> (j * bits) & (2**bits - 1) for j in range(k)) for r in rows]
    for a, b in itertools.pairwise(at):
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def test_sweep_equals_counting_intervals_at_every_position(spark):
    import random

    rng = random.Random(4)
    for _ in range(4):
        spans = [(lo, lo + rng.randrange(12), rng.random() < 0.3) for lo in (rng.randrange(40) for _ in range(25))]
        df = spark.createDataFrame([(f"f{i}", *s) for i, s in enumerate(spans)], "file_path string, lo long, hi long, young boolean")
        depth_at = lambda p: sum(lo <= p < hi for lo, hi, y in spans if not y) + any(lo <= p < hi for lo, hi, y in spans if y)
        for r in clustering.depth_by_position(df).collect():
            assert r.depth == depth_at(r.position)
        for most in (1, 2, 4):
            expected = {f"f{i}" for i, (lo, hi, y) in enumerate(spans) if y or any(depth_at(p) > most for p in range(lo, hi))}
            assert {r.file_path for r in clustering.files_to_rewrite(df, most).collect()} == expected


def _points(spark, n=20_000):
    h = spark.range(n).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a.b"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("y"))
    return h.withColumn("t", F.concat(F.lit("text-"), F.col("y")))


def _target(ds, files):
    return layout.dataset_file_sizes(ds).agg(F.sum("file_size")).first()[0] // files


def _holding(ds, column, value):
    col = F.col(f"`{column}`")
    per_file = ds._read_commit(ds.latest(), ("__file",)).groupBy("__file").agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return per_file.where(F.lit(value).between(F.col("lo"), F.col("hi"))).count(), per_file.count()


def _report(ds):
    return {k: int(v) for k, v in ds.latest().parameters.items() if k.startswith("num")}


def test_later_runs_rewrite_a_part(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, _points(spark).repartition(16))
    target = _target(ds, 16)
    before = sorted(map(repr, ds.to_df().collect()))
    clustering.cluster(ds, ["a.b", "t"], target)
    assert sorted(map(repr, ds.to_df().collect())) == before and _report(ds)["numRemovedFiles"] == 16
    for column, value in (("a.b", 500), ("t", "text-500")):  # narrow in both columns
        held, files = _holding(ds, column, value)
        assert held <= files / 2
    clustering.cluster(ds, target_file_bytes=target)
    assert _report(ds)["numRemovedFiles"] == 0  # nothing new, nothing to do

    ds.append(_points(spark, 200).withColumn("id", F.col("id") + 100_000).repartition(4))  # 1 %, all over the curve
    n = _report_files(ds)
    clustering.cluster(ds, target_file_bytes=target)
    assert _report(ds)["numRemovedFiles"] == _report(ds)["numYoungFiles"] == 4 and _report(ds)["numFiles"] == n
    assert ds.to_df().count() == 20_200 and ds.to_df(0).count() == 20_000

    near = _points(spark).where("`a.b` < 60 and y < 60").withColumn("id", F.col("id") + 200_000)  # one corner
    ds.append(near.coalesce(1))
    clustering.cluster(ds, target_file_bytes=target)
    part = _report(ds)  # only the corner is three layers deep now
    assert part["numYoungFiles"] == 1 and 1 < part["numRemovedFiles"] < part["numFiles"] // 2
    assert ds.to_df().count() == 20_200 + near.count()


def _report_files(ds):
    return layout.version_files(ds).count()


def test_layers_are_merged_when_too_deep(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, _points(spark, 4000).repartition(4))
    target = _target(ds, 4)
    clustering.cluster(ds, ["y"], target)
    rewritten = []
    for i in range(3):
        ds.append(_points(spark, 100).withColumn("id", F.col("id") + 10_000 * (i + 1)).coalesce(1))
        clustering.cluster(ds, target_file_bytes=target, max_depth=2)
        rewritten.append(_report(ds)["numRemovedFiles"])
    assert rewritten[0] == rewritten[2] == 1 and rewritten[1] > 4 and ds.to_df().count() == 4300
    held, files = _holding(ds, "y", 500)
    assert held <= 2 < files


def test_hot_values_nulls_updates_and_other_columns(spark, tmp_root):
    hot = _points(spark, 6000).withColumn("y", F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 5 != 0, F.col("y")))
    ds = VersionedDataset.from_dataframe(spark, tmp_root, hot.repartition(3), properties={"enableChangeDataFeed": "true"})
    clustering.cluster(ds, ["y"], _target(ds, 8))
    assert _holding(ds, "y", 7)[0] >= 3  # one value, several files
    ds.update({"t": "'changed'"}, "id = 11")
    clustering.cluster(ds, target_file_bytes=_target(ds, 8))
    assert _report(ds)["numRemovedFiles"] <= 3 and ds.changes(ds.latest_version()).count() == 0
    clustering.cluster(ds, ["t", "y"], _target(ds, 8))
    assert _report(ds)["numRemovedFiles"] == _report(ds)["numFiles"]
    assert sorted(map(repr, ds.to_df().collect())) == sorted(map(repr, hot.withColumn("t", F.when(F.col("id") == 11, "changed").otherwise(F.col("t"))).collect()))


def test_empty_and_refused(spark, tmp_root):
    ds = VersionedDataset.create(spark, f"{tmp_root}/e", "a INT, b BINARY")
    with pytest.raises(ValueError):
        clustering.cluster(ds)
    with pytest.raises(ValueError):
        clustering.cluster(ds, ["b"])
    clustering.cluster(ds, ["a"])
    assert ds.to_df().count() == 0 and ds.latest().operation == "OPTIMIZE"


def test_stats_of_any_column_name_come_before_the_commit(spark, tmp_root):
    ds = VersionedDataset.from_dataframe(spark, tmp_root, _points(spark, 2000).repartition(4))
    v = layout.cluster_by(ds, ["a.b"], n_files=4)
    assert len(layout.files_between(ds, "a.b", 500, 500)) == 1
    assert layout.point_lookup(ds, "a.b", 500).count() == ds.to_df().where("`a.b` = 500").count()
    assert layout.cluster_by(ds, ["a.b", "y"], n_files=4) == v + 1


def test_positions_are_compiled_and_equal_a_count_of_cuts(spark):
    """No function of higher order runs per row; NULL, NaN and values equal to a cut fall where they fell."""
    cuts = [["1.0", "2.5", "7.0", "NaN"], ["a", "é", "漢"]]
    curve = {"columns": ["x", "t.u"], "cuts": cuts}
    nan = float("nan")
    rows = [(x, t) for x in (None, nan, -1.0, 1.0, 2.4, 2.5, 9.0) for t in (None, "", "a", "b", "é", "漢", "\U0001f600")]
    df = spark.createDataFrame(rows, "x double, `t.u` string")
    above = lambda v, points, key: 0 if v is None else sum(key(p) <= key(v) for p in points)
    number = lambda v: (v != v, 0.0 if v != v else v)
    text = lambda v: v.encode()
    bits = clustering.column_bits(2)
    got = clustering._with_buckets(df, curve, bits).collect()
    for r in got:
        assert (r["__bucket0"], r["__bucket1"]) == (above(r.x, [1.0, 2.5, 7.0, nan], number), above(r["t.u"], cuts[1], text))
    place = {r.cell: r.position for r in clustering.hilbert_positions(spark, 2, bits).collect()}
    placed = clustering.with_position(df, curve)
    assert placed.columns == ["x", "t.u", "__position"]
    same = lambda rows: sorted(map(repr, rows))
    assert same((r.x, r["t.u"], r["__position"]) for r in placed.collect()) == same(
        (r.x, r["t.u"], place[r["__bucket0"] + (r["__bucket1"] << bits)]) for r in got)
    assert "lambda" not in clustering._with_buckets(df, curve, bits)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_first_run_rewrites_every_file_without_a_look_at_its_stretch(spark, tmp_root, monkeypatch):
    seen = []
    intervals = clustering._intervals
    monkeypatch.setattr(clustering, "_intervals", lambda rows, curve: seen.append(1) or intervals(rows, curve))
    df = spark.range(3_000).select(F.col("id").alias("k"), (F.col("id") * 7 % 100).alias("j"))
    ds = VersionedDataset.from_dataframe(spark, tmp_root, df.repartition(4))
    clustering.cluster(ds, ["k", "j"], 10_000)
    done = ds.latest().parameters
    assert done["numRemovedFiles"] == done["numYoungFiles"] == done["numFiles"] and len(seen) == 1  # of the files written
    assert sorted(ds.to_df().collect()) == sorted(df.collect())


def test_clustered_files_hold_a_bounded_number_of_bytes_in_a_sort(spark, tmp_root, monkeypatch):
    df = spark.range(20_000).select((F.col("id") % 2_000).alias("k"), F.lit("x" * 100).alias("t"))
    ds = VersionedDataset.from_dataframe(spark, tmp_root, df)
    monkeypatch.setattr(clustering, "SORT_BYTES", 400_000)
    clustering.cluster(ds, ["k"])
    assert ds.to_df().count() == 20_000 and layout.version_files(ds).count() == 8
