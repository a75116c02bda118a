"""Streams (restart delivers only new input), incremental counts, catalog, builder."""

import pytest
from pyspark.sql.types import IntegerType

from conftest import rows
from lakeops.plans import incremental
from lakeops.plans.catalog import Catalog
from lakeops.plans.versioned import DatasetBuilder, VersionError, VersionedDataset
from lakeops.streaming import changes as cstream
from lakeops.streaming import lines


def test_line_stream_restart_reads_only_new_files(spark, tmp_root):
    src, out, ck = f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck"
    spark.createDataFrame([("a",), ("b",)], "value STRING").write.text(f"{src}/1")
    lines.run(lines.to_parquet(lines.line_stream(spark, f"{src}/*"), out, ck), 120)
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([("c",)], "value STRING").write.text(f"{src}/2")
    lines.run(lines.to_parquet(lines.line_stream(spark, f"{src}/*"), out, ck), 120)
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_preview_keeps_at_most_ten_per_batch(spark, tmp_root):
    src = f"{tmp_root}/in"
    spark.range(25).selectExpr("cast(id as string) as value").coalesce(1).write.text(f"{src}/1")
    spark.range(3).selectExpr("cast(id as string) as value").coalesce(1).write.text(f"{src}/2")
    q = lines.preview_batches(lines.line_stream(spark, f"{src}/*", 1), f"{tmp_root}/out", f"{tmp_root}/ck")
    lines.run(q, 120)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(f"{tmp_root}/out").groupBy("batch_id").count().collect()}
    assert sorted(counts.values()) == [3, 10]


def test_change_stream_only_new_commits(spark, tmp_root):
    ds = VersionedDataset.create(spark, f"{tmp_root}/perro", "nombre STRING, raza STRING",
                                 properties={"enableChangeDataFeed": "true"})
    ds.insert_values([("Rex", "pastor alemán"), ("Dexter", "doberman"), ("Poppy", "caniche")])
    sink, ck = f"{tmp_root}/sink", f"{tmp_root}/ck"
    lines.run(cstream.deliver_changes(ds, cstream.parquet_change_writer(sink), ck), 120)
    assert cstream.read_change_sink(spark, sink).count() == 3
    ds.insert_values([("Doc", "San Bernardo")])
    ds.update({"nombre": "'Dog'"}, "nombre = 'Doc'")
    seen = []
    lines.run(cstream.deliver_changes(ds, lambda df, v: seen.append(v), ck + "2", starting_version=3), 120)
    assert seen == [[3]]  # v0 create, v1 insert, v2 insert Doc, v3 update
    lines.run(cstream.deliver_changes(ds, cstream.parquet_change_writer(sink), ck), 120)
    assert cstream.read_change_sink(spark, sink).count() == 3 + 1 + 2


def test_incremental_counts_replay_is_noop(spark, tmp_root):
    src = VersionedDataset.create(spark, f"{tmp_root}/o", "cust INT, x STRING", properties={"enableChangeDataFeed": "true"})
    src.insert_values([(1, "a"), (1, "b"), (2, "c"), (None, "d")])
    agg = incremental.create_count(spark, f"{tmp_root}/agg", src.to_df(), ["cust"], source_version=1)
    src.delete("x = 'c'")
    src.update({"cust": "3"}, "x = 'a'")
    src.insert_values([(None, "e"), (None, "f")])
    ch = src.changes(2)
    assert incremental.apply_changes(agg, ch, ["cust"], up_to_version=4)
    assert not incremental.apply_changes(agg, ch, ["cust"], up_to_version=4)  # replay
    assert rows(incremental.current_counts(agg)) == sorted([(1, 1), (3, 1), (None, 3)], key=repr)  # NULL keys match


def test_catalog_clone_and_change_stream(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    cat.create("a", "k INT", properties={"enableChangeDataFeed": "true"}).insert_values([(1,), (2,)])
    cat.clone("a", "b").insert_values([(3,)])
    with pytest.raises(VersionError):
        cat.clone("a", "b")
    assert cat.table("a").count() == 2 and cat.table("b").count() == 3
    feed = cstream.change_stream(cat.for_name("b"))
    assert feed.isStreaming
    lines.run(lines.to_parquet(feed.where("k > 1"), f"{tmp_root}/out", f"{tmp_root}/ck2"))
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_root}/out").collect()) == [2, 3]


def test_catalog_names(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    ds = cat.create("tabla1", "nombre STRING, edad STRING")
    ds.insert_values([("Pepe", "16")])
    assert cat.table("tabla1").count() == 1
    cat.save_as("tabla1", spark.createDataFrame([("Ana", "3"), ("Eva", "4")], "nombre STRING, edad STRING"), mode="overwrite")
    assert cat.table("tabla1").count() == 2 and cat.table("tabla1", 1).count() == 1
    with pytest.raises(VersionError, match="feed was off"):
        cat.table_changes("tabla1", 0)
    cat.create_view("tabla1")
    assert spark.sql("SELECT * FROM tabla1 WHERE nombre = 'Ana'").count() == 1
    root = ds.root
    cat.drop("tabla1")
    with pytest.raises(VersionError):
        cat.for_name("tabla1")
    assert VersionedDataset.for_path(spark, root).to_df().count() == 2  # files stay
    cat.drop("tabla1")  # IF EXISTS: no error


def test_builder_modes(spark, tmp_root):
    root = f"{tmp_root}/example"
    with pytest.raises(VersionError):
        DatasetBuilder.replace(spark).location(root).add_column("c1", "INT").execute()
    ds = (DatasetBuilder.create(spark).location(root).add_column("c1", IntegerType(), nullable=False)
          .add_column("c2", "INT", generated_always_as="c1 + 1").partitioned_by("c1").execute())
    with pytest.raises(VersionError):
        DatasetBuilder.create(spark).location(root).add_column("c1", "INT").execute()
    assert DatasetBuilder.create_if_not_exists(spark).location(root).add_column("z", "INT").execute().latest_version() == 0
    ds.append(spark.createDataFrame([(1,), (5,)], "c1 INT"))
    assert rows(ds.to_df()) == [(1, 2), (5, 6)]
    DatasetBuilder.replace(spark).location(root).add_column("z", "STRING").execute()
    assert ds.to_df().columns == ["z"] and ds.to_df().count() == 0 and ds.to_df(1).count() == 2


def test_change_feed_default_from_session(spark, tmp_root):
    spark.conf.set("lakeops.properties.defaults.enableChangeDataFeed", "true")
    try:
        ds = VersionedDataset.create(spark, tmp_root, "k INT")
    finally:
        spark.conf.unset("lakeops.properties.defaults.enableChangeDataFeed")
    ds.insert_values([(1,)])
    assert ds.changes(0).count() == 1
    ds2 = VersionedDataset.create(spark, tmp_root + "x", "k INT")
    ds2.insert_values([(1,)])
    with pytest.raises(VersionError, match="feed was off"):
        ds2.changes(0)
    ds2.set_properties(enableChangeDataFeed="true")  # ALTER TABLE ... SET TBLPROPERTIES
    ds2.insert_values([(2,)])
    assert [r._commit_version for r in ds2.changes(2).collect()] == [3]


def test_timestamp_range_errors(spark, tmp_root):
    ds = VersionedDataset.create(spark, tmp_root, "k INT", properties={"enableChangeDataFeed": "true"})
    ds.insert_values([(1,)])
    with pytest.raises(VersionError):
        ds.changes_between_timestamps("2999-01-01 00:00:00")
    with pytest.raises(VersionError):
        ds.changes(5)
    ts = ds.history().where("version = 1").first().timestamp
    assert ds.changes_between_timestamps(ts).count() == 1


def test_one_second_micro_batches_until_stopped(spark, tmp_root):
    src, out, ck = f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck"
    spark.createDataFrame([("first",)], "value STRING").write.text(f"{src}/1")
    q = lines.to_parquet(lines.line_stream(spark, f"{src}/*"), out, ck, interval="1 second")
    try:
        q.processAllAvailable()
        spark.createDataFrame([("second",), ("third",)], "value STRING").write.text(f"{src}/2")
        q.processAllAvailable()  # picked up by a later 1-second trigger of the same running query
        assert q.isActive
    finally:
        q.stop()
    assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["first", "second", "third"]


def test_change_feed_property_with_prefix(spark, tmp_root):
    ds = VersionedDataset.create(spark, tmp_root, "nombre STRING, raza STRING",
                                 properties={"delta.enableChangeDataFeed": "true"}, mode="create_or_replace")
    ds.insert_values([("Rex", "pastor alemán")])
    ds.update({"nombre": "'Regex'"}, "nombre = 'Rex'")
    assert sorted(r._change_type for r in ds.changes(0).collect()) == ["insert", "update_postimage", "update_preimage"]


def test_builder_by_table_name_reference_spelling(spark, tmp_root):
    cat = Catalog(spark, tmp_root)
    dt = (DatasetBuilder.createOrReplace(spark).tableName("muebles1", cat)
          .addColumn("nombre", dataType="STRING", nullable=False)
          .addColumn("descripcion", dataType="STRING", nullable=False)
          .execute())
    dt.insert_values([("silla", "grande")])
    assert cat.forName("muebles1").toDF().count() == 1
    again = DatasetBuilder.createOrReplace(spark).tableName("muebles1", cat).addColumn("nombre", "STRING").execute()
    assert again.root == dt.root and again.toDF().count() == 0  # replaced in place: new version, same name
    assert Catalog.default(spark).base.endswith("/lakeops")
