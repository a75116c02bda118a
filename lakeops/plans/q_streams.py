"""Registered queries: line streams (A10, L1-L3), the streaming change feed (A9, L4,
L5, M6) and the aggregate kept from changes (M4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.plans import incremental
from lakeops.plans.registry import nk, nk_sql, query, table
from lakeops.plans.versioned import VersionedDataset
from lakeops.session import scratch_dir
from lakeops.streaming import changes as cstream
from lakeops.streaming import lines
from lakeops.streaming.keyed_sink import KeyedSink


def _event_lines(spark, sf_dir, folder: str) -> None:
    """events as CSV text lines, dropped into ``folder`` as two separate writes."""
    ev = table(spark, sf_dir, "events")
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("event_type"), F.col("user_id").cast("string"))
    ev.where(F.col("event_type").isin("click", "view")).select(line.alias("value")).write.text(f"{folder}/a")
    ev.where(~F.col("event_type").isin("click", "view")).select(line.alias("value")).write.text(f"{folder}/b")


@query("line_stream", "select event_type, count(*) as n from events group by event_type")
def line_stream(spark, sf_dir):
    work = scratch_dir(spark, "line-stream")
    src = f"{work}/in"
    _event_lines(spark, sf_dir, src)
    sdf = lines.line_stream(spark, f"{src}/*")
    parsed = sdf.select(F.split("value", ",").getItem(1).alias("event_type"))
    lines.run(lines.to_parquet(parsed, f"{work}/out", f"{work}/_checkpoint"))
    return spark.read.parquet(f"{work}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_batch_preview", "select true as at_most_ten, true as not_empty, cast(0 as bigint) as foreign_lines")
def stream_batch_preview(spark, sf_dir):
    """Every micro-batch shows one to ten lines, all of them lines of the events."""
    work = scratch_dir(spark, "preview")
    src = f"{work}/in"
    _event_lines(spark, sf_dir, src)
    lines.run(lines.preview_batches(lines.line_stream(spark, f"{src}/*"), f"{work}/out", f"{work}/_checkpoint"))
    shown = spark.read.parquet(f"{work}/out")
    sizes = shown.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).agg(
        (F.max("n") <= lines.PREVIEW_ROWS).alias("at_most_ten"), (F.min("n") > 0).alias("not_empty")
    )
    foreign = shown.join(spark.read.text(f"{src}/*"), "value", "left_anti").agg(F.count(F.lit(1)).alias("foreign_lines"))
    return sizes.crossJoin(foreign)  # two one-row aggregates


@query(
    "changes_stream",
    """select _commit_version, _change_type, count(*) as n from (
      select 'insert' as _change_type, cast(0 as bigint) as _commit_version from customer where c_mktsegment <> 'HOUSEHOLD'
      union all select 'insert', cast(1 as bigint) from customer where c_mktsegment = 'HOUSEHOLD'
      union all select 'update_preimage', cast(2 as bigint) from customer where c_acctbal < 0
      union all select 'update_postimage', cast(2 as bigint) from customer where c_acctbal < 0
      union all select 'delete', cast(3 as bigint) from customer where c_mktsegment = 'MACHINERY')
    group by _commit_version, _change_type""",
)
def changes_stream(spark, sf_dir):
    work = scratch_dir(spark, "change-stream")
    c = table(spark, sf_dir, "customer")
    ds = VersionedDataset.from_dataframe(
        spark, f"{work}/customer", c.where("c_mktsegment <> 'HOUSEHOLD'"), properties={"enableChangeDataFeed": "true"}
    )
    writer = cstream.parquet_change_writer(f"{work}/sink")
    ck = f"{work}/_checkpoint"
    lines.run(cstream.deliver_changes(ds, writer, ck))  # sees version 0
    ds.append(c.where("c_mktsegment = 'HOUSEHOLD'"))
    ds.update({"c_acctbal": "0.0"}, "c_acctbal < 0")
    lines.run(cstream.deliver_changes(ds, writer, ck))  # restart: only versions 1, 2
    ds.delete("c_mktsegment = 'MACHINERY'")
    lines.run(cstream.deliver_changes(ds, writer, ck))  # only version 3
    return cstream.change_counts(cstream.read_change_sink(spark, f"{work}/sink"))


@query(
    "changes_stream_frame",
    """select c_nationkey, count(*) as n from customer
    where c_mktsegment <> 'HOUSEHOLD' or c_acctbal < 0 group by c_nationkey""",
)
def changes_stream_frame(spark, sf_dir):
    """The change feed as a streaming DataFrame: filtered and written like any other."""
    work = scratch_dir(spark, "change-frame")
    c = table(spark, sf_dir, "customer")
    ds = VersionedDataset.from_dataframe(
        spark, f"{work}/customer", c.where("c_mktsegment <> 'HOUSEHOLD'"), properties={"enableChangeDataFeed": "true"}
    )
    ds.append(c.where("c_mktsegment = 'HOUSEHOLD' and c_acctbal < 0"))
    ds.delete("c_mktsegment = 'MACHINERY'")
    inserts = cstream.change_stream(ds).where("_change_type = 'insert'").select("c_custkey", "c_nationkey")
    lines.run(lines.to_parquet(inserts, f"{work}/out", f"{work}/_checkpoint"))
    return spark.read.parquet(f"{work}/out").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "incremental_aggregate",
    f"""select case when o_orderpriority = '1-URGENT' then k + 1 else k end as o_custkey, count(*) as n
    from (select {nk_sql('o_custkey', 'o_custkey', 11)} as k, o_orderpriority from orders)
    where o_orderpriority <> '5-LOW' group by 1""",
)
def incremental_aggregate(spark, sf_dir):
    work = scratch_dir(spark, "incremental")
    o = table(spark, sf_dir, "orders").withColumn("o_custkey", nk("o_custkey", "o_custkey", 11))  # NULL keys too
    ds = VersionedDataset.from_dataframe(
        spark, f"{work}/orders", o.where("o_orderstatus <> 'P'"), properties={"enableChangeDataFeed": "true"}
    )
    agg = incremental.create_count(spark, f"{work}/per_customer", ds.to_df(0), ["o_custkey"], source_version=0)

    def on_changes(changes, versions):
        incremental.apply_changes(agg, changes, ["o_custkey"], up_to_version=max(versions))

    ck = f"{work}/_checkpoint"
    ds.append(o.where("o_orderstatus = 'P'"))
    ds.delete("o_orderpriority = '5-LOW'")
    lines.run(cstream.deliver_changes(ds, on_changes, ck, starting_version=1))
    ds.update({"o_custkey": "o_custkey + 1"}, "o_orderpriority = '1-URGENT'")
    lines.run(cstream.deliver_changes(ds, on_changes, ck, starting_version=1))
    return incremental.current_counts(agg)


@query(
    "incremental_min_max_mean",
    f"""with o as (
      select {nk_sql('o_custkey', 'o_custkey', 11)} as o_custkey,
        cast(o_totalprice as decimal(18,2)) as price, o_orderpriority
      from orders where o_orderpriority <> '5-LOW'),
    final as (select o_custkey, case when o_orderpriority = '1-URGENT' then price + 1 else price end as price from o)
    select o_custkey, count(*) as n_rows, cast(sum(price) as double) as total, cast(sum(price) as double) / count(*) as mean,
      cast(min(price) as double) as least, cast(max(price) as double) as most
    from final group by o_custkey""",
)
def incremental_min_max_mean(spark, sf_dir):
    """Sum, mean, min and max per customer, kept from inserts, deletes and updates without reading the orders again."""
    work = scratch_dir(spark, "incremental-stats")
    o = table(spark, sf_dir, "orders").withColumn("o_custkey", nk("o_custkey", "o_custkey", 11))  # NULL keys too
    o = o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    ds = VersionedDataset.from_dataframe(
        spark, f"{work}/orders", o.where("o_orderstatus <> 'P'"), properties={"enableChangeDataFeed": "true"}
    )
    stats = incremental.KeyStats.create(spark, f"{work}/stats", ds.to_df(0), ["o_custkey"], "o_totalprice", source_version=0)
    ds.append(o.where("o_orderstatus = 'P'"))
    ds.delete("o_orderpriority = '5-LOW'")
    stats.apply(ds.changes(1), 2)
    ds.update({"o_totalprice": "o_totalprice + 1"}, "o_orderpriority = '1-URGENT'")
    stats.apply(ds.changes(3), 3)
    out = stats.current()
    return out.select("o_custkey", "n_rows", *[F.col(c).cast("double").alias(c) for c in ("total", "mean", "least", "most")])


@query(
    "changes_keyed_sink",
    """select c_custkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal, c_mktsegment
    from customer where c_mktsegment <> 'MACHINERY'""",
)
def changes_keyed_sink(spark, sf_dir):
    """Batches of the feed, out of order and repeated, leave the replica as the source."""
    work = scratch_dir(spark, "keyed-sink")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    ds = VersionedDataset.from_dataframe(
        spark, f"{work}/customer", c.where("c_mktsegment <> 'HOUSEHOLD'"), properties={"enableChangeDataFeed": "true"}
    )
    ds.append(c.where("c_mktsegment = 'HOUSEHOLD'"))
    ds.update({"c_acctbal": "0.0"}, "c_acctbal < 0")
    ds.delete("c_mktsegment = 'MACHINERY'")
    sink = KeyedSink.create(spark, f"{work}/replica", ds.latest().schema, ["c_custkey"])
    for lo, hi in ((3, 3), (0, 1), (2, 2), (0, 2)):
        sink.apply(ds.changes(lo, hi))
    return sink.rows()
