"""Registered queries: row-level operations (I), versioned datasets (A4-A8, B, J).

Every query builds its datasets from the driver tables in a fresh folder under
the shared checkpoint folder, runs the commits eagerly and returns a lazy read
of the resulting state. The oracle SQL computes the same state directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeops.operators import layout, rowops
from lakeops.plans import intervals
from lakeops.plans.catalog import Catalog
from lakeops.plans.registry import nk, nk_sql, query, table
from lakeops.plans.versioned import AmbiguousMergeError, DatasetBuilder, VersionedDataset, VersionError
from lakeops.session import scratch_dir

CDF = {"enableChangeDataFeed": "true"}
ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
CUST_COLS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


# ------------------------------------------------------------ row-level (I)

@query(
    "update_rows",
    f"""select o_orderkey, o_custkey,
      case when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then 'X' else o_orderstatus end as o_orderstatus,
      o_totalprice, o_orderdate,
      case when o_orderpriority = '1-URGENT' and o_orderstatus = 'O' then o_orderstatus else o_orderpriority end
        as o_orderpriority
    from orders""",
)
def update_rows(spark, sf_dir):
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "orders"), table(spark, sf_dir, "orders"))
    # Both SET expressions see the old row: the priority receives the old status.
    ds.update(
        {"o_orderstatus": "'X'", "o_orderpriority": F.col("o_orderstatus")},
        "o_orderpriority = '1-URGENT' and o_orderstatus = 'O'",
    )
    return ds.to_df()


@query(
    "update_not_equal",
    f"""select o_orderkey, case when o_orderstatus <> 'F' then 'X' else o_orderstatus end as o_orderstatus
    from (select o_orderkey, {nk_sql('o_orderstatus', 'o_orderkey', 13)} as o_orderstatus from orders)""",
)
def update_not_equal(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", nk("o_orderstatus", "o_orderkey", 13).alias("o_orderstatus"))
    return rowops.update_rows(o, {"o_orderstatus": F.lit("X")}, F.col("o_orderstatus") != "F")  # NULL untouched


@query(
    "delete_rows",
    f"""select * from (select o_orderkey, {nk_sql('o_orderstatus', 'o_orderkey', 13)} as o_orderstatus, o_totalprice
    from orders) where (o_orderstatus = 'F') is not true""",
)
def delete_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", nk("o_orderstatus", "o_orderkey", 13).alias("o_orderstatus"), "o_totalprice"
    )
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "orders"), o)
    ds.delete("o_orderstatus = 'F'")  # rows whose status is NULL stay
    return ds.to_df()


@query("delete_all", "select count(*) as rows_before, cast(0 as bigint) as rows_after from orders")
def delete_all(spark, sf_dir):
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "orders"), table(spark, sf_dir, "orders"))
    ds.delete()
    before = ds.to_df(0).agg(F.count(F.lit(1)).alias("rows_before"))
    after = ds.to_df().agg(F.count(F.lit(1)).alias("rows_after"))
    return before.crossJoin(after)  # two one-row aggregates


def _orders_merge(spark, sf_dir, change_feed=False) -> VersionedDataset:
    o = table(spark, sf_dir, "orders")
    target = VersionedDataset.from_dataframe(
        spark, scratch_dir(spark, "orders"), o.where("o_orderstatus <> 'P'"), properties=CDF if change_feed else None
    )
    source = o.where("o_orderstatus <> 'F'").withColumn("o_orderpriority", F.lit("NEW"))
    (
        target.merge(source, "t.o_orderkey = s.o_orderkey")
        .when_matched_update({"o_orderpriority": "s.o_orderpriority", "o_totalprice": "s.o_totalprice + 1"})
        .when_not_matched_insert({c: f"s.{c}" for c in ORDERS_COLS.split(", ")})
        .execute()
    )
    return target


@query(
    "merge_upsert",
    f"""select {ORDERS_COLS} from orders where o_orderstatus = 'F'
    union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, 'NEW' from orders
      where o_orderstatus = 'O'
    union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'NEW' from orders
      where o_orderstatus = 'P'""",
)
def merge_upsert(spark, sf_dir):
    return _orders_merge(spark, sf_dir).to_df()


@query(
    "merge_insert_all",
    f"""select {CUST_COLS} from customer where c_mktsegment not in ('BUILDING', 'AUTOMOBILE')
    union all select c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment from customer
      where c_mktsegment in ('BUILDING', 'AUTOMOBILE')""",
)
def merge_insert_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    target = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "cust"), c.where("c_mktsegment <> 'BUILDING'"))
    source = VersionedDataset.from_dataframe(
        spark, scratch_dir(spark, "cust-src"),
        c.where("c_mktsegment in ('BUILDING', 'AUTOMOBILE')").withColumn("c_acctbal", F.col("c_acctbal") + 1),
    )
    (
        target.alias("tgt")
        .merge(source.to_df().alias("src"), "tgt.c_custkey = src.c_custkey", source_alias="src")
        .when_matched_update({"tgt.c_acctbal": "src.c_acctbal"})
        .when_not_matched_insert_all()
        .execute()
    )
    return target.to_df()


@query(
    "merge_insert_only",
    """select o_orderkey, o_orderstatus, true as only_appended from orders where o_orderpriority <> '1-URGENT'
    union all select o_orderkey, 'new', true from orders where o_orderpriority = '1-URGENT'
    union all select o_orderkey, 'new', true from orders where o_orderpriority = '1-URGENT'""",
)
def merge_insert_only(spark, sf_dir):
    """Only an insert clause: every order is in the source twice; the unmatched ones come in twice, no file is rewritten."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    ds = VersionedDataset.from_dataframe(
        spark, scratch_dir(spark, "insert-only"), o.where("o_orderpriority <> '1-URGENT'").drop("o_orderpriority")
    )
    new = o.select("o_orderkey", F.lit("new").alias("o_orderstatus"))
    ds.merge(new.union(new), ["o_orderkey"]).when_not_matched_insert_all().execute()
    appended = not ds.latest().removed and ds.latest().base == 0
    return ds.to_df().withColumn("only_appended", F.lit(appended))


@query(
    "merge_limited_source",
    "select count(*) as rows, count(distinct o_orderkey) as keys, cast(100 as bigint) as changed from orders",
)
def merge_limited_source(spark, sf_dir):
    """A limit picks other rows at every evaluation: the source is written once and the same rows merge throughout."""
    o = table(spark, sf_dir, "orders")
    target = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "limited"), o)
    source = o.repartition(7).limit(100).withColumn("o_orderpriority", F.lit("NEW"))
    target.merge(source, ["o_orderkey"]).when_matched_update_all().when_not_matched_insert_all().execute()
    return target.to_df().agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("o_orderkey").alias("keys"),
        F.count_if(F.col("o_orderpriority") == "NEW").alias("changed"),
    )


@query(
    "merge_cross_joined_source",
    "select c_custkey, c_name, (select max(s_nationkey) from supplier)::integer as c_nationkey from customer",
)
def merge_cross_joined_source(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    last = table(spark, sf_dir, "supplier").agg(F.max("s_nationkey").alias("last"))
    source = c.crossJoin(last).select("c_custkey", F.col("last").alias("c_nationkey"))  # one row beside
    target = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "crossed"), c)
    target.merge(source, "t.c_custkey = s.c_custkey").when_matched_update({"c_nationkey": "s.c_nationkey"}).execute()
    return target.to_df()


@query("merge_pruned_nan", "select count(*) as rows, count(*) as finite from supplier where s_suppkey % 9 <> 0")
def merge_pruned_nan(spark, sf_dir):
    """Stats prune the target; files that hold NaN beside matching keys are not missed."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "case when s_suppkey % 9 = 0 then double('NaN') else double(s_suppkey) end as k", "s_name"
    )
    target = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "nan-merge"), s.repartition(4, "s_name"))
    layout.write_file_stats(target, ["k"], 0)
    source = s.where("not isnan(k)")
    target.merge(source, ["k"]).when_matched_update({"s_name": "upper(s.s_name)"}).when_not_matched_insert_all().execute()
    kept = target.to_df().where("not isnan(k)")
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("k").alias("finite"))


# ------------------------------------------------- customer version chain

_S2 = f"""(select c_custkey, c_name, c_nationkey, case when c_acctbal < 0 then 0.0 else c_acctbal end as c_acctbal,
    c_mktsegment from customer)"""
_S3 = f"(select * from {_S2} where c_mktsegment <> 'MACHINERY')"


def _customer_chain(spark, sf_dir, change_feed=False, root=None) -> VersionedDataset:
    """v0 CTAS (all but HOUSEHOLD) -> v1 append HOUSEHOLD -> v2 negative balances to 0
    -> v3 delete MACHINERY."""
    c = table(spark, sf_dir, "customer")
    ds = VersionedDataset.from_dataframe(
        spark, root or scratch_dir(spark, "customer"), c.where("c_mktsegment <> 'HOUSEHOLD'"),
        properties=CDF if change_feed else None,
    )
    ds.append(c.where("c_mktsegment = 'HOUSEHOLD'"))
    ds.update({"c_acctbal": "0.0"}, "c_acctbal < 0")
    ds.delete("c_mktsegment = 'MACHINERY'")
    return ds


@query("version_latest", f"select * from {_S3}")
def version_latest(spark, sf_dir):
    base = scratch_dir(spark, "catalog")
    cat = Catalog(spark, base)
    cat.register("customers", _customer_chain(spark, sf_dir))
    return cat.table("customers")  # by name -> root -> latest version


@query("version_as_of", f"select * from {_S2}")
def version_as_of(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir)
    return VersionedDataset.for_path(spark, ds.root).to_df(2)  # by path, VERSION AS OF 2


@query("restore_version", "select * from customer")
def restore_version(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir)
    ds.restore(1)
    return ds.to_df()


def _history_with_rows(ds: VersionedDataset, limit=None):
    """Rows per version as the commits recorded them: no version is read."""
    return ds.history(limit).select("version", "operation", "num_rows")


_HISTORY_SQL = """select 0 as version, 'CREATE TABLE AS SELECT' as operation,
      (select count(*) from customer where c_mktsegment <> 'HOUSEHOLD') as num_rows
    union all select 1, 'WRITE', (select count(*) from customer)
    union all select 2, 'UPDATE', (select count(*) from customer)
    union all select 3, 'DELETE', (select count(*) from customer where c_mktsegment <> 'MACHINERY')
    union all select 4, 'RESTORE', (select count(*) from customer where c_mktsegment <> 'HOUSEHOLD')"""


@query("history_all", _HISTORY_SQL)
def history_all(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir)
    ds.restore(0)
    return _history_with_rows(ds)


@query("history_last_n", f"select * from ({_HISTORY_SQL}) where version >= 3")
def history_last_n(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir)
    ds.restore(0)
    return _history_with_rows(ds, limit=2)


@query(
    "version_diff",
    """select c_custkey, 'removed' as change from customer where c_mktsegment = 'MACHINERY'
    union all select c_custkey, 'changed' as change from customer where c_acctbal < 0 and c_mktsegment <> 'MACHINERY'""",
)
def version_diff(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir)
    return ds.diff(1, 3, ["c_custkey"])  # reads only the files versions 1 and 3 do not share


@query(
    "version_diff_schemas",
    """select c_custkey, 'changed' as change, case when c_acctbal < 0 then 'c_acctbal,rich' else 'rich' end as columns from customer
    where c_mktsegment <> 'MACHINERY'
    union all select c_custkey, 'removed', null from customer where c_mktsegment = 'MACHINERY'""",
)
def version_diff_schemas(spark, sf_dir):
    """A version replaced by one with a column more: rows that gained a value have changed, and in which columns."""
    c = table(spark, sf_dir, "customer")
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "schemas"), c)
    balance = F.when(F.col("c_acctbal") < 0, F.lit(0.0)).otherwise(F.col("c_acctbal"))
    new = c.where("c_mktsegment <> 'MACHINERY'").withColumn("rich", F.col("c_acctbal") > 5000).withColumn("c_acctbal", balance)
    VersionedDataset.from_dataframe(spark, ds.root, new, replace_existing=True)
    found = ds.diff(0, 1, ["c_custkey"], columns=True)
    return found.select("c_custkey", "change", F.array_join("changed_columns", ",").alias("columns"))


@query(
    "commit_metrics",
    """select 0 as version, 'rows_inserted' as metric, count(*) as rows from customer where c_mktsegment <> 'HOUSEHOLD'
    union all select 1, 'rows_inserted', count(*) from customer where c_mktsegment = 'HOUSEHOLD'
    union all select 2, 'rows_updated', count(*) from customer where c_acctbal < 0
    union all select 3, 'rows_deleted', count(*) from customer where c_mktsegment = 'MACHINERY'""",
)
def commit_metrics(spark, sf_dir):
    """What each commit did to rows, from the history alone (rows that were only carried over depend on the files)."""
    h = _customer_chain(spark, sf_dir).history().select("version", F.explode("metrics").alias("metric", "rows"))
    return h.where("metric <> 'rows_kept'")


_LATER = "when c_mktsegment = 'MACHINERY' then 3 end as bigint"


@query(
    "validity_intervals",
    f"""with c as (select *, cast(case when c_mktsegment = 'HOUSEHOLD' then 1 else 0 end as bigint) as born from customer)
    select c_custkey, c_acctbal, c_mktsegment, cast(1 as bigint) as copies, born as valid_from,
      cast(case when c_acctbal < 0 then 2 {_LATER}) as valid_to from c
    union all select c_custkey, 0.0, c_mktsegment, cast(1 as bigint), cast(2 as bigint), cast(case {_LATER}) from c where c_acctbal < 0""",
)
def validity_intervals(spark, sf_dir):
    found = intervals.validity_intervals(_customer_chain(spark, sf_dir, change_feed=True))
    return found.select("c_custkey", "c_acctbal", "c_mktsegment", "copies", "valid_from", "valid_to")


# ----------------------------------------------------------- change feed

_CHANGES_SQL = f"""select {CUST_COLS}, 'insert' as _change_type, cast(0 as bigint) as _commit_version
      from customer where c_mktsegment <> 'HOUSEHOLD'
    union all select {CUST_COLS}, 'insert', cast(1 as bigint) from customer where c_mktsegment = 'HOUSEHOLD'
    union all select {CUST_COLS}, 'update_preimage', cast(2 as bigint) from customer where c_acctbal < 0
    union all select c_custkey, c_name, c_nationkey, 0.0, c_mktsegment, 'update_postimage', cast(2 as bigint)
      from customer where c_acctbal < 0
    union all select *, 'delete', cast(3 as bigint) from {_S2} where c_mktsegment = 'MACHINERY'"""


@query("changes_by_version", _CHANGES_SQL)
def changes_by_version(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir, change_feed=True)
    return ds.changes(0, 10).drop("_commit_timestamp")  # end beyond latest clamps


@query("changes_by_timestamp", f"select * from ({_CHANGES_SQL}) where _commit_version between 1 and 2")
def changes_by_timestamp(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir, change_feed=True)
    # the times as history shows them: text in the session's zone
    shown = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("at")
    ts = {r.version: r.at for r in ds.history().select("version", shown).collect()}
    return ds.changes_between_timestamps(ts[1], ts[2]).drop("_commit_timestamp")


@query(
    "changes_across_replace",
    """select s_suppkey as k, s_name as name, cast(null as integer) as nation, 'insert' as _change_type, cast(0 as bigint) as _commit_version from supplier
    union all select s_suppkey, s_name, null, 'delete', 1 from supplier
    union all select c_custkey, c_name, c_nationkey, 'insert', 1 from customer
    union all select c_custkey, c_name, c_nationkey, 'delete', 2 from customer
    union all select s_suppkey, s_name, null, 'insert', 2 from supplier""",
)
def changes_across_replace(spark, sf_dir):
    """Replace with data and another schema in one commit, then restore the first version."""
    root = scratch_dir(spark, "replaced")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as k", "s_name as name")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_name as name", "c_nationkey as nation")
    VersionedDataset.from_dataframe(spark, root, suppliers, properties=CDF)
    ds = VersionedDataset.from_dataframe(spark, root, customers, properties=CDF, replace_existing=True)
    ds.restore(0)
    return ds.changes(0).select("k", "name", "nation", "_change_type", "_commit_version")


@query(
    "audit_trail",
    f"select c_custkey, _commit_version, _change_type, c_acctbal from ({_CHANGES_SQL}) order by c_custkey, _commit_version desc",
)
def audit_trail(spark, sf_dir):
    ds = _customer_chain(spark, sf_dir, change_feed=True)
    return (
        ds.changes(0).select("c_custkey", "_commit_version", "_change_type", "c_acctbal")
        .orderBy("c_custkey", F.desc("_commit_version"))
    )


# --------------------------------------------------- creation and writes (B)

@query(
    "create_empty",
    "select 0 as version, cast(0 as bigint) as num_rows union all select 1, count(*) from customer",
)
def create_empty(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    ds = VersionedDataset.create(spark, scratch_dir(spark, "empty"), c.schema)  # version 0, no rows
    view = f"customer_src_{abs(hash(ds.root)) % 10**8}"
    c.createOrReplaceTempView(view)
    ds.append(spark.sql(f"SELECT * FROM {view}"), by_position=True)  # INSERT INTO t SELECT * FROM v
    return _history_with_rows(ds).select("version", "num_rows")


@query("create_or_replace", "select * from customer")
def create_or_replace(spark, sf_dir):
    root = scratch_dir(spark, "cor")
    VersionedDataset.from_dataframe(spark, root, table(spark, sf_dir, "supplier"))
    customer = table(spark, sf_dir, "customer")
    ds = VersionedDataset.create(spark, root, customer.schema, mode="create_or_replace")  # new schema, no rows
    ds.append(customer)
    return ds.to_df()


@query("create_if_not_exists", "select * from part")
def create_if_not_exists(spark, sf_dir):
    root = scratch_dir(spark, "cine")
    VersionedDataset.from_dataframe(spark, root, table(spark, sf_dir, "part"))
    ds = VersionedDataset.create(spark, root, table(spark, sf_dir, "customer").schema, mode="create_if_not_exists")
    return ds.to_df()


@query(
    "insert_values",
    """select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
    union all select * from (values (-1::bigint, 'ATLANTIS', 5, 1.5::double), (-2, 'LEMURIA', 6, 2.5)) v(s_suppkey, s_name, s_nationkey, s_acctbal)""",
)
def insert_values(spark, sf_dir):
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "supplier"), table(spark, sf_dir, "supplier"))
    ds.insert_values([(-1, "ATLANTIS", 5, 1.5), (-2, "LEMURIA", 6, 2.5)])
    return ds.to_df()


@query("insert_select", "select c_custkey as key, c_name as name, c_nationkey as nation from customer")
def insert_select(spark, sf_dir):
    ds = VersionedDataset.create(spark, scratch_dir(spark, "names"), "key BIGINT, name STRING, nation INT")
    view = f"customer_src_{abs(hash(ds.root)) % 10**8}"
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey").createOrReplaceTempView(view)
    ds.append(spark.sql(f"SELECT * FROM {view}"), by_position=True)
    return ds.to_df()


@query("overwrite_snapshot", f"select {ORDERS_COLS} from orders where o_orderstatus = 'F'")
def overwrite_snapshot(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "orders"), o)
    ds.overwrite(o.where("o_orderstatus = 'F'"))
    return ds.to_df()


@query(
    "insert_overwrite",
    "select o_orderkey as k, o_totalprice as price from orders where o_orderpriority = '1-URGENT'",
)
def insert_overwrite(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ds = VersionedDataset.from_dataframe(
        spark, scratch_dir(spark, "prices"), o.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"))
    )
    # INSERT OVERWRITE t SELECT ...: bound by position, names of the query ignored
    ds.overwrite(o.where("o_orderpriority = '1-URGENT'").select("o_orderkey", "o_totalprice"), by_position=True)
    return ds.to_df()


@query("self_overwrite", f"select {ORDERS_COLS} from orders where o_orderstatus <> 'P'")
def self_overwrite(spark, sf_dir):
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "orders"), table(spark, sf_dir, "orders"))
    ds.overwrite(ds.to_df().where(F.col("o_orderstatus") != "P"))  # reads v0, writes v1: no data loss
    return ds.to_df()


@query("adopt_parquet", f"select {ORDERS_COLS} from orders where o_orderstatus <> 'F'")
def adopt_parquet(spark, sf_dir):
    src = f"{sf_dir.rstrip('/')}/orders.parquet"
    ds = VersionedDataset.adopt_parquet(spark, scratch_dir(spark, "adopted"), src)  # no copy
    ds.delete("o_orderstatus = 'F'")  # rewrites into the dataset's own folder; the source stays as it is
    return ds.to_df()


@query("adopt_partitioned_delete", f"select {ORDERS_COLS} from orders where o_orderkey % 5 <> 0")
def adopt_partitioned_delete(spark, sf_dir):
    """An adopted folder keeps its partition column through a row change."""
    src = scratch_dir(spark, "hive")
    table(spark, sf_dir, "orders").write.partitionBy("o_orderstatus").parquet(src)
    ds = VersionedDataset.adopt_parquet(spark, scratch_dir(spark, "adopted-hive"), src)
    ds.delete("o_orderkey % 5 = 0")
    return ds.to_df().select(*ORDERS_COLS.split(", "))


@query(
    "partitioned_update",
    f"""select {ORDERS_COLS.replace("o_orderpriority", "case when o_orderkey = 1 then 'X' else o_orderpriority end as o_orderpriority")},
    true as one_file_rewritten from orders""",
)
def partitioned_update(spark, sf_dir):
    """A one-row update of a partitioned dataset rewrites the one file that holds it."""
    ds = VersionedDataset.from_dataframe(
        spark, scratch_dir(spark, "by-status"), table(spark, sf_dir, "orders"), partition_by=["o_orderstatus"]
    )
    before = layout.version_files(ds)
    ds.update({"o_orderpriority": "'X'"}, "o_orderkey = 1")
    gone = before.join(layout.version_files(ds), "file_path", "left_anti")
    one = gone.agg((F.count(F.lit(1)) == 1).alias("one_file_rewritten"))
    return ds.to_df().select(*ORDERS_COLS.split(", ")).crossJoin(one)  # one row beside the table


@query("path_overwrite_trace", """select 0 as version, count(*) as n from customer where c_nationkey < 12
    union all select 1, count(*) from customer union all select 2, count(*) from customer where c_mktsegment <> 'MACHINERY'""")
def path_overwrite_trace(spark, sf_dir):
    """Overwrite-save by path creates version 0; a merge and a self-overwrite follow."""
    c, root = table(spark, sf_dir, "customer"), scratch_dir(spark, "by-path")
    ds = VersionedDataset.save(spark, root, c.where("c_nationkey < 12"), mode="overwrite")
    ds.merge(c, ["c_custkey"]).when_matched_update_all().when_not_matched_insert_all().execute()
    VersionedDataset.save(spark, root, ds.to_df().where("c_mktsegment <> 'MACHINERY'"), mode="overwrite")
    return _history_with_rows(VersionedDataset.for_path(spark, root)).select("version", F.col("num_rows").alias("n"))


@query("replace_with_data", """select 0 as version, count(*) as n from customer union all select 1, count(*) from orders""")
def replace_with_data(spark, sf_dir):
    """CREATE OR REPLACE TABLE ... AS SELECT: one commit, no empty version between."""
    root = scratch_dir(spark, "ctas")
    for name in ("customer", "orders"):
        ds = VersionedDataset.from_dataframe(spark, root, table(spark, sf_dir, name), replace_existing=True)
    return _history_with_rows(ds).select("version", F.col("num_rows").alias("n"))


@query("catalog_names", """select 'saved' as step, count(*) as n from orders where o_orderstatus = 'F'
    union all select 'appended', count(*) from orders where o_orderstatus in ('F', 'O')
    union all select 'cloned', count(*) from orders where o_orderstatus in ('F', 'O')
    union all select 'first', count(*) from orders where o_orderstatus = 'F' union all select 'dropped', 0""")
def catalog_names(spark, sf_dir):
    """Save, append, clone and drop by name; a dropped name is unknown, its clone is not."""
    o, cat = table(spark, sf_dir, "orders"), Catalog(spark, scratch_dir(spark, "names"))
    cat.save_as("orders", o.where("o_orderstatus = 'F'"))
    saved = cat.table("orders")
    cat.save_as("orders", o.where("o_orderstatus = 'O'"), mode="append")
    appended = cat.table("orders")
    cat.clone("orders", "orders_copy", shallow=False)
    cat.clone("orders", "orders_first", version=0)
    cat.drop("orders")
    try:
        cat.for_name("orders")
        gone = False
    except VersionError:
        gone = True
    steps = {"saved": saved, "appended": appended, "cloned": cat.table("orders_copy"), "first": cat.table("orders_first")}
    out = None
    for step, df in steps.items():
        one = df.agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.union(one)
    return out.union(o.where(F.lit(not gone)).agg(F.lit("dropped").alias("step"), F.count(F.lit(1)).alias("n")))


@query("builder_modes", """select p_size as k, p_size + 1 as g, p_name as name, true as guarded from part""")
def builder_modes(spark, sf_dir):
    """Column by column: types, nullability, a generated column, partitions; create fails where one exists."""
    root = scratch_dir(spark, "built")
    build = lambda mode: (
        DatasetBuilder(spark, mode).location(root).add_column("k", IntegerType(), nullable=False)
        .add_column("g", "INT", generated_always_as="k + 1").add_columns(StructType([StructField("name", StringType())]))
        .partitioned_by("k").property("enableChangeDataFeed", "true")
    )
    build("create").execute()
    try:
        build("create").execute()
        guarded = False
    except VersionError:
        guarded = True
    ds = build("replace").execute()
    ds.append(table(spark, sf_dir, "part").selectExpr("p_size as k", "p_name as name"))
    return ds.to_df().withColumn("guarded", F.lit(guarded)).select("k", "g", "name", "guarded")


@query("merge_ambiguous", "select count(*) as rows, true as refused, 0 as version from supplier")
def merge_ambiguous(spark, sf_dir):
    """Two source rows for one target row: the merge is refused and commits nothing."""
    s = table(spark, sf_dir, "supplier")
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "ambiguous"), s)
    try:
        ds.merge(s.union(s), ["s_suppkey"]).when_matched_update({"s_acctbal": "0.0"}).execute()
        refused = False
    except AmbiguousMergeError:
        refused = True
    return ds.to_df().agg(F.count(F.lit(1)).alias("rows"), F.lit(refused).alias("refused"), F.lit(ds.latest_version()).alias("version"))


_GEN_SQL = """select o_orderkey, o_orderdate, cast(year(o_orderdate) as integer) as o_year,
    cast(year(o_orderdate) + 1 as integer) as g from orders"""


def _orders_by_year(spark, sf_dir) -> VersionedDataset:
    ds = VersionedDataset.create(
        spark, scratch_dir(spark, "orders-by-year"),
        "o_orderkey BIGINT NOT NULL, o_orderdate TIMESTAMP_NTZ, o_year INT, g INT",
        partition_by=["o_year"], generated={"o_year": "year(o_orderdate)", "g": "year(o_orderdate) + 1"},
    )
    ds.append(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    return ds


@query("generated_column", _GEN_SQL)
def generated_column(spark, sf_dir):
    return _orders_by_year(spark, sf_dir).to_df()


@query("partition_pruned_scan", f"select * from ({_GEN_SQL}) where o_year = 1997")
def partition_pruned_scan(spark, sf_dir):
    return _orders_by_year(spark, sf_dir).to_df().where(F.col("o_year") == 1997)  # PartitionFilters, one folder read


@query(
    "not_null_guard",
    "select count(*) as rows, true as rejected, 1 as version from part where p_partkey % 7 <> 0",
)
def not_null_guard(spark, sf_dir):
    """An append with a NULL in a NOT NULL column fails and commits nothing; one without is kept."""
    p = table(spark, sf_dir, "part").select("p_partkey", nk("p_size", "p_partkey", 7).alias("p_size"))
    ds = VersionedDataset.create(spark, scratch_dir(spark, "guarded"), "p_partkey BIGINT, p_size INT NOT NULL")
    ds.append(p.where("p_size is not null"))
    try:
        ds.append(p)
        rejected = False
    except Exception as e:  # the write job's own error, raised by the guard
        if "NOT NULL violated by column p_size" not in str(e):
            raise
        rejected = True
    return ds.to_df().agg(
        F.count(F.lit(1)).alias("rows"), F.lit(rejected).alias("rejected"), F.lit(ds.latest_version()).alias("version")
    )


# ----------------------------------------------------------------- clones

def _clone(spark, sf_dir, shallow: bool):
    """The clone's rows, and whether it shares files with its source."""
    src = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "supplier"), table(spark, sf_dir, "supplier"))
    copy = src.clone(scratch_dir(spark, "supplier-clone"), shallow=shallow)
    both = layout.version_files(src).join(layout.version_files(copy), "file_path")
    shared = both.agg((F.count(F.lit(1)) > 0).alias("shares_files"))
    return copy.to_df().crossJoin(shared)  # one row beside the table


@query("clone_shallow", "select *, true as shares_files from supplier")
def clone_shallow(spark, sf_dir):
    return _clone(spark, sf_dir, True)


@query("clone_deep", "select *, false as shares_files from supplier")
def clone_deep(spark, sf_dir):
    return _clone(spark, sf_dir, False)


@query(
    "clone_diverge",
    """select *, 'source' as side from supplier
    union all select s_suppkey, s_name, s_nationkey, case when s_acctbal < 0 then 0.0 else s_acctbal end, 'clone'
      from supplier where s_nationkey >= 5""",
)
def clone_diverge(spark, sf_dir):
    src = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "supplier"), table(spark, sf_dir, "supplier"))
    cl = src.clone(scratch_dir(spark, "supplier-clone"), shallow=True)
    cl.delete("s_nationkey < 5")
    cl.update({"s_acctbal": "0.0"}, "s_acctbal < 0")
    return src.to_df().withColumn("side", F.lit("source")).unionByName(cl.to_df().withColumn("side", F.lit("clone")))
