"""Registered queries: scans, projections, filters, aggregates, sorts, union,
the imputation job (M1) and the layered CSV -> Parquet -> aggregate job (M3)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakeops.functions.columns import safe_cast
from lakeops.operators import clean
from lakeops.plans.registry import nk, nk_sql, query, table
from lakeops.session import scratch_dir
from lakeops.sources import files

# ---------------------------------------------------------------- M1 / D1 / E1

_PART_NULLED_SQL = f"""(select p_partkey, p_name, p_brand, {nk_sql('p_type', 'p_partkey', 11)} as p_type,
    {nk_sql('p_size', 'p_partkey', 7)} as p_size, p_retailprice from part)"""


def _part_nulled(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand",
        nk("p_type", "p_partkey", 11).alias("p_type"),
        nk("p_size", "p_partkey", 7).alias("p_size"),
        "p_retailprice",
    )


@query(
    "impute_group_mean",
    f"""with filled as (
      select p_partkey, p_name, p_brand, p_type,
             case when p_type = 'PROMO' and p_size is null then 0 else p_size end as p_size, p_retailprice
      from {_PART_NULLED_SQL}),
    means as (select p_type, p_brand, avg(p_size) as m from filled group by p_type, p_brand)
    select f.p_partkey, f.p_name, f.p_brand, f.p_type, round(m.m, 6) as p_size, f.p_retailprice
      from filled f join means m on f.p_type = m.p_type and f.p_brand = m.p_brand and f.p_size is null
    union all
    select p_partkey, p_name, p_brand, p_type, cast(p_size as double) as p_size, p_retailprice
      from filled where p_size is not null""",
)
def impute_group_mean(spark: SparkSession, sf_dir: str):
    filled = clean.fill_where(_part_nulled(spark, sf_dir), "p_size", 0, when=F.col("p_type") == "PROMO")
    out = clean.impute_group_mean(filled, "p_size", ["p_type", "p_brand"])
    return out.withColumn("p_size", F.round("p_size", 6))


@query(
    "join_fact_aggregate",
    f"""with p as {_PART_NULLED_SQL},
    m as (select p_type, p_brand, avg(p_size) as mean_size from p group by p_type, p_brand)
    select p.p_partkey, p.p_type, p.p_brand, round(m.mean_size, 6) as mean_size
      from p join m on p.p_type = m.p_type and p.p_brand = m.p_brand and p.p_size is null""",
)
def join_fact_aggregate(spark, sf_dir):
    p = _part_nulled(spark, sf_dir)
    m = clean.group_means(p, ["p_type", "p_brand"], "p_size", "mean_size")
    j = p.alias("p").join(
        m.alias("m"),
        (F.col("p.p_type") == F.col("m.p_type")) & (F.col("p.p_brand") == F.col("m.p_brand")) & F.col("p.p_size").isNull(),
        "inner",
    )
    return j.select("p.p_partkey", "p.p_type", "p.p_brand", F.round("m.mean_size", 6).alias("mean_size"))


@query(
    "agg_mean_multikey",
    f"""select p_type, p_brand, p_size_mod3, round(avg(p_size), 6) as mean_size
    from (select p_type, p_brand, p_size % 3 as p_size_mod3, {nk_sql('p_size', 'p_partkey', 7)} as p_size from part)
    group by p_type, p_brand, p_size_mod3""",
)
def agg_mean_multikey(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        "p_type", "p_brand", (F.col("p_size") % 3).alias("p_size_mod3"), nk("p_size", "p_partkey", 7).alias("p_size")
    )
    return clean.group_means(p, ["p_type", "p_brand", "p_size_mod3"], "p_size", "mean_size").withColumn(
        "mean_size", F.round("mean_size", 6)
    )


@query(
    "agg_count_nonnull",
    f"""select p_type, count(p_name) as num_names
    from (select {nk_sql('p_type', 'p_partkey', 11)} as p_type, {nk_sql('p_name', 'p_partkey', 7)} as p_name from part)
    group by p_type""",
)
def agg_count_nonnull(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        nk("p_type", "p_partkey", 11).alias("p_type"), nk("p_name", "p_partkey", 7).alias("p_name")
    )
    return p.groupBy("p_type").agg(F.count("p_name").alias("num_names"))


@query("agg_max", "select c_mktsegment, max(c_acctbal) as max_acctbal from customer group by c_mktsegment")
def agg_max(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.max("c_acctbal").alias("max_acctbal"))


@query(
    "agg_mean_cast",
    """select c_mktsegment, round(avg(try_cast(cast(c_nationkey as varchar) as integer)), 6) as mean_nation
    from customer group by c_mktsegment""",
)
def agg_mean_cast(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_mktsegment", safe_cast(F.col("c_nationkey").cast("string"), "int").alias("nation_int")
    )
    return c.groupBy("c_mktsegment").agg(F.round(F.avg("nation_int"), 6).alias("mean_nation"))


@query(
    "safe_cast",
    """select p_partkey, try_cast(case when p_partkey % 9 = 0 then 'n/a' else cast(p_size as varchar) end as integer)
      as p_size_int from part""",
)
def safe_cast_q(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    txt = F.when(F.col("p_partkey") % 9 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    return p.select("p_partkey", safe_cast(txt, "int").alias("p_size_int"))


@query(
    "null_census",
    f"""select count(*) as rows, count(*) filter (where p_size is null) as value_null,
      count(*) filter (where p_type is null) as key_null,
      count(*) filter (where p_size is null and p_type is null) as value_and_key_null
    from (select {nk_sql('p_size', 'p_partkey', 7)} as p_size, {nk_sql('p_type', 'p_partkey', 11)} as p_type from part)""",
)
def null_census(spark, sf_dir):
    return clean.null_census(_part_nulled(spark, sf_dir), "p_size", ["p_type"])


@query(
    "conditional_fill",
    f"""select p_partkey, p_type, case when p_type = 'PROMO' and p_size is null then 0 else p_size end as p_size
    from (select p_partkey, p_type, {nk_sql('p_size', 'p_partkey', 7)} as p_size from part)""",
)
def conditional_fill(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type", nk("p_size", "p_partkey", 7).alias("p_size"))
    return clean.fill_where(p, "p_size", 0, when=F.col("p_type") == "PROMO")


@query("normalize_columns", "select * from customer")
def normalize_columns(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    shouting = c.toDF(*[n.upper().replace("_", " ") for n in c.columns])  # 'C CUSTKEY', ...
    return clean.normalize_columns(shouting)


# ---------------------------------------------------------------- C: filters

@query(
    "filter_project",
    """select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_orderpriority = '1-URGENT'""",
)
def filter_project(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    # Filter on columns the projection drops: filter first, then project; the
    # Parquet scan gets both predicates pushed and reads four columns.
    return o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "filter_not_equal",
    f"""select o_orderkey, o_orderstatus from (select o_orderkey, {nk_sql('o_orderstatus', 'o_orderkey', 13)} as o_orderstatus
    from orders) where o_orderstatus <> 'F'""",
)
def filter_not_equal(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", nk("o_orderstatus", "o_orderkey", 13).alias("o_orderstatus"))
    return o.where(F.col("o_orderstatus") != "F")  # NULL status rows drop (unlike DELETE)


# ---------------------------------------------------------------- F, G: sort, union

@query(
    "sort_limit",
    "select c_custkey, c_name, c_acctbal from customer order by c_acctbal asc nulls first, c_custkey limit 60",
)
def sort_limit(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name", "c_acctbal").orderBy(F.asc_nulls_first("c_acctbal"), "c_custkey").limit(60)


@query(
    "union_all",
    """select c_name as name, c_nationkey as nationkey from customer
    union all select s_name as name, s_nationkey as nationkey from supplier""",
)
def union_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s)


# ---------------------------------------------------------------- A1, A2, M3: CSV

@query(
    "csv_header_scan",
    """select cast(c_custkey as varchar) as c_custkey, c_name, cast(c_nationkey as varchar) as c_nationkey,
      cast(c_acctbal as double) as c_acctbal, true as all_text, c_mktsegment from customer""",
)
def csv_header_scan(spark, sf_dir):
    path = scratch_dir(spark, "csv-header")
    files.write_csv(table(spark, sf_dir, "customer"), path, header=True)
    rows = files.read_csv_header(spark, path)
    all_text = all(kind == "string" for _, kind in rows.dtypes)
    # every column arrives as text; the balance is compared as a number, whose text form differs by engine
    return rows.withColumn("c_acctbal", F.col("c_acctbal").try_cast("double")).withColumn("all_text", F.lit(all_text))


@query(
    "csv_positional_scan",
    """select cast(event_id as varchar) as event_key, event_type as kind, cast(user_id as varchar) as user_key
    from events""",
)
def csv_positional_scan(spark, sf_dir):
    path = scratch_dir(spark, "csv-positional")
    files.write_csv(table(spark, sf_dir, "events").select("event_id", "event_type", "user_id"), path, header=False)
    return files.read_csv_positional(spark, path, ["event_key", "kind", "user_key"])


@query(
    "layered_etl",
    """select c_mktsegment, count(*) as customers, round(avg(c_acctbal), 6) as mean_acctbal
    from customer group by c_mktsegment""",
)
def layered_etl(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    staging = scratch_dir(spark, "staging")
    raw = table(spark, sf_dir, "customer")
    files.write_csv(raw.toDF(*[c.replace("_", " ").title() for c in raw.columns]), landing, header=True)
    # landing (CSV, all text, display names) -> staging (typed Parquet) -> analytics
    typed = clean.normalize_columns(files.read_csv_header(spark, landing)).select(
        "c_custkey", "c_mktsegment", safe_cast("c_acctbal", "double").alias("c_acctbal")
    )
    files.write_parquet(typed, staging)
    return (
        spark.read.parquet(staging)
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("customers"), F.round(F.avg("c_acctbal"), 6).alias("mean_acctbal"))
    )


@query("ctas_parquet", "select * from lineitem")
def ctas_parquet(spark, sf_dir):
    path = scratch_dir(spark, "ctas")
    files.write_parquet(table(spark, sf_dir, "lineitem"), path)
    return spark.read.parquet(path)


@query(
    "parquet_append",
    """select c_custkey as k, c_name as name, c_nationkey as nation from customer
    union all select s_suppkey + 1000000, s_name, s_nationkey from supplier""",
)
def parquet_append(spark, sf_dir):
    path = scratch_dir(spark, "parquet-append")
    files.write_parquet(table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_name as name", "c_nationkey as nation"), path)
    extra = table(spark, sf_dir, "supplier").selectExpr("s_suppkey + 1000000 as k", "s_name as name", "s_nationkey as nation")
    files.write_parquet(extra, path, mode="append")
    return spark.read.parquet(path)
