"""Registered queries: compaction, clustering, file statistics and skipping (K, A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import clustering, file_index, layout
from lakeops.plans.registry import query, table
from lakeops.plans.versioned import VersionedDataset
from lakeops.session import scratch_dir

LOOKUP_KEY = 100


def _lineitem_appends(spark, sf_dir) -> VersionedDataset:
    """lineitem as several appends (one per return flag): many small files, as after a
    stream of inserts."""
    li = table(spark, sf_dir, "lineitem")
    ds = VersionedDataset.create(spark, scratch_dir(spark, "lineitem"), li.schema)
    for flag in ("A", "N", "R"):
        ds.append(li.where(F.col("l_returnflag") == flag))
    ds.append(li.where(~F.col("l_returnflag").isin("A", "N", "R")))
    return ds


def _target_bytes(ds: VersionedDataset) -> int:
    """File size to write: the usual one, or less where the table is too small to give several files."""
    total = layout.dataset_file_sizes(ds).agg(F.sum("file_size")).first()[0]
    return max(1, min(layout.TARGET_FILE_BYTES, total // 8))


def _clustered(spark, sf_dir, *columns) -> VersionedDataset:
    ds = _lineitem_appends(spark, sf_dir)
    layout.cluster_by(ds, list(columns), target_file_bytes=_target_bytes(ds))
    return ds


def _few_files_hold(ds: VersionedDataset, column: str):
    """One row: whether a part of the files' value ranges only holds the lookup key."""
    stats = layout.dataset_file_stats(ds, [column])
    holds = F.lit(LOOKUP_KEY).between(F.col(f"{column}__min"), F.col(f"{column}__max"))
    return stats.agg((F.count_if(holds) < F.count(F.lit(1))).alias(f"narrow_{column}"))


@query("compact", "select *, true as fewer_files from lineitem")
def compact(spark, sf_dir):
    ds = _lineitem_appends(spark, sf_dir)
    layout.compact(ds)
    n = lambda v: layout.version_files(ds, v).agg(F.count(F.lit(1)).alias(f"n{v}"))
    last = ds.latest_version()
    fewer = n(last - 1).crossJoin(n(last)).select((F.col(f"n{last}") < F.col(f"n{last - 1}")).alias("fewer_files"))
    return ds.to_df().crossJoin(fewer)  # one row beside the table


@query("cluster_by_column", "select *, true as narrow_l_partkey from lineitem")
def cluster_by_column(spark, sf_dir):
    ds = _clustered(spark, sf_dir, "l_partkey")
    return ds.to_df().crossJoin(_few_files_hold(ds, "l_partkey"))  # one row beside the table


@query("cluster_by_columns", "select *, true as narrow_l_partkey from lineitem")
def cluster_by_columns(spark, sf_dir):
    ds = _clustered(spark, sf_dir, "l_partkey", "l_suppkey")
    return ds.to_df().crossJoin(_few_files_hold(ds, "l_partkey"))


@query("point_lookup", f"select * from lineitem where l_partkey = {LOOKUP_KEY}")
def point_lookup(spark, sf_dir):
    return layout.point_lookup(_clustered(spark, sf_dir, "l_partkey"), "l_partkey", LOOKUP_KEY)


@query("point_lookup_nan", f"""select l_orderkey, case when l_linenumber = 3 then 'nan' else cast(l_partkey as varchar) end as v
    from lineitem where l_partkey = {LOOKUP_KEY} and l_linenumber <> 3""")
def point_lookup_nan(spark, sf_dir):
    """Files that hold NaN beside the value are not skipped."""
    value = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_partkey").cast("double"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", value.alias("v"))
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "nan"), li.repartition(8, "l_orderkey"))
    layout.write_file_stats(ds, ["v"], 0)
    found = layout.point_lookup(ds, "v", float(LOOKUP_KEY))
    return found.select("l_orderkey", F.col("v").cast("bigint").cast("string").alias("v"))


@query(
    "partitioned_point_lookup",
    f"select l_orderkey, l_partkey, l_returnflag from lineitem where l_partkey = {LOOKUP_KEY}",
)
def partitioned_point_lookup(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "by-flag"), li, partition_by=["l_returnflag"])
    layout.write_file_stats(ds, ["l_partkey"], 0)
    return layout.point_lookup(ds, "l_partkey", LOOKUP_KEY)


@query("file_skipping", "select 'before' as layout, false as skips union all select 'after', true")
def file_skipping(spark, sf_dir):
    ds = _lineitem_appends(spark, sf_dir)
    layout.write_file_stats(ds, ["l_partkey"], ds.latest_version())
    out = None
    for name in ("before", "after"):
        if name == "after":
            layout.cluster_by(ds, ["l_partkey"], target_file_bytes=_target_bytes(ds))
        one = layout.skipping(ds, "l_partkey", LOOKUP_KEY, LOOKUP_KEY).agg(
            F.lit(name).alias("layout"), (~F.bool_and("hit")).alias("skips")
        )
        out = one if out is None else out.union(one)
    return out


@query(
    "file_inventory",
    "select count(*) as num_rows, true as all_sized, true as several_files from lineitem",
)
def file_inventory(spark, sf_dir):
    inv = layout.dataset_file_sizes(_lineitem_appends(spark, sf_dir))
    return inv.agg(
        F.sum("num_rows").alias("num_rows"), F.bool_and((F.col("file_size") > 0) & (F.col("num_rows") > 0)).alias("all_sized"),
        (F.countDistinct("file_path") >= 3).alias("several_files"),
    )


@query(
    "file_stats",
    """select l_returnflag, min(l_partkey) as min_partkey, max(l_partkey) as max_partkey, count(*) as num_rows
    from lineitem group by l_returnflag""",
)
def file_stats(spark, sf_dir):
    """Stats per file, summed up per return flag: each append wrote one flag."""
    stats = layout.dataset_file_stats(_lineitem_appends(spark, sf_dir), ["l_partkey", "l_returnflag"])
    same = F.when(F.col("l_returnflag__min") == F.col("l_returnflag__max"), F.col("l_returnflag__min"))
    return stats.groupBy(same.alias("l_returnflag")).agg(
        F.min("l_partkey__min").alias("min_partkey"), F.max("l_partkey__max").alias("max_partkey"),
        F.sum("num_rows").alias("num_rows"),
    )


@query("unreferenced_files", "select 0 as retain_from, 0 as files union all select 2, 1")
def unreferenced_files(spark, sf_dir):
    """With all versions retained every file is referred to; without the first ones, the file an update replaced is not."""
    s = table(spark, sf_dir, "supplier").coalesce(1)
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "vacuum"), s)
    ds.update({"s_acctbal": "0.0"}, "s_suppkey = 1")
    ds.append(s)
    out = None
    for v in (0, 2):
        files = layout.unreferenced_files(ds, v).where(F.col("path").endswith(".parquet"))
        one = files.agg(F.lit(v).alias("retain_from"), F.count(F.lit(1)).cast("int").alias("files"))
        out = one if out is None else out.union(one)
    return out


_CLERKS = """select o_orderkey, 'Clerk#' || o_custkey as clerk, 'Batch#' || (o_orderkey // 8) as batch from orders"""


@query(
    "lookup_two_columns",
    f"""with o as ({_CLERKS}), asked as (select clerk, batch from o order by o_orderkey limit 1)
    select o.*, true as fewer_than_clerk, true as fewer_than_batch from o semi join asked using (clerk, batch)""",
)
def lookup_two_columns(spark, sf_dir):
    """``clerk = a AND batch = b`` on unclustered text columns opens fewer files than either condition alone."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string")).alias("clerk"),
        F.concat(F.lit("Batch#"), F.expr("o_orderkey div 8").cast("string")).alias("batch"),
    )
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "clerks"), o.repartition(48, "o_orderkey"))
    file_index.build_index(ds, ["clerk", "batch"])
    asked = o.orderBy("o_orderkey").select("clerk", "batch").first().asDict()  # the values looked up
    opened = {
        name: file_index.files_to_read(ds, cond).agg(F.count_if("hit").alias(name))
        for name, cond in (("both", asked), ("clerk", {"clerk": asked["clerk"]}), ("batch", {"batch": asked["batch"]}))
    }
    counts = opened["both"].crossJoin(opened["clerk"]).crossJoin(opened["batch"])  # one row each
    fewer = counts.select((F.col("both") < F.col("clerk")).alias("fewer_than_clerk"), (F.col("both") < F.col("batch")).alias("fewer_than_batch"))
    return file_index.lookup(ds, asked).crossJoin(fewer)  # one row beside the rows found


@query("cluster_incremental", "select *, true as part_rewritten, true as narrow_l_partkey from lineitem")
def cluster_incremental(spark, sf_dir):
    """Cluster, append about one row in a hundred, cluster again: the second run rewrites a part of the files."""
    li = table(spark, sf_dir, "lineitem")
    small = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "A") & (F.col("l_quantity") > 40)
    ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "hilbert"), li.where(~small))
    target = _target_bytes(ds)
    clustering.cluster(ds, ["l_partkey", "l_suppkey"], target)
    ds.append(li.where(small))
    clustering.cluster(ds, target_file_bytes=target)
    done = {k: int(v) for k, v in ds.latest().parameters.items() if k.startswith("num")}
    part = 0 < done["numRemovedFiles"] == done["numYoungFiles"] < done["numFiles"]
    return ds.to_df().withColumn("part_rewritten", F.lit(part)).crossJoin(_few_files_hold(ds, "l_partkey"))  # one row beside the table
