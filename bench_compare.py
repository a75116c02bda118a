"""

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEATS (default 3, median after one discarded warm-up run). Prints one JSON line. The naive forms exist
only here, as the yardstick; they are not part of the library.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))

    from lakeops.operators import clean, layout, text
    from lakeops.plans import incremental
    from lakeops.plans.registry import nk, table
    from lakeops.plans.versioned import VersionedDataset
    from lakeops.session import get_session, scratch_dir

    spark = get_session(app="lakeops-compare", master=f"local[{cpus}]", shuffle_partitions=cpus * 2)

    def timed(fn) -> float:
        fn()  # warm-up run, discarded (code generation, class loading)
        ts = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        return round(statistics.median(ts), 3)

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    out: dict[str, dict] = {}
    docs = table(spark, sf_dir, "documents")
    stop = set(text.DEFAULT_STOP_WORDS)

    # 1. Top-100 words -------------------------------------------------------
    def naive_words():
        rdd = docs.select("text").rdd.flatMap(lambda r: re.split(r"[\r\n ]", r[0])).map(lambda w: w.lower())
        rdd = rdd.filter(lambda w: w not in stop and re.search(r"^[a-zA-Z]+$", w) is not None)
        counts = rdd.map(lambda w: (w, 1)).reduceByKey(lambda a, b: a + b)
        counts.takeOrdered(100, key=lambda kv: (-kv[1], kv[0]))

    def ours_words():
        text.word_top_k(docs, text.stop_words_frame(spark), 100, "text").collect()

    spark.range(1).collect()
    out["word_top100"] = {"naive_rdd_python": timed(naive_words), "ours": timed(ours_words)}

    # 2. Group-mean imputation ----------------------------------------------
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", nk("p_type", "p_partkey", 11).alias("p_type"), nk("p_size", "p_partkey", 7).alias("p_size")
    )
    keys = ["p_type", "p_brand"]

    def window_form():
        w = Window.partitionBy(*keys)
        m = F.avg(F.col("p_size").cast("double")).over(w)
        guard = F.col("p_size").isNotNull() | (F.col("p_type").isNotNull() & F.col("p_brand").isNotNull())
        sink(part.withColumn("p_size", F.coalesce(F.col("p_size").cast("double"), m)).where(guard))

    out["impute_group_mean"] = {
        "window_one_scan": timed(window_form),
        "ours_agg_join_union": timed(lambda: sink(clean.impute_group_mean(part, "p_size", keys))),
    }

    # 3. Merge of ~10 % of orders into a 16-file dataset ----------------------
    orders = table(spark, sf_dir, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    src = orders.where(F.col("o_orderkey") < top // 10).withColumn("o_orderpriority", F.lit("NEW"))

    def clustered_orders():
        ds = VersionedDataset.from_dataframe(spark, scratch_dir(spark, "cmp-orders"), orders)
        layout.cluster_by(ds, ["o_orderkey"], n_files=16)
        return ds

    def full_rewrite():
        ds = clustered_orders()
        t0 = time.perf_counter()
        cur = ds.to_df()
        merged = cur.join(src.select("o_orderkey", F.col("o_orderpriority").alias("__p")), "o_orderkey", "left").select(
            *[F.coalesce("__p", "o_orderpriority").alias(c) if c == "o_orderpriority" else F.col(c) for c in cur.columns]
        )
        ds.overwrite(merged)
        return time.perf_counter() - t0

    def file_level():
        ds = clustered_orders()
        t0 = time.perf_counter()
        ds.merge(src, ["o_orderkey"]).when_matched_update({"o_orderpriority": "s.o_orderpriority"}).execute()
        return time.perf_counter() - t0

    def med(fn):
        fn()  # warm-up run, discarded
        return round(statistics.median([fn() for _ in range(repeats)]), 3)

    ds_probe = clustered_orders()
    files_total = layout.version_files(ds_probe).count()
    ds_probe.merge(src, ["o_orderkey"]).when_matched_update({"o_orderpriority": "s.o_orderpriority"}).execute()
    out["merge_10pct_orders"] = {
        "full_snapshot_rewrite": med(full_rewrite),
        "ours_file_level_cow": med(file_level),
        "files_in_snapshot": files_total,
        "files_rewritten": len(ds_probe.latest().removed),
    }

    # 4. Point lookup: files to read ----------------------------------------
    li = table(spark, sf_dir, "lineitem")
    ds = VersionedDataset.create(spark, scratch_dir(spark, "cmp-lineitem"), li.schema)
    for flag in ("A", "N", "R"):
        ds.append(li.where(F.col("l_returnflag") == flag))
    total_before = layout.version_files(ds).count()
    t_before = timed(lambda: sink(ds.to_df().where("l_partkey = 1500")))
    layout.cluster_by(ds, ["l_partkey"], n_files=16)
    total_after, after = layout.version_files(ds).count(), layout.files_between(ds, "l_partkey", 1500, 1500)
    t_after = timed(lambda: sink(layout.point_lookup(ds, "l_partkey", 1500)))
    out["point_lookup_lineitem"] = {
        "files_to_read_unclustered": f"{total_before}/{total_before}",
        "files_to_read_clustered": f"{len(after)}/{total_after}",
        "sec_unclustered": t_before,
        "sec_clustered_skipping": t_after,
    }

    # 5. Per-customer counts after a commit ---------------------------------
    # The same commit on tables of 1 to 100 times the orders: the recompute reads the table,
    # the merge reads the change, so there is a size from which the merge is the cheaper one.
    out["per_customer_counts_after_commit"] = {}
    for times in (1, 20, 100):
        many = orders.select("o_custkey", "o_orderstatus").crossJoin(spark.range(times).select(F.col("id").alias("copy")))
        base = VersionedDataset.from_dataframe(
            spark, scratch_dir(spark, "cmp-inc"), many.where("o_orderstatus <> 'P'"), properties={"enableChangeDataFeed": "true"}
        )
        agg = incremental.create_count(spark, scratch_dir(spark, "cmp-agg"), base.to_df(0), ["o_custkey"], 0)
        base.append(many.where("o_orderstatus = 'P' and copy = 0"))

        def recompute():
            sink(base.to_df().groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))  # noqa: B023

        def from_changes_fresh():
            cl = agg.clone(scratch_dir(spark, "cmp-agg-c"), shallow=True)  # noqa: B023  same input for every repeat
            t0 = time.perf_counter()
            incremental.apply_changes(cl, base.changes(1), ["o_custkey"], up_to_version=1)  # noqa: B023
            sink(incremental.current_counts(cl))
            return time.perf_counter() - t0

        out["per_customer_counts_after_commit"][f"{times}x_orders"] = {
            "rows": base.to_df().count(), "full_recompute": timed(recompute), "ours_from_change_feed": med(from_changes_fresh),
        }

    print(json.dumps({"sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "repeats": repeats, "compare": out}))
    spark.stop()


if __name__ == "__main__":
    main()
