"""Aggregates kept fresh from the change feed (M4), batch or streaming.

Counts (``create_count``, ``apply_changes``) and, below, statistics that can retract: rows, non-null values, sum, mean,
min and max per key (``KeyStats``).

A per-key row count is stored as its own versioned dataset. Change rows become
signed deltas (insert / update_postimage +1, delete / update_preimage -1),
summed per key (partial aggregation before the shuffle), merged into the
aggregate (matched: n + d, not matched: insert d); keys whose count drops to 0
are hidden on read. Only the changed keys are touched: the base table is not
re-read.

Exactly once: every merge commit of the aggregate records the last source
version it covers (``sourceVersion``); a replayed batch whose versions are
already covered is skipped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DecimalType, FractionalType, NumericType

from lakeops.plans.versioned import VersionedDataset
from lakeops.session import scratch_dir

# Sign of each change type in a count.
SIGN = {"insert": 1, "update_postimage": 1, "delete": -1, "update_preimage": -1}


def signed_deltas(changes: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    sign = F.lit(0)
    for t, s in SIGN.items():
        sign = F.when(F.col("_change_type") == t, F.lit(s)).otherwise(sign)
    return (
        changes.select(*keys, sign.alias("__d"))
        .groupBy(*keys).agg(F.sum("__d").cast("bigint").alias(count_col))
        .where(F.col(count_col) != 0)
    )


def create_count(spark, root: str, source: DataFrame, keys: Sequence[str], source_version: int,
                 count_col: str = "n") -> VersionedDataset:
    """Full computation once: the aggregate's version 0 covers ``source_version``."""
    agg = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return VersionedDataset.from_dataframe(spark, root, agg, properties={"sourceVersion": str(source_version)})


def covered_version(agg: VersionedDataset) -> int:
    return int(agg.latest().properties.get("sourceVersion", "-1"))


def apply_changes(agg: VersionedDataset, changes: DataFrame, keys: Sequence[str], up_to_version: int,
                  count_col: str = "n") -> bool:
    """Fold change rows of source versions (covered_version, up_to_version] into ``agg``.

    One commit: the merged counts and the new ``sourceVersion`` land together, so
    a crash never leaves counts applied but unrecorded. Returns False (and does
    nothing) when those versions were applied already.
    """
    done = covered_version(agg)
    if up_to_version <= done:
        return False
    fresh = changes.where((F.col("_commit_version") > done) & (F.col("_commit_version") <= up_to_version))
    deltas = signed_deltas(fresh, keys, count_col)
    # A file-level merge: only files that hold changed keys are rewritten. NULL keys match.
    (
        agg.merge(deltas, list(keys), null_safe=True)
        .when_matched_update({count_col: f"t.`{count_col}` + s.`{count_col}`"})
        .when_not_matched_insert_all()
        .execute(properties={"sourceVersion": str(up_to_version)})
    )
    return True


def current_counts(agg: VersionedDataset, count_col: str = "n") -> DataFrame:
    """The aggregate as of its last commit; keys whose count fell to 0 are left out
    (they stay stored as zeros)."""
    return agg.to_df().where(F.col(count_col) != 0)


# ------------------------------------------------------- statistics that can retract

VALUE, COPIES = "__value", "copies"


def _exact(value: Column, df: DataFrame, scale: int) -> Column:
    """The value as a decimal, so sums taken up and taken back stay exact."""
    kind = df.select(value.alias("v")).schema["v"].dataType
    if not isinstance(kind, NumericType):
        raise ValueError("statistics need a numeric value")
    if isinstance(kind, DecimalType):
        return value.cast(DecimalType(38, kind.scale))
    return value.cast(DecimalType(38, scale if isinstance(kind, FractionalType) else 0))


def _totals(value_copies: DataFrame, keys: Sequence[str], copies: str) -> DataFrame:
    """Per key: rows, non-null values and their sum, from values and their (signed) numbers of copies."""
    n = F.col(copies)
    some = F.col(VALUE).isNotNull()
    kind = value_copies.schema[VALUE].dataType
    return value_copies.groupBy(*keys).agg(
        F.sum(n).alias("n_rows"), F.coalesce(F.sum(F.when(some, n)), F.lit(0)).cast("long").alias("n_values"),
        F.coalesce(F.sum(F.when(some, F.col(VALUE) * n)), F.lit(0)).cast(kind).alias("total"),
        F.min(F.when(n > 0, F.col(VALUE))).alias("least"), F.max(F.when(n > 0, F.col(VALUE))).alias("most"),
        F.min(F.when(n < 0, F.col(VALUE))).alias("least_gone"), F.max(F.when(n < 0, F.col(VALUE))).alias("most_gone"),
    )


class KeyStats:
    """Rows, non-null values, sum, mean, min and max of one column per key, kept from change rows.

    Two versioned datasets under ``root``: ``values`` holds each key's distinct values with their number of copies, ``stats`` the
    statistics. A batch of changes becomes signed copies per (key, value), summed before the shuffle. Sums and counts follow from
    these alone; so do a smaller minimum or a larger maximum. Only where a deleted value reaches the stored extreme are a key's
    extremes taken anew, from ``values``, never from the base table. Either dataset records the source version it covers in
    the commit that applies it, so a repeated batch changes nothing and a crash between the two commits is caught up by the next batch.

    NULL keys are a key; NULL values count as rows only. Sums are decimals (fractional columns are rounded to ``scale``
    digits first). A hot key is many (key, value) rows, so no task gets it whole.
    """

    def __init__(self, values: VersionedDataset, stats: VersionedDataset, keys: Sequence[str], value: str, scale: int = 6):
        self.values, self.stats, self.keys, self.value, self.scale = values, stats, list(keys), value, scale

    @classmethod
    def create(cls, spark, root: str, source: DataFrame, keys: Sequence[str], value: str, source_version: int,
               scale: int = 6) -> "KeyStats":
        """Full computation once, as of ``source_version``."""
        props, keys = {"sourceVersion": str(source_version)}, list(keys)
        exact = _exact(F.col(f"`{value}`"), source, scale)
        counted = source.select(*keys, exact.alias(VALUE)).groupBy(*keys, VALUE).agg(F.count(F.lit(1)).alias(COPIES))
        values = VersionedDataset.from_dataframe(spark, f"{root}/values", counted, properties=props)
        stats = _totals(values.to_df(), keys, COPIES).drop("least_gone", "most_gone")
        return cls(values, VersionedDataset.from_dataframe(spark, f"{root}/stats", stats, properties=props), keys, value, scale)

    def apply(self, changes: DataFrame, up_to_version: int) -> bool:
        """Fold change rows of source versions up to ``up_to_version`` in. ``changes`` must hold all of
        those after ``covered``; ones applied before are left out. False if there was nothing to do."""
        done = self.covered()
        if up_to_version <= done:
            return False
        spark, keys = self.stats.spark, self.keys
        sign = F.lit(0)
        for t, s in SIGN.items():
            sign = F.when(F.col("_change_type") == t, F.lit(s)).otherwise(sign)
        fresh = changes.where((F.col("_commit_version") > done) & (F.col("_commit_version") <= up_to_version))
        exact = _exact(F.col(f"`{self.value}`"), changes, self.scale)
        deltas = fresh.select(*keys, exact.alias(VALUE), sign.alias("d"), F.col("_commit_version").alias("v")).groupBy(*keys, VALUE, "v").agg(
            F.sum("d").alias("d")
        )
        path = scratch_dir(spark, "stat-deltas")
        deltas.write.parquet(path)  # one form of the batch for both datasets
        props = {"sourceVersion": str(up_to_version)}
        if covered_version(self.values) < up_to_version:
            new = spark.read.parquet(path).where(F.col("v") > covered_version(self.values))
            net = new.groupBy(*keys, VALUE).agg(F.sum("d").alias(COPIES)).where(F.col(COPIES) != 0)
            (
                self.values.merge(net, [*keys, VALUE], null_safe=True)
                .when_matched_update({COPIES: f"t.`{COPIES}` + s.`{COPIES}`"}).when_not_matched_insert_all().execute(properties=props)
            )
        new = spark.read.parquet(path).where(F.col("v") > covered_version(self.stats))
        net = _totals(new.groupBy(*keys, VALUE).agg(F.sum("d").alias("d")).where(F.col("d") != 0), keys, "d")
        # of each changed key: the stored extremes, and whether a value that left reaches one
        held = self.stats.to_df().select(*[F.col(k).alias(f"t_{k}") for k in keys], F.col("least").alias("t_least"), F.col("most").alias("t_most"))
        net = net.join(held, self._same("", "t_"), "left").drop(*[f"t_{k}" for k in keys])
        lost = (F.col("least_gone") <= F.col("t_least")) | (F.col("most_gone") >= F.col("t_most"))
        net = net.withColumn("lost", F.coalesce(lost, F.lit(False)))
        again = net.where("lost").select(*[F.col(k).alias(f"a_{k}") for k in keys])
        left = self.values.to_df().where(F.col(COPIES) > 0).join(again, self._same("", "a_"), "left_semi")
        found = left.groupBy(*[F.col(k).alias(f"f_{k}") for k in keys]).agg(F.min(VALUE).alias("f_least"), F.max(VALUE).alias("f_most"))
        source = net.join(found, self._same("", "f_"), "left").select(
            *keys, "n_rows", "n_values", "total",
            *[F.when(F.col("lost"), F.col(f"f_{c}")).otherwise(pick(F.col(c), F.col(f"t_{c}"))).alias(c)
              for c, pick in (("least", F.least), ("most", F.greatest))],
        )
        sums = {c: f"t.`{c}` + s.`{c}`" for c in ("n_rows", "n_values", "total")}
        (
            self.stats.merge(source, keys, null_safe=True)
            .when_matched_update({**sums, "least": "s.least", "most": "s.most"}).when_not_matched_insert_all().execute(properties=props)
        )
        return True

    def _same(self, a: str, b: str) -> Column:
        out = F.lit(True)
        for k in self.keys:
            out = out & F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}"))
        return out

    def covered(self) -> int:
        """The last source version both datasets cover."""
        return min(covered_version(self.values), covered_version(self.stats))

    def current(self) -> DataFrame:
        """keys, n_rows, n_values, total, mean, least, most of the keys that have rows."""
        mean = F.when(F.col("n_values") > 0, F.col("total").cast("double") / F.col("n_values"))
        return self.stats.to_df().where(F.col("n_rows") > 0).select(
            *self.keys, "n_rows", "n_values", F.when(F.col("n_values") > 0, F.col("total")).alias("total"), mean.alias("mean"), "least", "most"
        )
