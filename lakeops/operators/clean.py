"""Cleaning operators: column-name normalisation, conditional fill, group-mean
imputation, safe casts and null census.

Null rules (they differ on purpose, matching the reference programs):
- ``impute_group_mean``: the value is filled from the mean of its group through
  an inner equi-join, so a row whose value is NULL *and* whose any key is NULL
  never matches and is dropped; a group whose values are all NULL has mean NULL,
  so its rows stay NULL.
- ``groupBy`` treats a NULL key as a group of its own (``agg_*``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.columns import as_column, normalized_name


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name and turn blanks into ``_`` in one projection.

    Raises when two names collide after normalisation (the reference's rename
    loop would silently produce duplicate columns).
    """
    new = [normalized_name(c) for c in df.columns]
    dupes = sorted({n for n in new if new.count(n) > 1})
    if dupes:
        raise ValueError(f"column names collide after normalising: {dupes}")
    return df.toDF(*new)


def fill_where(df: DataFrame, column: str, value, when: str | Column | None = None) -> DataFrame:
    """Replace NULLs of ``column`` by a constant, only on rows where ``when`` holds.

    The constant is cast to the column's type first so ANSI coercion never
    changes the column's type (``when(..., 0).otherwise(str_col)`` would).
    """
    dtype = df.schema[column].dataType
    cond = F.col(column).isNull()
    if when is not None:
        cond = cond & F.coalesce(as_column(when), F.lit(False))
    filled = F.when(cond, F.lit(value).cast(dtype)).otherwise(F.col(column))
    return df.withColumn(column, filled)


def group_means(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Mean of ``value`` per key combination (E1). NULL keys form their own group."""
    return df.groupBy(*keys).agg(F.avg(F.col(value).try_cast("double")).alias(alias))


def impute_group_mean(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Fill NULL ``value`` with the mean of its (keys) group — the reference job M1.

    Plan: partial+final aggregate over rows with non-NULL keys (NULL-key groups can
    never join, so they are dropped before the shuffle), an inner equi-join of the
    NULL-value rows only with that aggregate, and a UNION ALL with the untouched
    non-NULL rows (no shuffle on that branch).

    Why not ``avg().over(partitionBy(keys))``: a window puts each group in one
    task; one hot key holding a third of the rows would make one straggler task.
    The aggregate is pre-combined map-side, and the join side that can be skewed
    (NULL-value fact rows) is split by AQE's skew-join handling; when the
    aggregate is small AQE broadcasts it at runtime from measured size.

    The imputed column is DOUBLE (a mean), whatever the input type.
    """
    keys = list(keys)
    out_cols = df.columns
    v = F.col(value).try_cast("double")
    mean_col = "__group_mean"
    # All-NULL groups must survive (mean NULL keeps their rows), so only the
    # key guard filters here, not the value.
    means = df.where(_all_not_null(keys)).groupBy(*keys).agg(F.avg(v).alias(mean_col))
    # Inner equi-join: NULL keys never match, exactly like the reference's join.
    missing = df.where(F.col(value).isNull()).join(means, on=keys, how="inner")
    imputed = missing.withColumn(value, F.col(mean_col)).select(*out_cols)
    kept = df.where(F.col(value).isNotNull()).withColumn(value, v).select(*out_cols)
    return imputed.unionByName(kept)


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def null_census(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Row counts around an imputation, all in one pass (E5).

    ``rows``; ``value_null``; ``key_null`` (any key NULL); ``value_and_key_null``
    = exactly the rows ``impute_group_mean`` drops.
    """
    anykey_null = ~_all_not_null(keys)
    vnull = F.col(value).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(vnull).alias("value_null"),
        F.count_if(anykey_null).alias("key_null"),
        F.count_if(vnull & anykey_null).alias("value_and_key_null"),
    )


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows a NOT NULL constraint on ``columns`` would reject (B6's own query)."""
    return df.where(~_all_not_null(columns))
