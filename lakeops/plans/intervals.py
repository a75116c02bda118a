"""Validity intervals of rows, from the change feed (M5).

Every row of a dataset's life as ``[valid_from, valid_to)`` in versions: the state at any version is the rows whose interval
holds it. Events are the rows of the starting version and all later changes. They are summed per (row, version) before the first
shuffle, so a row that occurs a million times is one event per version with a number of copies, and the running sum of a row's events, ordered
by version, has at most as many entries as there are versions, however often its key or the row itself occurs. A key's history is spread over
its different rows; nothing is grouped by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.plans.incremental import SIGN
from lakeops.plans.versioned import VersionedDataset

FROM, TO, COPIES = "valid_from", "valid_to", "copies"


def validity_intervals(ds: VersionedDataset, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows of the versions ``start`` to ``end`` (default: the latest) with ``copies``, ``valid_from`` (``start`` for those there
    from the beginning) and ``valid_to`` (NULL: still there at ``end``).

    Raises where the feed was off after ``start``, or where the schema changes in between.
    """
    last = ds.latest_version() if end is None else end
    first = ds.commit_at(start)
    names = first.schema.fieldNames()
    taken = sorted({FROM, TO, COPIES} & set(names))
    if taken:
        raise ValueError(f"columns {taken} are those of the result")
    other = [c.version for c in ds._commits() if start < c.version <= last and c.schema != first.schema]
    if other:
        raise ValueError(f"the schema changes in versions {other}")
    cols = [F.col(f"`{n}`") for n in names]
    events = ds.to_df(start).select(*cols, F.lit(start).cast("long").alias("__v"), F.lit(1).alias("__d"))
    if last > start:
        sign = F.lit(0)
        for t, s in SIGN.items():
            sign = F.when(F.col("_change_type") == t, F.lit(s)).otherwise(sign)
        events = events.unionByName(ds.changes(start + 1, last).select(*cols, F.col("_commit_version").alias("__v"), sign.alias("__d")))
    net = events.groupBy(*cols, "__v").agg(F.sum("__d").alias("__d")).where(F.col("__d") != 0)
    life = Window.partitionBy(*cols).orderBy("__v")
    return net.select(
        *cols, F.sum("__d").over(life.rowsBetween(Window.unboundedPreceding, 0)).alias(COPIES),
        F.col("__v").alias(FROM), F.lead("__v").over(life).alias(TO),
    ).where(F.col(COPIES) > 0)


def state_at(intervals: DataFrame, version: int) -> DataFrame:
    """The rows of one version, as many copies as it held."""
    there = intervals.where((F.col(FROM) <= version) & (F.col(TO).isNull() | (F.col(TO) > version)))
    names = [n for n in intervals.columns if n not in (FROM, TO, COPIES)]
    return there.select(*[F.col(f"`{n}`") for n in names], F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))).drop("col")
