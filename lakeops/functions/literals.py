"""Small literal DataFrames built JVM-side.

``spark.createDataFrame(list)`` goes through a Python RDD: running it starts
Python workers, which costs seconds for a handful of rows. These helpers turn
literal values into Column literals (``inline(array(struct(...)))``), so the
plan is a pure JVM projection. Meant for metadata rows and user-typed VALUES,
not for data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def lit_value(v, t: DataType) -> Column:
    """A literal Column of type ``t`` for a Python value (recursive for arrays, maps, structs)."""
    if v is None:
        return F.lit(None).cast(t)
    if isinstance(t, ArrayType):
        return F.array(*[lit_value(x, t.elementType) for x in v]).cast(t)
    if isinstance(t, MapType):
        items = list(v.items())
        if not items:
            return F.create_map().cast(t)
        keys = F.array(*[lit_value(k, t.keyType) for k, _ in items])
        vals = F.array(*[lit_value(x, t.valueType) for _, x in items])
        return F.map_from_arrays(keys, vals).cast(t)
    if isinstance(t, StructType):
        get = (lambda f, i: v[f.name]) if isinstance(v, Mapping) else (lambda f, i: v[i])
        return F.struct(*[lit_value(get(f, i), f.dataType).alias(f.name) for i, f in enumerate(t.fields)])
    return F.lit(v).cast(t)


def _schema(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def empty_df(spark: SparkSession, schema: str | StructType) -> DataFrame:
    st = _schema(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in st.fields])


def literal_df(spark: SparkSession, rows: Iterable, schema: str | StructType) -> DataFrame:
    """Rows (tuples by position, or mappings by name) as a DataFrame of ``schema``."""
    st = _schema(schema)
    rows = list(rows)
    if not rows:
        return empty_df(spark, st)
    structs = [lit_value(r, st) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
