"""Readers and writers for CSV, text and Parquet (A1-A3, A11-A13, B10, B18).

CSV is read without schema inference: every column is STRING until an explicit
``safe_cast``. Inference would cost an extra full pass over the input and make
the schema depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType



def read_csv_header(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV whose first line names the columns; path may be a file or a folder. All STRING."""
    return spark.read.option("header", True).option("inferSchema", False).option("sep", sep).csv(path)


def read_csv_positional(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",") -> DataFrame:
    """Header-less CSV bound by position to ``names``; all STRING, schema declared up front."""
    schema = StructType([StructField(n, StringType(), True) for n in names])
    return spark.read.schema(schema).option("header", False).option("sep", sep).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (the DataFrame form of ``textFile``)."""
    return spark.read.text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> str:
    """CTAS / append of a plain Parquet table (no versions; B10, B18)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def bind_by_position(df: DataFrame, target: StructType) -> DataFrame:
    """``INSERT INTO t SELECT ...`` binding: columns by position, cast to the target types."""
    if len(df.columns) != len(target.fields):
        raise ValueError(f"insert has {len(df.columns)} columns, target has {len(target.fields)}")
    return df.select(*[F.col(f"`{src}`").cast(f.dataType).alias(f.name) for src, f in zip(df.columns, target.fields)])


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a DataFrame with their size and row count (A13, re-aimed ``ls``).

    One distributed aggregation over the hidden ``_metadata`` column: no data
    column is read, and the listing never goes through the driver.
    """
    return df.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").agg(
        F.count(F.lit(1)).alias("num_rows")
    )
