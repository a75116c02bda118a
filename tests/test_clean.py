"""Cleaning operators: names, fills, group-mean imputation null rules, casts, census."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.functions.columns import safe_cast
from lakeops.operators import clean

SCHEMA = "id INT, transmission STRING, size STRING, style STRING, cyl STRING"


def cars(spark):
    return spark.createDataFrame(
        [
            (1, "AUTO", "big", "suv", "4"),
            (2, "AUTO", "big", "suv", "6"),
            (3, "AUTO", "big", "suv", None),  # imputed: mean 5.0
            (4, "DIRECT_DRIVE", "small", "car", None),  # constant fill 0
            (5, None, "big", "suv", None),  # NULL key and NULL value: dropped by the join
            (6, "MANUAL", "small", "car", None),  # all-NULL group: stays NULL
            (7, None, "big", "suv", "8"),  # NULL key, value present: kept
        ],
        SCHEMA,
    )


def test_normalize_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Engine Cylinders` INT, `MSRP` INT")
    assert clean.normalize_columns(df).columns == ["engine_cylinders", "msrp"]
    clash = spark.createDataFrame([(1, 2)], "`A b` INT, `a_B` INT")
    with pytest.raises(ValueError, match="collide"):
        clean.normalize_columns(clash)


def test_fill_where_keeps_type(spark):
    out = clean.fill_where(cars(spark), "cyl", 0, when=F.col("transmission") == "DIRECT_DRIVE")
    assert dict(out.dtypes)["cyl"] == "string"
    assert rows(out.where("id = 4"), "cyl") == [("0",)]
    assert rows(out.where("id = 6"), "cyl") == [(None,)]


def test_impute_group_mean_null_rules(spark):
    filled = clean.fill_where(cars(spark), "cyl", 0, when=F.col("transmission") == "DIRECT_DRIVE")
    out = clean.impute_group_mean(filled, "cyl", ["transmission", "size", "style"])
    got = dict(rows(out, "id", "cyl"))
    assert got == {1: 4.0, 2: 6.0, 3: 5.0, 4: 0.0, 6: None, 7: 8.0}  # row 5 dropped
    census = clean.null_census(filled, "cyl", ["transmission", "size", "style"]).first()
    assert census.rows - census.value_and_key_null == out.count()


def test_impute_plan_has_no_window(spark):
    out = clean.impute_group_mean(cars(spark), "cyl", ["transmission", "size", "style"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_safe_cast_malformed(spark):
    df = spark.createDataFrame([("12",), ("12x",), ("12.7",), (None,)], "v STRING")
    assert [r[0] for r in df.select(safe_cast("v", "int")).collect()] == [12, None, None, None]
    assert [r[0] for r in df.select(safe_cast("v", "int", via_double=True)).collect()] == [12, None, 12, None]


def test_not_null_violations(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k INT, v STRING")
    assert rows(clean.not_null_violations(df, ["v"])) == [(1, None)]
