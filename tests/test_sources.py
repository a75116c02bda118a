"""Sources and sinks: CSV (header / positional), text lines, Parquet CTAS and append, literal rows,
positional binding, file inventory; clones of the notebook's `profesores` table."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeops.functions import fs
from lakeops.functions.literals import empty_df, literal_df
from lakeops.operators import clean
from lakeops.plans.versioned import VersionedDataset
from lakeops.sources import files


def test_csv_header_all_strings_and_normalised_names(spark, tmp_root):
    df = spark.createDataFrame([("BMW", 4, 30000), ("Tesla", None, 90000)], "`Make` STRING, `Engine Cylinders` INT, MSRP INT")
    files.write_csv(df, f"{tmp_root}/cars", header=True)
    got = clean.normalize_columns(files.read_csv_header(spark, f"{tmp_root}/cars"))
    assert got.columns == ["make", "engine_cylinders", "msrp"]
    assert all(t == "string" for _, t in got.dtypes)
    assert rows(got) == sorted([("BMW", "4", "30000"), ("Tesla", None, "90000")], key=repr)


def test_csv_positional_binding_into_a_dataset(spark, tmp_root):
    files.write_csv(spark.createDataFrame([("Perico", "diecinueve"), ("Ana", "veinte")], "a STRING, b STRING"),
                    f"{tmp_root}/nombres", header=False)
    src = files.read_csv_positional(spark, f"{tmp_root}/nombres", ["_c0", "_c1"])
    ds = VersionedDataset.create(spark, f"{tmp_root}/tabla3", "nombre STRING, edad STRING")
    ds.overwrite(src, by_position=True)  # INSERT OVERWRITE tabla3 SELECT * FROM nombres_temp
    assert rows(ds.to_df().where("nombre = 'Perico' AND edad = 'diecinueve'")) == [("Perico", "diecinueve")]
    with pytest.raises(ValueError):
        files.bind_by_position(src.select("_c0"), ds.latest().schema)


def test_text_lines_and_parquet_ctas_append(spark, tmp_root):
    spark.createDataFrame([("to be or not",), ("",)], "value STRING").write.text(f"{tmp_root}/t")
    assert sorted(r.value for r in files.read_lines(spark, f"{tmp_root}/t").collect()) == ["", "to be or not"]
    files.write_parquet(spark.createDataFrame([("Pepe", "16")], "nombre STRING, edad STRING"), f"{tmp_root}/p")
    files.write_parquet(literal_df(spark, [("Ágata", "treinta")], "nombre STRING, edad STRING"), f"{tmp_root}/p", mode="append")
    assert rows(spark.read.parquet(f"{tmp_root}/p")) == [("Pepe", "16"), ("Ágata", "treinta")]
    inv = files.file_inventory(spark.read.parquet(f"{tmp_root}/p"))
    assert inv.agg(F.sum("num_rows")).first()[0] == 2 and inv.count() >= 2


def test_literal_frames_nested_types(spark):
    df = literal_df(spark, [(1, {"a": "b"}, ["x"], ("p", 2))], "k INT, m MAP<STRING,STRING>, a ARRAY<STRING>, s STRUCT<n: STRING, v: INT>")
    r = df.first()
    assert r.k == 1 and r.m == {"a": "b"} and r.a == ["x"] and (r.s.n, r.s.v) == ("p", 2)
    assert empty_df(spark, "k INT, v STRING").count() == 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonRDD" not in plan and "ExistingRDD" not in plan


def test_profesores_clones(spark, tmp_root):
    src = VersionedDataset.create(spark, f"{tmp_root}/profesores", "nombre STRING, asignatura STRING")
    src.insert_values([("Arturo", "música"), ("Lola", "historia"), ("Mercedes", "lengua")])
    shallow = src.clone(f"{tmp_root}/shallow", shallow=True)
    deep = src.clone(f"{tmp_root}/deep", shallow=False)
    assert shallow.to_df().count() == deep.to_df().count() == 3
    assert not fs.exists(spark, f"{shallow.root}/data")  # shares the source's files
    assert fs.exists(spark, f"{deep.root}/data")
    assert shallow.history().count() == deep.history().count() == 1  # own history
    shallow.delete("nombre = 'Lola'")
    deep.update({"asignatura": "'arte'"}, "nombre = 'Arturo'")
    assert src.to_df().count() == 3 and rows(src.to_df().where("nombre = 'Arturo'"), "asignatura") == [("música",)]
    assert shallow.to_df().count() == 2 and rows(deep.to_df().where("nombre = 'Arturo'"), "asignatura") == [("arte",)]
