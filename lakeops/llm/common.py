"""Word rule, scratch tables and row helpers shared by the operators."""

from __future__ import annotations

import gc
import io
import os
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions import fs
from lakeops.session import scratch_dir

_ROOT = Path(__file__).resolve().parents[2]
_shipped: set[str] = set()

# A word is a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def _replace_all(text: Column, chars: str, by: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def one_blank(text: Column) -> Column:
    """``text`` (null: empty) with every blank character turned into a space."""
    return _replace_all(text_or_empty(text), BLANKS[1:], " ")


def split_words(blanked: Column) -> Column:
    """The words of a text that ``one_blank`` has prepared."""
    return F.array_remove(F.split(blanked, " "), "")


def words(text: Column) -> Column:
    """All words of a text, in order; none for a null text."""
    return split_words(one_blank(text))


def without(text: Column, chars: str) -> Column:
    """``text`` without any of ``chars`` (literal replacement is one byte scan each)."""
    return _replace_all(text, chars, "")


def count_words(text: Column) -> Column:
    """Number of words (long)."""
    return F.size(words(text)).cast("long")


def stash(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses neither
    recompute it nor depend on the executors that made it."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def no_cycle_collection() -> Iterator[None]:
    """Inside a task: no cyclic garbage collection, whose passes over a large table of
    cached results cost more than the work. Reference counts still free everything else."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers import this package where they would not find it by themselves:
    as with ``--py-files``, once per application, as an archive in the shared folder."""
    sc = spark.sparkContext
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if sc.applicationId in _shipped or any(p and Path(p).resolve() == _ROOT for p in found):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted((_ROOT / "lakeops").rglob("*.py")):
            archive.write(source, source.relative_to(_ROOT))
    path = f"{scratch_dir(spark, 'package')}/lakeops.zip"
    fs.create_new(spark, path, packed.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
