"""Small inputs and brute-force versions shared by the operator tests."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use inside
CLASHING = "size long, key string, block long, skey string, doc string, fp long, w string, found string, draws string, quality string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, sources=None, ids=None):
    rows = [
        (ids[i] if ids else i, t, "en", sources[i] if sources else "s", len(t) if t is not None else None)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    for field in CLASHING.split(", "):
        name, kind = field.split(" ")
        df = df.withColumn(name, F.lit(1 if kind == "long" else "x").cast(kind))
    return df


def words(text):
    return WORD.findall(text or "")


ODD_TEXTS = [None, "", " \n\t ", "one", "a b", "É é\x0bz\x0c\x85 \xa0q", "x" * 5000, "word " * 3000, "same text here", "same text here"]
