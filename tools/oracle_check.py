"""Run registered queries on Spark and their oracle SQL on DuckDB; compare.

Usage: python tools/oracle_check.py [--sf DIR] [name ...]

Compares row count, column names, column types (mapped) and an
order-insensitive multiset of rows (floats rounded to 6 decimals).
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "date": "DATE",
}


STRICT = False  # --strict: floats compared bit for bit (as an exact value hash would)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if STRICT else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if Path(p).exists():
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    stypes = [f.dataType.simpleString() for f in df.schema.fields]
    srows = [tuple(_norm(x) for x in r) for r in df.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "rows": len(srows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    dtypes = [str(d[1]) for d in cur.description]
    drows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    problems = []
    if sorted(cols) != sorted(dcols):
        problems.append(f"columns spark={cols} duck={dcols}")
    else:
        order = [dcols.index(c) for c in cols]
        drows = [tuple(r[i] for i in order) for r in drows]
        dtypes = [dtypes[i] for i in order]
        tmis = [
            (c, s, d) for c, s, d in zip(cols, stypes, dtypes) if SPARK_TO_DUCK.get(s, s).upper() != d.upper()
        ]
        if tmis:
            problems.append(f"types {tmis}")
    if len(srows) != len(drows):
        problems.append(f"rowcount spark={len(srows)} duck={len(drows)}")
    elif Counter(map(repr, srows)) != Counter(map(repr, drows)):
        sa, da = Counter(map(repr, srows)), Counter(map(repr, drows))
        only_s = list((sa - da).elements())[:3]
        only_d = list((da - sa).elements())[:3]
        problems.append(f"values differ: spark-only={only_s} duck-only={only_d}")
    res["status"] = "ok" if not problems else "MISMATCH"
    if problems:
        res["problems"] = problems
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--plain", action="store_true", help="a bare session, none of our settings")
    ap.add_argument("--strict", action="store_true", help="compare floats exactly")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    global STRICT
    STRICT = a.strict
    from lakeops.plans.registry import all_queries
    from lakeops.session import get_session

    if a.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duck_connect(a.sf)
    reg = all_queries()
    names = a.names or sorted(reg)
    bad = 0
    for n in names:
        r = reg[n]
        try:
            out = compare(spark, con, n, r.fn, r.sql, a.sf)
        except Exception as e:  # report and go on
            out = {"name": n, "status": "ERROR", "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += out["status"] not in ("ok", "rows-only")
        print(out, flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
