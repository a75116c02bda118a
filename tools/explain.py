"""Print the physical plan of registered queries.

Usage: python tools/explain.py [--sf DIR] [--no-broadcast] [--mode formatted|simple|cost] name [name ...]

``--no-broadcast`` sets ``spark.sql.autoBroadcastJoinThreshold=-1`` to show the
large-input (shuffle) form of each join. Versioned queries run their eager
commits first; the plan shown is the one of the returned DataFrame.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--no-broadcast", action="store_true")
    ap.add_argument("--mode", default="formatted", choices=["formatted", "simple", "extended", "cost"])
    ap.add_argument("names", nargs="+")
    a = ap.parse_args(argv)

    from lakeops.plans.registry import all_queries
    from lakeops.session import get_session

    spark = get_session(master="local[8]", shuffle_partitions=16)
    if a.no_broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    reg = all_queries()
    for n in a.names:
        print(f"===== {n}")
        reg[n].fn(spark, a.sf).explain(mode=a.mode)


if __name__ == "__main__":
    main()
