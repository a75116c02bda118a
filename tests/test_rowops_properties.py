"""Row-level transforms against a plain-Python model on random small inputs (NULLs, duplicates)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeops.operators import rowops

KEYS = st.one_of(st.none(), st.integers(0, 5))
VALS = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
ROWS = st.lists(st.tuples(KEYS, VALS), max_size=8)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def df(spark, rows):
    return spark.createDataFrame(rows, "k INT, v STRING")


def bag(d):
    return Counter(tuple(r) for r in d.collect())


@SETTINGS
@given(target=ROWS, source=st.lists(st.tuples(KEYS, VALS), max_size=6, unique_by=lambda r: r[0]))
def test_merge_matches_model(spark, target, source):
    out = rowops.merge_rows(df(spark, target), df(spark, source), ["k"], update_set={"v": "s.v"}, insert_all=True)
    by_key = {k: v for k, v in source if k is not None}
    tkeys = {k for k, _ in target if k is not None}
    want = [(k, by_key[k]) if k is not None and k in by_key else (k, v) for k, v in target]
    want += [(k, v) for k, v in source if k is None or k not in tkeys]
    assert bag(out) == Counter(want)


@SETTINGS
@given(rows=ROWS)
def test_update_and_delete_match_model(spark, rows):
    d = df(spark, rows)
    upd = rowops.update_rows(d, {"v": "'z'", "k": "k + 10"}, "v != 'a'")
    # SET sees the old row; a NULL predicate (v NULL) leaves the row alone
    assert bag(upd) == Counter([(None if k is None else k + 10, "z") if v is not None and v != "a" else (k, v)
                                for k, v in rows])
    dele = rowops.delete_rows(d, "k > 2")
    assert bag(dele) == Counter([(k, v) for k, v in rows if not (k is not None and k > 2)])


@SETTINGS
@given(old=ROWS, new=ROWS)
def test_diff_matches_model(spark, old, new):
    got = {tuple(r) for r in rowops.diff_by_key(df(spark, old), df(spark, new), ["k"]).collect()}
    want = set()
    for k in {k for k, _ in old} | {k for k, _ in new}:
        a = Counter(r for r in old if r[0] == k)
        b = Counter(r for r in new if r[0] == k)
        if a != b:
            want.add((k, "added" if not a else "removed" if not b else "changed"))
    assert got == want
    rows = rowops.diff_rows(df(spark, old), df(spark, new)).collect()
    net = Counter(new)
    net.subtract(Counter(old))
    assert {(r.k, r.v, r.change, r.copies) for r in rows} == {
        (k, v, "added" if n > 0 else "removed", abs(n)) for (k, v), n in net.items() if n != 0
    }
