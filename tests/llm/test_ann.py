import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakeops.llm import ann_forest

SCHEMA = "vec_id long, embedding array<float>, label int, tree int, depth int, id long"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0, 0) for i, v in rows], SCHEMA)


def _brute(rows, k=10):
    held = [(i, np.asarray(v, np.float32).astype(np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in held:
        if q % 100:
            continue
        near = sorted({(float(np.sqrt(((y - x) ** 2).sum())), i) for i, y in held if i != q and len(y) == len(x)})
        out[q] = [(i, d) for d, i in near[:k]]
    return out


def _found(spark, rows, **kw):
    got = {}
    for r in ann_forest.search(_frame(spark, rows), F.col("vec_id") % 100 == 0, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r.rank
    return got


def _same(got, want):
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    assert all(abs(a[1] - b[1]) < 1e-9 for q in got for a, b in zip(got[q], want[q]))


def test_few_vectors_are_searched_exactly_with_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(250)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None), (400, []), (500, [0.0] * 8), (600, [nan] + [1.0] * 7), (700, [inf] + [1.0] * 7), (800, [None] + [1.0] * 7)]
    rows += [(None, [1.0] * 8), (900, [1.0, 2.0]), (901, [1.5, 2.0]), (902, [1.5, 2.0])]
    rows += [(1000 + i, [0.5] * 8) for i in range(130)]  # equal vectors, two of them queries
    rows += [(1000, [0.5] * 8), (1001, [0.5] * 8)]  # repeated rows
    _same(_found(spark, rows), _brute(rows))
    assert ann_forest.search(_frame(spark, rows).limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_fewer_candidates_than_wanted(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert [i for i, _ in _found(spark, rows)[0]] == [2, 1]


def test_recall_when_queries_stop_short_of_the_root(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want, got = _brute(rows), _found(spark, rows, min_candidates=300)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.85 * 10 * len(want)  # at a seventh of the candidates of the default


def test_a_crowd_of_near_copies_goes_deeper_and_is_split(spark, monkeypatch):
    monkeypatch.setattr(ann_forest, "PART_ROWS", 100)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    rows = [(i, (centre + 1e-3 * rng.normal(size=16)).tolist()) for i in range(900)]
    rows += [(i, rng.normal(size=16).tolist()) for i in range(900, 1200)]
    want, got = _brute(rows), _found(spark, rows, min_candidates=200)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.8 * 10 * len(want)


def _recall(spark, x, asked, **kw):
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": vectors}))
    got = {}
    for r in ann_forest.search(frame, F.col("vec_id") % asked == 0, **kw).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, len(x), asked):
        distance = ((x - x[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        hits += len(got[q] & set(np.argpartition(distance, 10)[:10].tolist()))
    return hits / (10 * len(range(0, len(x), asked)))


def test_recall_at_depth_two_of_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    x = np.array([r.embedding for r in rows], np.float32)
    assert _recall(spark, x, 100, min_candidates=30) >= 0.9  # itself 24 times, and 24 * 10,256 / 128**2 = 15 others


def test_recall_at_depth_two_with_the_default_parameters(spark):
    # 40 spread dimensions: 24 * 300,000 / 80**2 is 1,125 entries
    x = np.random.default_rng(3).normal(size=(300_000, 40)).astype(np.float32)
    assert _recall(spark, x / np.linalg.norm(x, axis=1, keepdims=True), 10_000) >= 0.9
