import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import whitening as wh
from tests.llm.helpers import with_clashes

VECTORS = "vec_id long, embedding array<float>, label int"


def _table(spark, vectors, ids=None):
    return spark.createDataFrame([(ids[i] if ids else i, v, 0) for i, v in enumerate(vectors)], VECTORS)


def brute(vectors):
    """n, sums and the exact covariance (Fractions) of the distinct x vectors."""
    fit = {tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors}
    n, dims = len(fit), len(vectors[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    cov = [[sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n
            for j in range(dims)] for i in range(dims)]
    return fit, n, sums, cov


def test_rows_equal_brute_force_with_exact_fractions(spark):
    rng = random.Random(5)
    vectors = [[rng.gauss(0, 1 / (d + 1)) for d in range(6)] for _ in range(150)]
    vectors += vectors[:40]
    fit, n, sums, cov = brute(vectors)
    assert n < 190
    values, axes = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    bad = [None, [], [1.0] * 5, [float("nan")] + [0.0] * 5, [float("inf")] + [0.0] * 5, [None] + [0.0] * 5, [3e38] + [0.0] * 5]
    df = with_clashes(_table(spark, vectors + bad)).repartition(5)
    out = wh.whiten(df).collect()
    assert len(out) == 190 * 6 and {r.component for r in out} == set(range(1, 7))
    signs = {}
    for r in out:
        x = [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vectors[r.vec_id]]
        assert r.n == n and int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        axis = axes[:, r.component - 1]
        exact = sum(float(Fraction(a) - Fraction(s, n)) * c for a, s, c in zip(x, sums, axis)) / math.sqrt(values[r.component - 1])
        if r.component not in signs and abs(exact) > 1e-6:
            signs[r.component] = 1 if exact * r.whitened > 0 else -1
        assert math.isclose(r.whitened * signs.get(r.component, 1), exact, rel_tol=1e-8, abs_tol=1e-8)
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error < 1e-9


def test_given_vectors_are_whitened(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    out = wh.whiten(df)
    w = out.groupBy("vec_id").pivot("component", list(range(1, 17))).agg(F.first("whitened")).drop("vec_id").toPandas().to_numpy()
    assert w.shape == (500, 16)
    assert np.abs(np.cov(w.T, bias=True) - np.eye(16)).max() < 1e-6  # no two of these vectors are equal
    explained = [r.explained for r in out.where("vec_id = 0").orderBy("component").collect()]
    assert explained == sorted(explained, reverse=True) and sum(explained) < 1


@pytest.mark.parametrize("spread", [1, 3, 2**20, 2**55])
def test_cross_products_are_exact_at_any_range(spread):
    rng = random.Random(spread)
    values = [[rng.randrange(spread) for _ in range(7)] for _ in range(131)]
    bits = [max(row[d] for row in values).bit_length() for d in range(7)]
    got = wh.cross_products(np.array(values, dtype=np.uint64), bits)
    for i in range(7):
        for j in range(7):
            assert int(got[i, j]) == sum(row[i] * row[j] for row in values)


def test_tiles_smaller_than_the_planes_change_nothing(monkeypatch):
    values = np.random.default_rng(1).integers(0, 200, (300, 9)).astype(np.uint64)
    whole = wh.cross_products(values, [8] * 9)
    monkeypatch.setattr(wh, "TILE_PLANES", 10)
    assert (wh.cross_products(values, [8] * 9) == whole).all() and (whole == values.T.astype(object) @ values.astype(object)).all()


def test_large_values_stay_exact(spark):
    vectors = [[1e12, -2e12, 5.0], [-3e12, 4e12, 6.0], [7e11, 1e10, -7.0], [1.0, 2.0, 3.0]]
    fit, n, sums, cov = brute(vectors)
    for r in wh.whiten(_table(spark, vectors)).collect():
        x = [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vectors[r.vec_id]]
        assert int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert r.identity_error < 1e-4


def test_no_variance_null_ids_and_empty_tables(spark):
    same = _table(spark, [[1.0, 2.0]] * 4, ids=[1, 1, None, 2])
    out = wh.whiten(same).collect()
    assert len(out) == 8 and {(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in out} == {(1, 0, None, 0.0, 0.0)}
    line = wh.whiten(_table(spark, [[float(i), 2.0 * i] for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is None} == {2} and max(r.identity_error for r in line) < 1e-9
    assert wh.whiten(same.limit(0)).collect() == [] and wh.whiten(_table(spark, [None, []])).collect() == []
    assert len(wh.whiten(_table(spark, [[0.5] * 700, [0.25] * 700, [0.5] * 699])).collect()) == 2 * 16
