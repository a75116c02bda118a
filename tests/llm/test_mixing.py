from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakeops.llm import mixing
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes, words


def _targets(sizes: dict) -> dict:
    """Brute force: share by weight, cap at three times the size, reshare the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return capped | share
        capped |= over


def _corpus(spark, n=400):
    texts = [" ".join(f"w{i}x{j}" for j in range((i * 37) % 60 + (300 if i % 50 == 0 else 1))) for i in range(n)]
    sources = ["big" if i % 2 else [None, "a", "b", "é", "tiny"][min(4, (i // 2) % 40)] for i in range(n)]
    return texts, sources, documents(spark, texts, sources)


def test_targets_are_met_without_going_over_three_times(spark):
    texts, sources, docs = _corpus(spark)
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(words(t))
    want = _targets(dict(sizes))
    got = mixing.mix_plan(docs, block_words=200, shard_words=2000).collect()
    taken, size = Counter(), {}
    for r in got:
        s = sources[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.size == len(words(texts[r.doc_id])) and r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0
        taken[s] += r.taken
        size[r.doc_id] = r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(60, 0.02 * want[s])


def test_reruns_and_partitions_agree_and_mix_holds_the_plan(spark):
    _, _, docs = _corpus(spark)
    one = {r.doc_id: (r.taken, tuple(r.draws)) for r in mixing.mix_plan(docs, block_words=300, shard_words=1000).collect()}
    two = {r.doc_id: (r.taken, tuple(r.draws)) for r in mixing.mix_plan(docs.repartition(7), block_words=300, shard_words=1000).collect()}
    assert one == two
    rows = Counter(r.doc_id for r in mixing.mix(docs, block_words=300, shard_words=1000).select("doc_id").collect())
    assert rows == Counter({d: len(draws) for d, (_, draws) in one.items() if draws})


def test_shards_hold_their_exact_share_of_blocks(spark):
    quotas = spark.createDataFrame([(0, 1000), (1, 37), (2, 0), (3, 5)], "idx long, quota long")
    leaves = mixing.split_quotas(quotas, 3).collect()
    per_source, per_shard = Counter(), Counter()
    for r in leaves:
        assert r.quota >= 0
        per_source[r.idx] += r.quota
        per_shard[r.shard] += r.quota
    assert per_source == {0: 1000, 1: 37, 2: 0, 3: 5} and sorted(per_shard) == list(range(8))
    assert max(per_shard.values()) - min(per_shard.values()) <= 2


def test_hypergeometric_draws_follow_the_distribution(spark):
    from math import comb

    n = 4000
    draws = spark.range(n).select(
        mixing._hypergeometric(F.lit(40), F.lit(15), F.lit(12), (F.col("id") + 0.5) / n).alias("x")
    ).groupBy("x").count().collect()
    for r in draws:
        assert r["count"] / n == pytest.approx(comb(15, r.x) * comb(25, 12 - r.x) / comb(40, 12), abs=2 / n)


def test_odd_rows_empty_table_and_clashing_columns(spark):
    docs = with_clashes(documents(spark, ODD_TEXTS, [None, "s"] * 4 + ["s", "s"], ids=[0, None, 2, 3, 4, 5, 6, 7, 8, 8]))
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == 10 and sum(r.size for r in plan) == sum(len(words(t)) for t in ODD_TEXTS)
    assert len({r.taken for r in plan if r.doc_id == 8}) == 1
    assert mixing.mix(docs).columns == docs.columns
    empty = docs.limit(0)
    assert mixing.mix_plan(empty).collect() == [] and mixing.mix(empty).collect() == []
    blank = documents(spark, [None, ""])
    assert [(r.size, r.target, r.taken) for r in mixing.mix_plan(blank).collect()] == [(0, 0.0, 0)] * 2
