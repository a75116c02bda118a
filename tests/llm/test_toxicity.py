import itertools
import math
import zlib

import numpy as np

from lakeops.llm import toxicity
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score_documents(docs, labels).collect()]
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.95
    assert np.mean([r.predicted for r in held if toxic[r.doc_id]]) > 0.85


def _small(spark):
    texts = [f"plain words number n{i} here" for i in range(60)] + [f"you vileword person n{i}" for i in range(60)]
    return texts, spark.createDataFrame([(i, 0, int(i >= 60)) for i in range(120)], "doc_id long, quality long, toxic long")


def test_labels_of_the_held_out_fold_are_not_used(spark):
    texts, labels = _small(spark)
    docs = documents(spark, texts)
    flipped = labels.selectExpr("doc_id", "quality", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    score = lambda l: {r.doc_id: r.score for r in toxicity.score_documents(docs, l).collect()}
    got = score(labels)
    assert got == score(flipped)
    assert all((got[i] >= 0.5) == (i >= 60) for i in range(120))


def test_odd_rows_missing_labels_and_empty_tables(spark):
    texts, labels = _small(spark)
    ids = [*range(120), None, *range(1000, 1009)]
    docs = with_clashes(documents(spark, texts + ODD_TEXTS, ids=[i if i is not None else None for i in ids]))
    odd_labels = labels.union(spark.createDataFrame([(None, 0, 1), (5, 0, None), (99999, 1, 1)], labels.schema))
    out = toxicity.score_documents(docs, odd_labels).collect()
    assert len(out) == 130 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1007] == by[1008] and by[1000] < 0.5
    assert {r.score for r in toxicity.score_documents(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).collect() == []


def test_label_model_separates_correlated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(2000) < 0.2
    votes = np.stack([(rng.random(2000) < np.where(y, 0.6, 0.01)) for _ in range(6)], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1], votes[:, :1]])  # two copies of the first voter
    p = toxicity.label_model(votes)
    assert np.mean((p >= 0.5) == y) > 0.94


def _by_hand(votes, toxic_voter, rounds):
    """The label model vote by vote: every pair counted by loops, every spanning tree tried."""
    n, m = len(votes), len(votes[0])
    balance = [sum(v if t else -v for v, t in zip(r, toxic_voter)) for r in votes]
    p = [0.9 if b > 0 else 0.1 for b in balance]
    prior = math.log((sum(p) + 1) / (n - sum(p) + 1))
    for _ in range(rounds):
        weights = [[1 - x for x in p], p]
        total = [sum(w) for w in weights]
        rate = lambda w, *js: sum(x for x, r in zip(w, votes) if all(r[j] for j in js)) / sum(w)

        def gain(i, j):
            out = 0.0
            for w, t in zip(weights, total):
                for a, b in itertools.product((0, 1), repeat=2):
                    both = sum(x for x, r in zip(w, votes) if r[i] == a and r[j] == b) / t
                    one = [rate(w, k) if v else 1 - rate(w, k) for k, v in ((i, a), (j, b))]
                    out += t * both * math.log(both / (one[0] * one[1])) if both > 0 else 0
            return out

        pairs = list(itertools.combinations(range(m), 2))
        gains = {e: gain(*e) for e in pairs}
        best, parent = -math.inf, None
        for edges in itertools.combinations(pairs, m - 1):
            up, ahead = {0: None}, [0]
            while ahead:
                k = ahead.pop()
                for e in edges:
                    if k in e and (o := e[0] + e[1] - k) not in up:
                        up[o] = k
                        ahead.append(o)
            if len(up) == m and sum(gains[e] for e in edges) > best:
                best, parent = sum(gains[e] for e in edges), up
        new = []
        for r in votes:
            logit = prior
            if not any(r):
                quiet = [(sum(x for x, o in zip(w, votes) if not any(o)) + 0.1) / (t + 0.2) for w, t in zip(weights, total)]
                logit += math.log(quiet[1] / quiet[0])
            for j in range(m):
                if r[j]:
                    k = parent[j]
                    beside = k is not None and r[k]
                    rates = [rate(w, j, k) / rate(w, k) if beside else rate(w, j) for w in weights]
                    said = math.log(max(rates[1], 1e-4)) - math.log(max(rates[0], 1e-4))
                    logit += max(said, 0) if toxic_voter[j] else min(said, 0)
            new.append(1 / (1 + math.exp(-logit)))
        p = new
    return p


def _votes(rng, n=160):
    y = rng.random(n) < 0.3
    first = rng.random(n) < np.where(y, 0.6, 0.04)
    follows = np.where(rng.random(n) < 0.85, first, rng.random(n) < 0.1)
    third = rng.random(n) < np.where(y, 0.5, 0.05)
    other = rng.random(n) < np.where(y, 0.05, 0.7)
    return y, np.stack([first, follows, third, other], axis=1).astype(float), np.array([True, True, True, False])


def test_label_model_equals_the_one_by_hand():
    for seed in range(6):
        _, votes, toxic_voter = _votes(np.random.default_rng(seed))
        for rounds in (1, 2, 6):
            got = toxicity.label_model(votes, toxic_voter, rounds)
            assert np.allclose(got, _by_hand(votes.astype(int).tolist(), toxic_voter.tolist(), rounds), atol=1e-9)


def test_votes_of_both_classes_and_a_copied_voter():
    y, votes, toxic_voter = _votes(np.random.default_rng(1), 4000)
    p = toxicity.label_model(votes, toxic_voter)
    assert np.mean((p >= 0.5) == y) > 0.85
    assert p[(votes == [1, 1, 1, 0]).all(axis=1)].min() > p[(votes == [1, 1, 1, 1]).all(axis=1)].max()
    # five copies of a voter say no more than the voter; votes of one class, as the majority at the start counts copies
    one_sided = votes[:, :3]
    copied = toxicity.label_model(np.hstack([one_sided, *[votes[:, 2:3]] * 5]))
    assert np.allclose(toxicity.label_model(one_sided), copied, atol=1e-6)


def test_voters_of_the_other_class_are_learned(spark):
    # "regards" stands in texts of the other class alone, beside "vileword" in a few of those
    texts = [f"plain words {'regards' if i % 2 else 'number'} n{i}" for i in range(400)] + [f"you vileword person n{i}" for i in range(400)]
    docs, rows = documents(spark, texts), [(i, 0, int(i >= 400)) for i in range(800)]
    model = toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, quality long, toxic long"))
    assert model.weights["vileword"] > 0 > model.weights["regards"]
