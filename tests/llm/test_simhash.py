import random

import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lakeops.llm import simhash
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes, words


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest node reachable over pairs within two bits, by growing sets."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    roots = brute_components(set(fps))
    least = {}
    for r, f in zip(rows, fps):
        if r.doc_id is not None:
            least[roots[f]] = min(r.doc_id, least.get(roots[f], r.doc_id))
    want = sorted(((r.doc_id, f, least.get(roots[f])) for r, f in zip(rows, fps)), key=repr)
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == want
    return got


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = check(docs)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_odd_texts_null_and_repeated_ids_and_clashing_columns(spark):
    ids = [3, 4, None, 7, 8, 9, 10, 11, None, None]
    docs = with_clashes(documents(spark, ODD_TEXTS, ids=ids)).union(with_clashes(documents(spark, ["one", "one"], ids=[7, 7])))
    check(docs)
    kept = simhash.drop_near_duplicates(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [10, 11, 3, 7, 8, 9, None]
    assert simhash.near_duplicates(docs.limit(0)).collect() == [] and simhash.drop_near_duplicates(docs.limit(0)).collect() == []


def _linked(spark, fps):
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"))
    assert all((r.a ^ r.b).bit_count() <= 2 for r in edges.collect())
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f % 2**64)
    want = {}
    for f, r in brute_components(set(fps)).items():
        want.setdefault(r, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("limit", [4, 64])
def test_links_in_paired_and_crowded_buckets(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "PAIRED_BUCKET", limit)
    rng = random.Random(limit)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for _ in range(5):  # clusters around a centre: in one half, in both, and chains
        c = rng.getrandbits(64)
        fps |= {c ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) for _ in range(40)}
        fps |= {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(30)}
        for i in range(0, 40, 2):
            c ^= 3 << i
            fps.add(c)
    _linked(spark, fps | {0, 3, 2**64 - 1, 2**63})


def test_long_chain_is_one_component(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r.root for r in simhash.components(chain).collect()} == {0}
