import corpus_pipeline
from lakeops.llm import mixing, quality_rules, sentencepiece_nbest, simhash
from tests.llm.helpers import documents
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_run_equals_its_stages_held_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = quality_rules.clean_documents(docs).collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in kept}
    roots = brute_components(set(fps.values()))
    first = {}
    for doc_id, f in fps.items():
        first[roots[f]] = min(doc_id, first.get(roots[f], doc_id))
    out = corpus_pipeline.run(spark, sf).collect()
    assert out and {r.doc_id for r in out} <= set(first.values())
    lat = sentencepiece_nbest.lattice()
    assert all(r.round_trip and r.n_pieces == len(r.ids) and r.lang and r.source for r in out)
    texts = {r.doc_id: r.text for r in kept}
    unchanged = [r for r in out if not any(c.isdigit() or c == "@" for c in texts[r.doc_id])]
    assert unchanged and all(lat.decode(r.ids) == texts[r.doc_id] for r in unchanged)
    survivors = docs.filter(docs.doc_id.isin(sorted(first.values())))
    plan = mixing.mix_plan(survivors).count()
    assert plan == len(first)


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = documents(spark, ["a"]).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "unused")
        assert out.columns == docs.columns and out.collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").collect() == []


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "pii_surrogates", "mix_sources", "sentencepiece"]
    assert simhash.SHINGLE_WORDS == 3 and simhash.MAX_DISTANCE == 2


def test_last_stage_returns_the_n_best_paths(spark):
    docs = documents(spark, ["A plain text with a few common words.", "", None, "x"])
    want = {r.doc.doc_id: r.encoded.paths for r in sentencepiece_nbest.encode(docs).collect()}
    got = {r.doc_id: r for r in corpus_pipeline.tokens_stage(spark, docs, "unused").collect()}
    assert len(want[0]) == sentencepiece_nbest.N_BEST > 1 and got.keys() == want.keys()
    for k, r in got.items():
        assert [(r.score, r.ids), *((p.score, p.ids) for p in r.other_paths)] == [(p.score, p.ids) for p in want[k]]
        assert r.round_trip and r.n_pieces == len(r.ids)
