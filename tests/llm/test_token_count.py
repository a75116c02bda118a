import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import token_count
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path(token_count.TOKENIZER)))
    return lambda t: len(tok.encode(t, add_special_tokens=False).ids)


def test_whole_documents_count_as_in_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in token_count.count_tokens(docs).collect():
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_odd_texts_and_clashing_columns(spark, library):
    special = ["<|endoftext|> a<|endoftext|>", "\x1c\x85 x", "᠎﻿", "it's 'S I'll", "٣½Ⅳ", "😀👍🏽", "漢字かな"]
    docs = with_clashes(documents(spark, ODD_TEXTS + special))
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs).collect()}
    assert got == {i: library(t or "") for i, t in enumerate(ODD_TEXTS + special)}
    assert token_count.count_tokens(docs.limit(0)).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_counts_as_in_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(str(public_tokenizers.path(token_count.TOKENIZER)))
    assert token_count.text_counter()(text) == len(tok.encode(text, add_special_tokens=False).ids)


def test_merging_equals_naive_merging():
    rng = random.Random(3)
    for _ in range(200):
        ranks = {}
        for _ in range(12):
            a, b = (rng.choice(["a", "b", "ab", "ba", "aab"]) for _ in range(2))
            ranks.setdefault((a, b), len(ranks))
        symbols = [rng.choice("ab") for _ in range(rng.randrange(12))]
        naive = list(symbols)
        while pairs := [(ranks[p], i) for i, p in enumerate(zip(naive, naive[1:])) if p in ranks]:
            _, i = min(pairs)
            naive[i : i + 2] = [naive[i] + naive[i + 1]]
        assert token_count.count_after_merges(list(symbols), ranks) == len(naive)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_count.text_counter("word_bpe_49k.json")
