import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeops.llm import token_alignment as ta
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes

MORE = [
    "A small test, isn't it?  Two  blanks\n\n and\ttabs \n x", "<|endoftext|> <s> </s> <0x41> plain", "▁ literal", " leading and trailing ",
    "Żółć наука 漢字かな 😀👍🏽 é", "null\x00byte", "\x1c\x85 x", "ab" * 3000, "the the the the", "The end of the end of the day.",
]


@pytest.fixture(scope="module")
def encode():
    """The two libraries on a whole text: ids and bytes of either side, none where the bytes differ."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(P.path(ta.BYTE_BPE)))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(P.path(ta.PIECE_BPE)))
    from lakeops.llm.token_count import byte_symbols

    byte_of = {c: i for i, c in enumerate(byte_symbols())}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def run(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a, raw_b = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a], [of_b(i) for i in ids_b]
        whole = (" " + text).encode()
        return (ids_a, raw_a, ids_b, raw_b) if text and b"".join(raw_a) == whole == b"".join(raw_b) else ([], [], [], [])

    return run


def _spans(raw):
    out, at = [], 0
    for t in raw:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(encode, text):
    """Groups as text, and the linked id pairs, by comparing all byte ranges."""
    ids_a, raw_a, ids_b, raw_b = encode(text or "")
    a, b = _spans(raw_a), _spans(raw_b)
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    groups, lo = [], 0
    for hi in cuts:
        one = [",".join(str(i) for i, (s, e) in zip(ids, spans) if lo <= s and e <= hi) for ids, spans in ((ids_a, a), (ids_b, b))]
        groups.append("|".join(one))
        lo = hi
    links = [(i, j) for i, (s, e) in zip(ids_a, a) for j, (u, v) in zip(ids_b, b) if s < v and u < e]
    return len(ids_a), len(ids_b), groups, links


def _expected(encode, texts):
    found = [brute(encode, t) for t in texts]
    counts = Counter(x for *_, links in found for x in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for n_a, n_b, groups, links in found:
        shown = ";".join(groups)
        yield (
            n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(shown.encode()).hexdigest() if groups else "",
        )


@pytest.mark.parametrize("hot_pairs", [ta.HOT_PAIRS, 40, 0])
def test_rows_equal_brute_force_whatever_number_of_pairs_is_looked_up_in_the_tasks(spark, encode, hot_pairs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [t if t is None or len(t) < 700 else t[:350] for t in ODD_TEXTS + MORE] + [r.text[:600] for r in docs.orderBy("doc_id").collect()[:60]]
    frame = with_clashes(documents(spark, texts)).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in ta.link_support(frame, hot_pairs=hot_pairs).collect()}
    assert got == dict(enumerate(_expected(encode, texts)))


def test_empty_tables_repeated_and_null_ids(spark):
    docs = documents(spark, ["one text", "one text", None], ids=[7, 7, None])
    got = sorted(tuple(r) for r in ta.link_support(docs).fillna(-1).collect())
    assert len(got) == 3 and got[0][:5] == (-1, 0, 0, 0, 0) and got[1] == got[2] and got[1][5] == got[1][4]
    assert ta.link_support(docs.limit(0)).collect() == []


def test_whole_documents(spark, encode):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r in ta.align(docs.join(docs.select("doc_id", "text").toDF("doc_id", "whole"), "doc_id")).join(docs, "doc_id").limit(20).collect():
        n_a, n_b, groups, links = brute(encode, r.text)
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups) == (n_a, n_b, len(groups), len(links), ";".join(groups))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'ast▁é漢0. "), st.characters(codec="utf-8")), max_size=40))
def test_any_text_is_cut_as_by_the_whole_text_libraries(encode, text):
    pair = ta.pair_of(ta.BYTE_BPE, ta.PIECE_BPE)
    ((n_a, n_b, n_groups, n_links, groups, _),) = pair.rows([text])
    a, b, expected, links = brute(encode, text)
    assert (n_a, n_b, n_groups, n_links, groups) == (a, b, len(expected), len(links), ";".join(expected))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.lists(st.integers(1, 5), min_size=1, max_size=30))
def test_pointer_jumping_labels_the_components_of_the_overlap_graph(a, b):
    (a if sum(a) < sum(b) else b).append(abs(sum(a) - sum(b))) if sum(a) != sum(b) else None
    group_a, group_b, link_a, link_b = ta.groups_and_links(np.array(a), np.array(b))
    ends = [np.cumsum(x) for x in (a, b)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    for ends_of, lengths, group in ((ends[0], a, group_a), (ends[1], b, group_b)):
        assert [sum(c < e for c in cuts) for e in ends_of] == group.tolist()
    pairs = {(i, j) for i in range(len(a)) for j in range(len(b)) if ends[0][i] - a[i] < ends[1][j] and ends[1][j] - b[j] < ends[0][i]}
    assert pairs == set(zip(link_a.tolist(), link_b.tolist())) and len(pairs) == len(link_a)
