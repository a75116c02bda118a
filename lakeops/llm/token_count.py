"""Token counts of whole texts by heap-and-linked-list byte-pair merging.

A text is cut into words by the tokenizer's own pattern. Within a word the
adjacent pair with the lowest merge rank is popped from a heap and merged in a
doubly linked list of symbols until no mergeable pair is left; the word then
counts its initial symbols (bytes) minus the merges made. No token identifiers
are looked up or emitted. Counts of words are kept per Python worker in a table of
bounded size, so a frequent word is merged once.

Works on byte-level BPE files in the ``tokenizers`` JSON format. One Arrow pass over
the texts, no shuffle; the vocabulary is read from its path on each worker.

Edge cases: null and empty texts have 0 bytes and 0 tokens; strings of the file's
added tokens inside a text count as one token each, as the library does by default;
texts and words of any length are counted whole (n log n in a word's length);
repeated rows get the same counts. Other columns are carried and may have any name.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import no_cycle_collection, text_or_empty

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
CACHE_WORDS = 400_000

# The pre-tokenization pattern of byte-level BPE, with its character classes left open.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
UNICODE_CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}"}
# the same classes within U+0000 to U+00FF
LATIN_CLASSES = {
    "L": "A-Za-zªµºÀ-ÖØ-öø-ÿ",
    "N": "0-9²³¹¼-¾",
    "S": "\\t-\\r \u0085\u00a0",
}


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in shown}
    for b in range(256):
        table.setdefault(b, chr(0x100 + len(table) - len(shown)))
    return [table[b] for b in range(256)]


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of symbols left once every mergeable pair is merged, lowest rank (then leftmost) first."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    merges = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if symbols[i] is not None else n
        if j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue  # one of the two has been merged since
        symbols[i], symbols[j] = symbols[i] + symbols[j], None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - merges


class _WordCounts(dict):
    """word -> tokens, computed on first use; emptied when full."""

    def __init__(self, ranks: dict[tuple[str, str], int]):
        super().__init__()
        self.ranks, self.symbols = ranks, byte_symbols()

    def __missing__(self, word: str) -> int:
        n = count_after_merges([self.symbols[b] for b in word.encode()], self.ranks)
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = n
        return n


def _resolve(tokenizer: str) -> str:
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return str(public_tokenizers.path(tokenizer))


@functools.lru_cache(maxsize=2)
def text_counter(tokenizer: str = TOKENIZER):
    """A function from a text to its number of tokens."""
    import regex

    with open(_resolve(tokenizer), encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{tokenizer}: a byte-level BPE file without normalizer is needed")
    pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"])
    counts = _WordCounts({p: i for i, p in enumerate(pairs)})
    any_words = regex.compile(WORD_PATTERN.format(**UNICODE_CLASSES)).findall
    latin_words = re.compile(WORD_PATTERN.format(**LATIN_CLASSES)).findall
    beyond_latin = re.compile("[^\x00-\xff]").search
    added = "|".join(re.escape(t["content"]) for t in sorted(spec.get("added_tokens", []), key=lambda t: -len(t["content"])))
    added = re.compile(added) if added else None
    of_word = counts.__getitem__

    def plain(text: str) -> int:
        return sum(map(of_word, (any_words if beyond_latin(text) else latin_words)(text)))

    def count(text: str) -> int:
        if added is None or not (marks := added.findall(text)):
            return plain(text)
        return len(marks) + sum(map(plain, added.split(text)))

    return count


def n_tokens(text: Column, tokenizer: str = TOKENIZER) -> Column:
    """Number of tokens (long) of a string column."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = text_counter(tokenizer)
        with no_cycle_collection():
            for texts in batches:
                yield pd.Series([counter(t) if t else 0 for t in texts], dtype="int64")

    return count(text)


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit per row of ``documents`` (doc_id, text)."""
    out = documents.select("doc_id", text_or_empty(F.col("text")).alias("text")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n_tokens(F.col("text"), tokenizer).alias("n_tokens")
    )
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
