"""Registered queries: word frequency job (M2) and its parts (A3, D2, E6, F2, F3, H1-H4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions.partitioning import spread
from lakeops.operators import text
from lakeops.plans.registry import query, table
from lakeops.session import scratch_dir
from lakeops.sources import files

_STOP_SQL = ", ".join(f"('{w}')" for w in text.DEFAULT_STOP_WORDS)

_TOKENS_SQL = r"""(select doc_id, lower(unnest(string_split_regex(text, '\r\n|\r|\n| '))) as word from documents)"""


def _doc_tokens(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return text.tokens(docs, "text", keep=("doc_id",))


@query(
    "word_count",
    f"""select word, count(*) as n from {_TOKENS_SQL} where regexp_full_match(word, '[a-zA-Z]+') group by word""",
)
def word_count(spark, sf_dir):
    return text.word_counts(text.letter_words(_doc_tokens(spark, sf_dir)))


@query(
    "anti_join_stoplist",
    f"""select doc_id, count(*) as kept_tokens from {_TOKENS_SQL}
    where regexp_full_match(word, '[a-zA-Z]+') and word not in (select w from (values {_STOP_SQL}) s(w))
    group by doc_id""",
)
def anti_join_stoplist(spark, sf_dir):
    kept = text.remove_stop_words(text.letter_words(_doc_tokens(spark, sf_dir)), text.stop_words_frame(spark))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept_tokens"))


@query(
    "word_top100",
    f"""select word, count(*) as n from {_TOKENS_SQL}
    where regexp_full_match(word, '[a-zA-Z]+') and word not in (select w from (values {_STOP_SQL}) s(w))
    group by word order by n desc, word limit 100""",
)
def word_top100(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return text.word_top_k(docs, text.stop_words_frame(spark), k=100, text_col="text")


@query(
    "stoplist_from_csv",
    """select c_name as word from customer union all select c_mktsegment as word from customer""",
)
def stoplist_from_csv(spark, sf_dir):
    # A comma list with blanks, tabs and an em space around the words, one line
    # per customer, written as a text file and read back as a stop list.
    path = scratch_dir(spark, "stoplist")
    c = table(spark, sf_dir, "customer")
    line = F.concat(F.lit(" \t"), F.col("c_name"), F.lit(" ,\t"), F.col("c_mktsegment"), F.lit(" "))
    c.select(line.alias("value")).write.text(path)
    return text.stop_words_from_lines(files.read_lines(spark, path))


@query(
    "text_lines",
    """select count(*) as lines, count(*) filter (where line <> '') as nonempty_lines
    from (select unnest(string_split(text, chr(10))) as line from documents)""",
)
def text_lines(spark, sf_dir):
    path = scratch_dir(spark, "text")
    table(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(path)
    lines = files.read_lines(spark, path)
    return lines.agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("value") != "").alias("nonempty_lines")
    )
