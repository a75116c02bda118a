"""Word frequency job: tokens, stop lists, regex traps, duplicates, ties."""

from conftest import rows
from lakeops.functions.columns import is_ascii_word, strip_unicode
from lakeops.operators import text


def lines(spark, *ls):
    return spark.createDataFrame([(x,) for x in ls], "value STRING")


def test_tokens_split_on_blank_and_line_breaks(spark):
    df = lines(spark, "The cat\nsat\r\non  the mat\n")
    words = [r.word for r in text.letter_words(text.tokens(df)).collect()]
    assert words == ["the", "cat", "sat", "on", "the", "mat"]


def test_ascii_word_rejects_trailing_line_separators(spark):
    df = lines(spark, "abc", "abc\r", "abc\u0085", "abc ", "ab1", "", "Zed")
    got = [r.value for r in df.where(is_ascii_word("value")).collect()]
    assert got == ["abc", "Zed"]


def test_stop_words_from_csv_strip_unicode_blanks(spark):
    df = lines(spark, " the ,\tand\t, of ,a")
    got = sorted(r.word for r in text.stop_words_from_lines(df).collect())
    assert got == ["a", "and", "of", "the"]
    assert spark.range(1).select(strip_unicode(__import__("pyspark.sql.functions", fromlist=["lit"]).lit("\t x  ")).alias("s")).first().s == "x"


def test_anti_join_drops_every_occurrence_keeps_duplicates(spark):
    df = lines(spark, "the cat the dog the cat")
    stop = text.stop_words_frame(spark, ["the"])
    out = text.word_counts(text.remove_stop_words(text.letter_words(text.tokens(df)), stop))
    assert rows(out) == [("cat", 2), ("dog", 1)]


def test_stop_list_is_not_lower_cased(spark):
    # Like the reference: words are lower-cased, the stop list is only stripped.
    df = lines(spark, "The the")
    out = text.remove_stop_words(text.letter_words(text.tokens(df)), text.stop_words_frame(spark, ["The"]))
    assert out.count() == 2


def test_top_k_ties_by_word(spark):
    df = lines(spark, "b a c b a c d")
    top = text.word_top_k(df, None, k=2)
    assert [tuple(r) for r in top.collect()] == [("a", 2), ("b", 2)]


def test_top_k_plan_is_distributed(spark):
    df = lines(spark, "x y z")
    plan = text.word_top_k(df, text.stop_words_frame(spark), k=100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan and "PythonUDF" not in plan
