"""Quality rules, line first: bad lines are removed, then documents that lose too much go.

Each ``\\n``-separated line with a word is judged on its own by rules on
punctuation, navigation and boilerplate; the lines that fail are removed. A
document is rejected if it fails the base rules (too short, or mostly repeated
word triples) or if the removed lines held too large a share of its word
characters. Only built-in expressions on the row itself: no shuffle, no Python.

Edge cases: a null or blank text has no words, fails the base rules and is not
kept; lines without a word are neither judged nor counted; texts of any length
are judged whole (the repeated-triple count sorts a text's triples once);
repeated rows are judged alike. Columns other than ``text`` are not read, and
``clean_documents`` changes ``text`` and ``n_chars`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import BLANKS, one_blank, split_words, text_or_empty, without

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST = 0.5
# Fixed values of the line rules; the patterns read alike in Java and RE2.
SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"
# punctuation: a line without a letter or digit, or with many runs of marks
NO_LETTERS = r"^[^\p{L}\p{N}]*$"
MARKS_RUN = r"[#*$%&<>!?]{2,}"
MAX_RUNS_PCT = 4  # per 100 word characters
# navigation: items between separators
SEPARATORS = "|\u00bb\u203a\u2022"
MAX_SEPARATORS_PCT = 4  # per 100 word characters
# boilerplate: stock phrases of web pages in four languages, lower case, letters and single spaces
BOILERPLATE = (
    "lorem ipsum", "javascript", "rights reserved", "cookie", "privacy policy", "terms of use", "newsletter",
    "terms of service", "subscribe to", "sign up for", "never miss", "click here", "read more", "share on", "follow us", "leave a comment",
    "rechte vorbehalten", "wir verwenden", "datenschutz", "nutzungsbedingungen", "hier klicken", "mehr erfahren", "teilen auf",
    "akzeptieren", "jetzt abonnieren", "droits réservés", "nous utilisons des", "politique de confidentialité", "cliquez ici",
    "en savoir plus", "partager sur", "abonnez vous", "derechos reservados", "utilizamos", "política de privacidad", "haga clic", "leer más",
    "compartir en", "suscríbete",
)
MAX_BOILERPLATE_PCT = 15  # per 100 word characters: a sentence that mentions a phrase is no boilerplate
# navigation: labels of menus in four languages
MENU_LABELS = (
    "home", "about", "about us", "contact", "contact us", "login", "log in", "logout", "register", "sign in", "sign up", "search", "menu",
    "imprint", "sitemap", "faq", "help", "startseite", "über uns", "kontakt", "anmelden", "registrieren", "suche", "impressum", "hilfe",
    "accueil", "à propos", "connexion", "inscription", "recherche", "aide", "plan du site", "inicio", "quiénes somos", "contacto",
    "iniciar sesión", "registrarse", "buscar", "ayuda",
)
MAX_LABELS_PCT = 60  # per 100 word characters


def whole_words(phrases: tuple[str, ...], plural: str = "") -> str:
    """The pattern of the phrases as whole words, in either case, longer ones first."""
    listed = "|".join(sorted(phrases, key=lambda p: (-len(p), p)))
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{listed}){plural}(?![\p{{L}}\p{{N}}])"


PHRASES = whole_words(BOILERPLATE, "s?")
LABELS = whole_words(MENU_LABELS)


def _has_separators(text: Column) -> Column:
    found = F.lit(False)
    for c in SEPARATORS:
        found = found | text.contains(c)
    return found


def _line_fails(line: Column, has: Column) -> Column:
    """Whether a line fails a rule. ``has`` says which rules can fire in its text at all."""
    chars = F.length(without(line, BLANKS))
    runs = 100 * F.regexp_count(line, F.lit(MARKS_RUN)) > MAX_RUNS_PCT * chars
    listed = 100 * (F.length(line) - F.length(without(line, SEPARATORS))) > MAX_SEPARATORS_PCT * chars
    share = lambda pattern: 100 * (chars - F.length(without(F.regexp_replace(line, pattern, ""), BLANKS)))
    return (
        line.rlike(NO_LETTERS) | (has["marks"] & runs) | (has["separators"] & listed)
        | (has["phrases"] & (share(PHRASES) > MAX_BOILERPLATE_PCT * chars)) | (has["labels"] & (share(LABELS) > MAX_LABELS_PCT * chars))
    )


def _word_chars(text: Column) -> Column:
    return F.length(without(text, BLANKS)).cast("long")


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _triple(w: Column, i: Column, join) -> Column:
    return join(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))


PLACE_BITS = 30  # a text has fewer than 2**30 words


def _repeat_words(w: Column, hashes: Column) -> Column:
    """Number of words inside word triples that occur at least twice.

    Hash bits and place of each triple, packed into one long, are sorted; those with
    a neighbour of the same bits are sorted again with their text, so that only equal
    triples count. The places left, in order, cover three words each, less overlaps.
    """
    packed = F.sort_array(F.transform(
        hashes, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, PLACE_BITS), PLACE_BITS).bitwiseOR(i.cast("long"))
    ))

    def near(packed: Column) -> Column:
        beside = lambda x, k: F.coalesce(
            F.shiftrightunsigned(x.bitwiseXOR(F.get(packed, k)), PLACE_BITS) == 0, F.lit(False)
        )
        return F.filter(packed, lambda x, k: beside(x, k - 1) | beside(x, k + 1))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("long")).cast("int")

    placed = F.sort_array(F.transform(_bind(packed, near), lambda x: F.struct(
        F.shiftrightunsigned(x, PLACE_BITS).alias("h"),
        _triple(w, place(x), lambda *t: F.concat_ws(" ", *t)).alias("t"), place(x).alias("i"),
    )))

    def repeated(placed: Column) -> Column:
        beside = lambda x, k: F.coalesce(
            (x["h"] == F.get(placed, k)["h"]) & (x["t"] == F.get(placed, k)["t"]), F.lit(False)
        )
        return F.transform(F.filter(placed, lambda x, k: beside(x, k - 1) | beside(x, k + 1)), lambda x: x["i"])

    covered = F.aggregate(
        F.sort_array(_bind(placed, repeated)),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return covered.cast("long")


def measures(documents: DataFrame) -> DataFrame:
    """``documents`` with one struct column ``quality``: the base measures, both verdicts
    and ``clean_text``, the text without its failed lines."""
    text = text_or_empty(F.col("text"))
    row = F.struct("*").alias("doc")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(HAS_WORD))
    out = documents.select(row, text.alias("text"), one_blank(F.col("text")).alias("blanked"), lines.alias("lines"))
    out = out.withColumn("w", split_words(F.col("blanked"))).withColumn(
        "word_chars", F.length(F.replace("blanked", F.lit(" "), F.lit(""))).cast("long")
    )
    out = out.withColumn("n_words", F.size("w").cast("long"))
    # Equal triples have equal hashes: a text whose hashes all differ has no repeats.
    out = out.withColumn("hashes", F.transform(
        F.slice("w", 1, F.greatest(F.lit(0), F.size("w") - 2)),
        lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)),
    ))
    out = out.withColumn(
        "n_repeat_words",
        F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _repeat_words(F.col("w"), F.col("hashes")))
        .otherwise(F.lit(0).cast("long")),
    )
    out = out.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")),
    )
    out = out.withColumn("has", F.struct(
        F.col("text").rlike(MARKS_RUN).alias("marks"), _has_separators(F.col("text")).alias("separators"),
        F.col("text").rlike(PHRASES).alias("phrases"), F.col("text").rlike(LABELS).alias("labels"),
    ))
    fails = lambda x: _line_fails(x, F.col("has"))
    out = out.withColumn("failed", F.transform("lines", fails))
    lost = F.aggregate(
        F.zip_with("lines", "failed", lambda x, bad: F.when(bad, _word_chars(x)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    out = out.withColumn("lost_chars", lost)
    clean = F.when(F.exists("failed", lambda x: x), F.array_join(
        F.filter(F.split("text", "\n", -1), lambda x: ~(x.rlike(HAS_WORD) & fails(x))), "\n"
    )).otherwise(F.col("text"))
    quality = F.struct(
        "n_words", "word_chars",
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "base_failed", "lost_chars",
        (~F.col("base_failed") & (F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))).alias("kept"),
        clean.alias("clean_text"),
    )
    return out.select("doc", quality.alias("quality"))


def clean_documents(documents: DataFrame) -> DataFrame:
    """The kept documents, with the columns of ``documents``; ``text`` without its failed lines."""
    # A filter pushed below the columns of measures() would repeat them once for each array element they are
    # used for; it is not pushed below a column that depends on the row's place.
    judged = measures(documents).select("doc", "quality", F.monotonically_increasing_id().alias("place"))
    kept = judged.filter((F.col("place") >= 0) & F.col("quality.kept")).select("doc", "quality.clean_text")
    new = {"text": F.col("clean_text")}
    if "n_chars" in documents.columns:
        new["n_chars"] = F.length("clean_text").cast(documents.schema["n_chars"].dataType)
    return kept.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in documents.columns])
