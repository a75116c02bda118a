from collections import Counter

from lakeops.llm import quality_rules
from tests.llm.helpers import ODD_TEXTS, documents, with_clashes, words


def _brute(text):
    w = words(text)
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(triples)
    covered = {p for i, t in enumerate(triples) if n[t] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
    )


def _measured(docs):
    return {r.doc.doc_id: r.quality for r in quality_rules.measures(docs).collect()}


def test_base_measures_equal_brute_force(spark):
    texts = ODD_TEXTS + [
        "a b c a b c d e f a b c", "a a a a a", "x y\nx y\n\nx y\r\nz", "# * $$ | < > &", "a b a b a b a c", "p q r s p q r t p q",
        "A b c a B c", "1 2 3 4 5 6 7 8 9 1 2 3",
    ]
    got = _measured(with_clashes(documents(spark, texts)))
    for i, t in enumerate(texts):
        q = got[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == _brute(t), t
        n, repeat = q.n_words, q.n_repeat_words
        assert q.base_failed == (n < 50 or 100 * repeat > 50 * n)


def test_lines_fail_by_rule_and_documents_by_loss(spark):
    good = [" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(8)]
    bad = ["Home | About us | Contact | Imprint", "BUY!! NOW!! CHEAP!! DEAL!!", "----------", "We use cookies on this site to serve you"]
    texts = [
        "\n".join(good), "\n".join([good[0], bad[0], *good[1:], bad[1]]), "\n".join(bad * 10 + good[:2]),
        "\n".join(good + bad), " ".join("w%d*** x%d$$$" % (i, i) for i in range(100)),
    ]
    docs = with_clashes(documents(spark, texts))
    got = _measured(docs)
    assert [got[i].kept for i in range(5)] == [True, True, False, True, False]
    assert got[0].clean_text == texts[0] and got[0].lost_chars == 0
    assert got[1].clean_text == "\n".join(good) and got[3].clean_text == "\n".join(good)
    kept = quality_rules.clean_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}[3] == ("\n".join(good), len("\n".join(good)))


def test_verdicts_on_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got, quality = _measured(docs), {r.doc_id: r.quality for r in labels.collect()}
    junk_kept = [i for i, q in quality.items() if q == 0 and got[i].kept]
    clean_lost = [i for i, q in quality.items() if q == 1 and not got[i].kept and not got[i].base_failed]
    assert junk_kept == [] and clean_lost == []


def test_no_python_and_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert quality_rules.clean_documents(docs).collect() == []
    plan = quality_rules.measures(spark.range(3).selectExpr("id as doc_id", "'a b' as text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_line_that_mentions_a_phrase_is_no_boilerplate(spark):
    prose = " ".join(f"word{i}x{j}" for i in range(6) for j in range(12))
    one_line = f"{prose} and the baker sold a cookie to everyone {prose[::-1]}"
    paragraph = "She wrote a small program in JavaScript to sort the letters of her grandmother by date and place."
    stock = ["All rights reserved.", "We use cookies on this site to serve you", "Please enable JavaScript", "Privacy Policy and Terms of Use"]
    inside = "Javascripted cookielike"  # no phrase as a word of its own
    got = _measured(documents(spark, [one_line, "\n".join([prose, paragraph, inside, *stock])]))
    assert got[0].kept and got[0].clean_text == one_line and got[0].lost_chars == 0
    assert got[1].kept and got[1].clean_text == "\n".join([prose, paragraph, inside])


STOCK = [
    "Home About Contact Login Register", "Startseite Über uns Kontakt Impressum", "Accueil Contact Connexion", "Inicio Buscar Ayuda",
    "Alle Rechte vorbehalten.", "Wir verwenden Cookies, um Ihnen das beste Erlebnis zu bieten. Akzeptieren", "Tous droits réservés",
    "Todos los derechos reservados", "Subscribe to our newsletter and never miss a post again, it is free",
    "Click here to read more", "Share on Facebook", "cookie cookie,cookie", "READ  more, Read more!", "a » b » c", "*** !! ??", "-----",
]
PROSE_LINES = [
    "She went home and told them about the search for a new contact in the town beyond the hills.",
    "Der Bäcker hat seine Rechte vorbehaltlos verkauft, und niemand im Dorf hat es ihm geglaubt.",
    "cookielike xjavascript newsletters2 contactor", "Homer aboutx Contacts", "Read  more", "The help he sought never came.",
]


def test_line_rules_of_four_languages_equal_the_sql(spark):
    import duckdb

    from lakeops.llm.queries import QUALITY_SQL

    prose = " ".join(f"word{i}x{j}" for i in range(6) for j in range(12))
    texts = [f"{line}\n{prose}" for line in STOCK + PROSE_LINES]
    # each line alone decides the verdict of one more document: it is longer than the rest or not
    texts += [f"{(line + ' ') * 30}\n{prose[:300]}" for line in STOCK + PROSE_LINES] + ODD_TEXTS
    got = _measured(with_clashes(documents(spark, texts)))
    for i, line in enumerate(STOCK + PROSE_LINES):
        assert (got[i].clean_text == prose) == (line in STOCK), line
    con = duckdb.connect()
    con.register("documents", documents(spark, texts).toPandas())
    want = {r[0]: r[1:] for r in con.execute(
        f"select doc_id, kept, n_words, n_dup_lines, n_repeat_words, base_failed from ({QUALITY_SQL})"
    ).fetchall()}
    assert {i: (q.kept, q.n_words, q.n_dup_lines, q.n_repeat_words, q.base_failed) for i, q in got.items()} == want
    # the share of lost characters itself, not only the verdicts it leads to
    lost = {r[0]: r[1] for r in con.execute(
        QUALITY_SQL[: QUALITY_SQL.index("judged as")].rstrip().rstrip(",") + " select doc_id, lost_chars from base"
    ).fetchall()}
    assert {i: q.lost_chars for i, q in got.items()} == lost
