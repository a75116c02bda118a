"""Surrogates for personal data: keyed, type-consistent, distinct and coreferent.

Detected entities are e-mail and IP addresses, phone, card, account and social
security numbers, secrets, and names: up to three capitalized words behind a title and its particles, and every later or earlier
whole-word mention of them in the same text, also in capitals. A mention without a title, or behind a neutral one, takes
the gender the other titles of its text give the name. Of a run of over 64 characters before an @, the last 64 at most are
the address; a run of digits alone is no secret beyond 512. An entity's canonical form (case and separators
removed, an IPv6 address written out) decides its surrogate, so all mentions of one entity, in any format,
get the same one. A surrogate keeps the shape: every digit, letter case and script
stays, separators stay where the mention has them, hexadecimal stays hexadecimal, a
card number keeps its Luhn remainder, an address keeps its top-level domain, a name is
made of syllables of the same script with an ending of the title's gender.

The registry of all distinct entities is built with a grouped aggregation. Each entity
draws a keyed surrogate; where two entities draw the same one, or one draws a string that
is itself an entity of the corpus, all but one of them draw again until none are left. So
distinct entities stay distinct and no surrogate is the real data of any entity found.

DataFrame expressions only. Texts without a match never leave their task; the others are
split at their matches and joined back with the surrogates by row content. A value
of any frequency is one registry row, and the join on it is left to skew splitting.

Edge cases: null and empty texts are returned as they are; repeated rows get equal
results; texts are searched whole; columns other than ``text`` (and ``n_chars``, which
follows it) are returned unchanged whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import stash

KEY = "surrogates-1"

# Patterns of the entities and titles of address.
MALE = ("Mr", "Herr", "Señor", "Sr", "Don", "Monsieur", "господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Doña", "Madame", "Mme", "Mlle", "госпожа", "г-жа")
NEUTRAL = ("Dr", "Prof")
TITLES = "|".join(MALE + FEMALE + NEUTRAL)
NOT_BEFORE, NOT_AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
LOCAL = r"[\p{L}\p{N}._%+\-]"  # a run of these is tried once, from its start: long words stay linear
DOMAIN = r"(?:[\p{L}\p{N}\-]++\.){1,30}\p{L}{2,}"
EMAIL = rf"(?<!{LOCAL}){LOCAL}{{1,64}}+@{DOMAIN}|(?<={LOCAL})[\p{{L}}\p{{N}}]{LOCAL}{{0,63}}+@{DOMAIN}"
IP4 = rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)"
GROUP = "[0-9a-fA-F]{1,4}"
SHORT6 = rf"(?=[a-fA-F:]*+[0-9])(?!:*+(?:{GROUP}:++){{7}}{GROUP})(?:{GROUP}(?::{GROUP}){{0,6}})?::(?:{GROUP}(?::{GROUP}){{0,6}})?"
IP6 = rf"(?<![\p{{L}}\p{{N}}:])(?:(?:{GROUP}:){{7}}{GROUP}|{SHORT6})(?!:?[\p{{L}}\p{{N}}]|::|\.\d)"
HEX = r"[0-9]{32,512}+|(?=[0-9]*+[a-f])[0-9a-f]{32,}+|(?=[0-9]*+[A-F])[0-9A-F]{32,}+"
SECRET = rf"{NOT_BEFORE}(?:(?:sk|pk|ghp|gho|xox[abp])[_\-][A-Za-z0-9_\-]{{16,}}|AKIA[0-9A-Z]{{16}}|{HEX}){NOT_AFTER}"
ACCOUNT = rf"{NOT_BEFORE}[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{NOT_AFTER}"
CARD = rf"{NOT_BEFORE}(?:\d{{13,19}}|\d{{4}}(?:[ \-]\d{{4}}){{3}}){NOT_AFTER}"
SSN = rf"{NOT_BEFORE}\d{{3}}-\d{{2}}-\d{{4}}{NOT_AFTER}"
PHONE = rf"(?:\+\d{{1,3}}[ .\-]?)?(?:\(\d{{2,4}}\)|{NOT_BEFORE}\d{{3}})[ .\-]?\d{{3}}[ .\-]\d{{4}}{NOT_AFTER}|\+\d{{1,3}}(?:[ .\-]?\d{{2,4}}){{2,5}}{NOT_AFTER}"
NUMBERS = "|".join((EMAIL, IP4, IP6, SECRET, CARD, SSN, PHONE, ACCOUNT))
GIVEN = r"(?:\p{L}['’])?\p{Lu}[\p{L}\-]{1,29}"
PARTICLE = "(?:von|van|der|den|de|la|del|di|da|du|le) "
PARTICLES = f"(?:{PARTICLE}(?:{PARTICLE})?)?"  # two at most; a look-behind takes no counted group
BEFORE_NAME = rf"(?:{TITLES})\.? {PARTICLES}"
# a capitalized word right behind a title, or behind a title and one or two more such words
NAME = "|".join(rf"{NOT_BEFORE}{GIVEN}(?<={BEFORE_NAME}{f'{GIVEN} ' * more}{GIVEN})" for more in range(3))
HAS_TITLE = rf"{NOT_BEFORE}{BEFORE_NAME}(?:\p{{L}}['’])?\p{{Lu}}"
MAY_MATCH = r"[0-9@]|[a-f]{32}|[A-F]{32}|AKIA[A-Z]{16}|[_\-][A-Za-z_\-]{16}"

CYRILLIC, GREEK = "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνοπρστυφχψω"
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ka ke la le li lo ma me mi mo na ne ni no ra re ri ro sa se ta te".split(),
    "cyrillic": "ба бе бо да де до фа фе га ге ка ке ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се та те".split(),
    "greek": "βα βε βο δα δε δο φα φε γα γε κα κε λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε τα τε".split(),
}
ENDINGS = {
    ("latin", "m"): "n", ("latin", "f"): "na", ("latin", "x"): "l",
    ("cyrillic", "m"): "в", ("cyrillic", "f"): "ва", ("cyrillic", "x"): "к",
    ("greek", "m"): "ς", ("greek", "f"): "ου", ("greek", "x"): "ρ",
}


def _pattern_matches(text: Column, split: bool) -> Column:
    """Matches of a text, or the pieces around them (one more than matches)."""
    cut = (lambda p: F.split(text, p, -1)) if split else (lambda p: F.regexp_extract_all(text, p, F.lit(0)))
    return F.when(text.rlike(HAS_TITLE), cut(_with_names(text))).otherwise(cut(F.lit(NUMBERS)))


def _with_names(text: Column) -> Column:
    """The pattern of a text: numbers, names behind titles, and these names (letters, dashes, apostrophes) anywhere."""
    names = F.array_distinct(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)))
    forms = F.array_union(names, F.transform(names, F.upper))
    longer_first = F.reverse(F.sort_array(F.transform(forms, lambda n: F.struct(F.length(n).alias("length"), n.alias("name")))))
    anywhere = F.concat(F.lit(f"|{NOT_BEFORE}(?:"), F.array_join(longer_first["name"], "|"), F.lit(f"){NOT_AFTER}"))
    return F.concat(F.lit(f"{NUMBERS}|{NAME}"), F.when(F.size(names) > 0, anywhere).otherwise(""))


def _kind(mention: Column) -> Column:
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    return (
        F.when(mention.contains("@"), "email").when(whole(IP4), "ip4").when(whole(IP6), "ip6").when(whole(CARD), "card")
        .when(whole(SSN), "ssn").when(whole(r"[0-9a-f]{32,}|[0-9A-F]{32,}"), "hex").when(whole(SECRET), "secret")
        .when(whole(PHONE), "phone").when(whole(ACCOUNT), "account").otherwise("name")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _written_out(address: Column) -> Column:
    """An IPv6 address with all eight groups of four digits."""
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    left, right = groups(F.substring_index(address, "::", 1)), groups(F.substring_index(address, "::", -1))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
    all_groups = F.when(address.contains("::"), F.concat(left, zeros, right)).otherwise(F.split(address, ":"))
    return F.array_join(F.transform(all_groups, lambda g: F.lpad(g, 4, "0")), ":")


def _canonical(mention: Column, kind: Column) -> Column:
    return (
        F.when(kind == "email", F.lower(mention)).when(kind == "ip6", _written_out(F.lower(mention)))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, r"\D", ""))
        .when(kind == "account", F.replace(mention, F.lit(" "), F.lit("")))
        .when(kind == "name", F.concat(F.upper(F.substring(mention, 1, 1)), F.lower(F.substring(mention, 2, 1 << 20))))
        .otherwise(mention)
    )


def _gender(parts: Column, i: Column) -> Column:
    """Gender of the title before mention i, which may stand before two more names; "?" without a title."""
    between = f"^ {PARTICLES}$"
    before = F.get(parts, i)
    for back in (1, 2):
        before = F.when(before.rlike(between) & (i >= back), F.get(parts, i - back)).otherwise(before)
    ends = lambda titles: before.rlike(rf"{NOT_BEFORE}(?:{'|'.join(titles)})\.? {PARTICLES}$")
    return F.when(ends(FEMALE), "f").when(ends(NEUTRAL), "x").when(ends(MALE), "m").otherwise("?")


def _mentions(texts: DataFrame) -> DataFrame:
    """``texts`` (row_key, parts, found) to one row per mention: row_key, i, kind, canonical, mention."""
    rows = texts.select("row_key", "parts", F.posexplode("found").alias("i", "mention"))
    rows = rows.withColumn("kind", _kind(F.col("mention")))
    is_name = F.col("kind") == "name"
    rows = rows.select(
        "row_key", "i", "kind", _canonical(F.col("mention"), F.col("kind")).alias("canonical"), "mention",
        F.when(is_name, _gender(F.col("parts"), F.col("i"))).alias("gender"),
    )
    rows = stash(rows, "pii-found")
    others = rows.filter(~is_name).select("row_key", "i", "kind", "canonical", "mention")
    # what the titles of a text say of a name; where they differ, mentions without one are of neither gender
    told = rows.filter(is_name).groupBy("row_key", "canonical").agg(
        F.max(F.when(F.col("gender") == "f", 1).otherwise(0)).alias("f"), F.max(F.when(F.col("gender") == "m", 1).otherwise(0)).alias("m")
    )
    gender = F.when(F.col("gender").isin("f", "m"), F.col("gender")).when(F.col("f") > F.col("m"), "f").when(
        F.col("m") > F.col("f"), "m"
    ).otherwise("x")
    names = rows.filter(is_name).join(told, ["row_key", "canonical"]).select(
        "row_key", "i", F.concat_ws(":", F.lit("name"), gender, _script(F.col("mention"))).alias("kind"), "canonical", "mention"
    )
    return others.union(names)


def _draw(chars: Column, hashed, low: str) -> Column:
    """A character of the same class for every character, chosen by ``hashed(i)``."""
    pick = lambda alphabet, i: F.substr(F.lit(alphabet), (hashed(i) % len(alphabet) + 1).cast("int"), F.lit(1))
    upper = low.upper()
    own_case = lambda c, drawn: F.when(c.rlike(r"\p{Lu}"), F.upper(drawn)).otherwise(drawn)

    def draw(c: Column, i: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), pick("0123456789", i))
            .when(c.rlike(r"\p{IsCyrillic}"), own_case(c, pick(CYRILLIC, i))).when(c.rlike(r"\p{IsGreek}"), own_case(c, pick(GREEK, i)))
            .when(c.rlike(r"\p{Lu}"), pick(upper, i))
            .when(c.rlike(r"\p{L}"), pick(low, i)).otherwise(c)
        )

    return F.array_join(F.transform(chars, draw), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, modulo 10."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, 2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
    ).otherwise(d.cast("int")))
    return F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda a, x: a + x) % 10


def _candidate(attempt: int, key: str) -> Column:
    """The surrogate (in canonical form) that entity (kind, canonical) draws at ``attempt``."""
    value = F.col("canonical")
    # a long value counts by its hash: it is hashed again for each of its characters
    seed = F.concat_ws(":", F.lit(key), F.lit(str(attempt)), "kind", F.when(F.length(value) > 512, F.sha2(value, 256)).otherwise(value))

    def hashed(i: Column) -> Column:
        """Eight hexadecimal digits of hash for each character, 16 characters to a hash."""
        block = F.sha2(F.concat_ws(":", seed, F.floor(i / 16).cast("int")), 512)
        return F.conv(F.substr(block, (8 * (i % 16) + 1).cast("int"), F.lit(8)), 16, 10).cast("long")

    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    letters = "abcdefghijklmnopqrstuvwxyz"
    shaped = _draw(chars(value), hashed, letters)
    hexed = _draw(chars(value), hashed, "abcdef")

    top = F.substring_index(value, ".", -1)
    rest = F.substr(value, F.lit(1), F.length(value) - F.length(top) - 1)
    more = "" if attempt == 0 else f"{attempt}"
    local = F.substring_index(_draw(chars(rest), hashed, letters), "@", 1)
    email = F.concat(local, F.lit(more), F.lit("@"), F.substring_index(_draw(chars(rest), hashed, letters), "@", -1), F.lit("."), top)

    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (hashed(i) % 223 + 1).cast("string")), ".")

    swap = ((F.lit(10) + _luhn(value) - _luhn(F.concat(F.substr(shaped, F.lit(1), F.length(shaped) - 1), F.lit("0")))) % 10)
    card = F.concat(F.substr(shaped, F.lit(1), F.length(shaped) - 1), swap.cast("string"))

    def name(script: str) -> Column:
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        count = 3 + attempt
        body = F.array_join(F.transform(
            F.sequence(F.lit(0), F.lit(count - 1)),
            lambda i: F.get(syllables, (F.conv(F.substr(F.sha2(F.concat_ws(":", seed, F.lit("syllable"), i), 256), F.lit(1), F.lit(8)), 16, 10).cast("long") % 32).cast("int")),
        ), "")
        gender = F.split("kind", ":")[1]
        ending = reduce(lambda c, g: c.when(gender == g, ENDINGS[script, g]), ("f", "x"), F.when(gender == "m", ENDINGS[script, "m"]))
        return F.initcap(F.concat(body, ending))

    return (
        F.when(F.col("kind") == "email", email).when(F.col("kind") == "ip4", octets).when(F.col("kind") == "card", card)
        .when(F.col("kind").isin("ip6", "hex"), hexed).when(F.col("kind").endswith(":cyrillic"), name("cyrillic"))
        .when(F.col("kind").endswith(":greek"), name("greek")).when(F.col("kind").startswith("name:"), name("latin"))
        .otherwise(shaped)
    )


def _spread(kind: Column) -> Column:
    """Names share one space of surrogates, whatever their gender or script."""
    return F.substring_index(kind, ":", 1)


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canonical, surrogate) for distinct ``entities`` (kind, canonical).

    No two entities of a kind share a surrogate and none is an entity itself.
    """
    real = entities.select(_spread(F.col("kind")).alias("space"), F.col("canonical").alias("drawn")).distinct()
    done, pending, attempt = None, entities, 0
    while True:
        drawn = stash(
            pending.select("kind", "canonical", _spread(F.col("kind")).alias("space"), _candidate(attempt, key).alias("drawn")),
            "pii-drawn",
        )
        first = drawn.groupBy("space", "drawn").agg(F.min(F.struct("canonical", "kind")).alias("first"))
        free = first.join(real, ["space", "drawn"], "left_anti")
        if done is not None:
            free = free.join(done.select(_spread(F.col("kind")).alias("space"), F.col("surrogate").alias("drawn")), ["space", "drawn"], "left_anti")
        won = stash(free.select(F.col("first.kind").alias("kind"), F.col("first.canonical").alias("canonical"), F.col("drawn").alias("surrogate")), "pii-won")
        done = won if done is None else done.union(won)
        pending = drawn.select("kind", "canonical").join(won, ["kind", "canonical"], "left_anti")
        if pending.isEmpty():
            return done
        pending, attempt = stash(pending, "pii-pending"), attempt + 1


def _in_format(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate with the separators and case of the mention."""
    chars = F.filter(F.split(mention, ""), lambda x: x != "")
    digits = F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike("[0-9A-Z]"),
        F.substr(surrogate, F.length(F.regexp_replace(F.substr(mention, F.lit(1), (i + 1).cast("int")), "[^0-9A-Z]", "")), F.lit(1)),
    ).otherwise(c)), "")
    upper = (F.upper(mention) == mention) & (F.lower(mention) != mention)
    return F.when(kind.isin("phone", "card", "ssn", "account"), digits).when(
        upper & (kind.isin("email", "ip6") | kind.startswith("name:")), F.upper(surrogate)
    ).otherwise(surrogate)


def with_surrogates(documents: DataFrame, key: str = KEY) -> DataFrame:
    """(doc, new_text, n_entities): each row of ``documents`` as a struct, its text with surrogates and their number."""
    rows = documents.select(F.struct("*").alias("doc"), F.col("text").alias("text"))
    may = F.coalesce(F.col("text").rlike(MAY_MATCH) | F.col("text").rlike(HAS_TITLE), F.lit(False))
    rows = rows.withColumn("found", F.when(may, _pattern_matches(F.col("text"), False)))
    has = F.coalesce(F.size("found"), F.lit(0)) > 0
    plain = rows.filter(~has).select("doc", F.col("text").alias("new_text"), F.lit(0).cast("long").alias("n_entities"))
    touched = rows.filter(has).select(
        "doc", "found", F.sha2("text", 256).alias("row_key"), _pattern_matches(F.col("text"), True).alias("parts")
    )
    mentions = stash(_mentions(touched), "pii-mentions")
    mapping = surrogates(stash(mentions.select("kind", "canonical").distinct(), "pii-entities"), key)
    placed = mentions.join(mapping, ["kind", "canonical"]).select(
        "row_key", F.struct("i", _in_format(F.col("mention"), F.col("kind"), F.col("surrogate")).alias("s")).alias("x")
    )
    by_row = placed.groupBy("row_key").agg(F.sort_array(F.collect_set("x")).alias("xs"))
    text = F.array_join(F.zip_with("parts", F.concat(F.col("xs")["s"], F.array(F.lit(""))), lambda p, s: F.concat(p, s)), "")
    replaced = touched.drop("found").join(by_row, "row_key").select(
        "doc", text.alias("new_text"), F.size("xs").cast("long").alias("n_entities")
    )
    return plain.union(replaced)


def replace_private(documents: DataFrame, key: str = KEY) -> DataFrame:
    """``documents`` with surrogates in ``text``; ``n_chars`` follows where there is one."""
    new = {"text": F.col("new_text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("n_entities") > 0, F.length("new_text").cast(kind)).otherwise(F.col("doc")["n_chars"])
    return with_surrogates(documents, key).select(*[new.get(c, F.col("doc")[c]).alias(c) for c in documents.columns])
