"""One registered query per operator, over its whole table, with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm import (
    ann_forest,
    html_extract,
    mixing,
    pii_surrogates,
    quality_rules,
    secret_scan,
    sentencepiece_nbest,
    simhash,
    token_alignment,
    token_count,
    toxicity,
    warc_store,
    whitening,
)
from lakeops.llm.common import WORD, ship_package
from lakeops.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _settle_sql(step: int) -> str:
    before = "first" if step == 0 else f"inside{step}"
    table = "cut_docs" if step == 0 else f"settled{step}"
    return f"""
gaps{step} as (
  select *, room - coalesce(sum(case when {before} then size end) over (partition by skey, block), 0) as gap{step}
  from {table}
),
offs{step} as (
  select *, abs(abs(gap{step}) - size) as off{step},
    ({before} = (gap{step} < 0)) and abs(abs(gap{step}) - size) < abs(gap{step}) as usable{step} from gaps{step}
),
settled{step + 1} as (
  select *, {before} != coalesce(usable{step} and row_number() over (
    partition by skey, block, usable{step} order by off{step}, key) = 1, false) as inside{step + 1} from offs{step}
),"""


MIXING_SQL = f"""
with docs as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
    coalesce('s:' || source, 'n') as skey, md5('{mixing.SEED}:' || coalesce(doc_id::varchar, '')) as key
  from documents
),
per_source as (select skey, any_value(source) as source, sum(size)::bigint as source_size from docs group by skey),
weighted as (
  select *, (1 + idx % 3)::double as w, source_size * 3::double as most
  from (select *, row_number() over (order by source is null, source) - 1 as idx from per_source)
),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(most) over filled, 0::double))
    / (sum(w) over () - coalesce(sum(w) over filled, 0::double)) as level
  from weighted
  window filled as (order by most / w, idx rows between unbounded preceding and 1 preceding)
),
targets as (
  select skey, idx, source_size, least(most, max(level) over () * w) as target,
    greatest({mixing.BLOCK_WORDS}, ceil(sum(source_size) over () / {mixing.MAX_BLOCKS}::double)) as width
  from levels
),
sources as (
  select *, target - epochs * source_size as rest, greatest(1, ceil(source_size / width))::bigint as n_blocks
  from (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as epochs from targets)
),
dealt as (
  select d.*, s.source_size, s.target, s.epochs, s.rest, ('0x' || substr(key, 1, 8))::bigint % n_blocks as block
  from docs d join sources s using (skey)
),
blocks as (
  select *, md5(concat_ws(':', '{mixing.SEED}', 'pass', epochs, skey, block)) as turn
  from (select skey, block, any_value(epochs) as epochs, any_value(rest) as rest, sum(size)::bigint as words
        from dealt group by skey, block)
),
rooms as (
  select *, rest - (sum(words) over (partition by skey order by turn, block rows unbounded preceding) - words) as room
  from blocks
),
marked as (select skey, block, room, room > 0 and room < words as cut from rooms),
cut_docs as (
  select *, cum - size / 2::double <= room as first from (
    select *, sum(size) over (partition by skey, block order by key rows unbounded preceding) as cum from (
      select skey, block, key, sum(size)::bigint as size, any_value(room) as room
      from dealt join marked using (skey, block) where cut group by skey, block, key))
),{"".join(_settle_sql(i) for i in range(mixing.SETTLE_STEPS))}
members as (select skey, block, key, inside{mixing.SETTLE_STEPS} as inside from settled{mixing.SETTLE_STEPS})
select doc_id, size, source_size, target,
  (size * (epochs + case when room > 0 and (not cut or inside) then 1 else 0 end))::bigint as taken
from dealt join marked using (skey, block) left join members using (skey, block, key)
"""


@_query("op1_mix_sources", MIXING_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_table(spark, sf_dir, "documents")).drop("draws")


@_query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"))


@_query("op3_sentencepiece_nbest")
def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The N best paths per document: piece counts, scores, a hash of the ids of each, and the round trip."""
    out = sentencepiece_nbest.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc.doc_id", "encoded.*").select(
        "doc_id",
        F.transform("paths", lambda p: F.size(p["ids"])).alias("n_pieces"),
        F.transform("paths", lambda p: p["score"]).alias("scores"),
        F.transform("paths", lambda p: F.hex(F.xxhash64(p["ids"]))).alias("ids_hash"),
        "round_trip",
    )


def _phrase_chars_sql(x: str, phrases: tuple[str, ...], plural: str = "") -> str:
    """Word characters of ``x`` in whole phrases. Marks and blanks are doubled first, so that each phrase has a bound of its own."""
    listed = "|".join(sorted(phrases, key=lambda p: (-len(p), p))).replace(" ", "  ")
    doubled = f"regexp_replace({x}, '([^\\p{{L}}\\p{{N}}])', '\\1\\1', 'g')"
    cut = f"regexp_replace({doubled}, '(?i)(^|[^\\p{{L}}\\p{{N}}])(?:{listed}){plural}($|[^\\p{{L}}\\p{{N}}])', '\\1\\2', 'g')"
    count = lambda t: f"length(regexp_replace({t}, '[\\x20\\x09-\\x0D]', '', 'g'))"
    return f"({count(doubled)} - {count(cut)})"


def _failed_line_sql(x: str) -> str:
    chars = f"length(regexp_replace({x}, '[\\x20\\x09-\\x0D]', '', 'g'))"
    return (
        f"regexp_matches({x}, '{quality_rules.NO_LETTERS}')"
        f" or 100 * len(regexp_extract_all({x}, '{quality_rules.MARKS_RUN}')) > {quality_rules.MAX_RUNS_PCT} * {chars}"
        f" or 100 * (length({x}) - length(translate({x}, '{quality_rules.SEPARATORS}', '')))"
        f" > {quality_rules.MAX_SEPARATORS_PCT} * {chars}"
        f" or 100 * {_phrase_chars_sql(x, quality_rules.BOILERPLATE, 's?')} > {quality_rules.MAX_BOILERPLATE_PCT} * {chars}"
        f" or 100 * {_phrase_chars_sql(x, quality_rules.MENU_LABELS)} > {quality_rules.MAX_LABELS_PCT} * {chars}"
    )


QUALITY_SQL = f"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{quality_rules.HAS_WORD}')) as lines
  from documents
),
triples as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t
  from (select r, w, unnest(range(1, len(w) - 1)) as i from docs)
),
places as (
  select r, i from (select r, i, count(*) over (partition by r, t) as n from triples) where n > 1
),
repeats as (
  select r, count(distinct p)::bigint as n_repeat_words from (select r, unnest([i, i + 1, i + 2]) as p from places) group by r
),
base as (
  select r, doc_id, len(w)::bigint as n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
    (length(text) - length(translate(text, '{quality_rules.SYMBOLS}', '')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(list_sum(list_transform(list_filter(lines, lambda x: {_failed_line_sql("x")}),
      lambda x: length(regexp_replace(x, '[\\x20\\x09-\\x0D]', '', 'g')))), 0) as lost_chars
  from docs left join repeats using (r)
),
judged as (
  select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PCT} * n_words as base_failed
  from base
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and lost_chars <= {quality_rules.MAX_LOST}::double * word_chars as kept
from judged
"""


@_query("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.measures(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc.doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines",
        "quality.n_repeat_words", "quality.base_failed", "quality.kept",
    )


@_query("op5_ann_forest")
def op5_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


BASE32_SQL = "concat(" + ", ".join(
    f"to_base(('0x' || substr(sha1(payload), {10 * i + 1}, 10))::bigint, 32, 8)" for i in range(4)
) + ")"
WARC_SQL = f"""
with facts as (
  select page_id, octet_length(encode(payload))::bigint as payload_bytes,
    translate({BASE32_SQL}, '{warc_store.DIGITS32}', '{warc_store.BASE32}') as payload_digest,
    max(page_id) over (partition by payload) as response_id
  from (select page_id, coalesce(html, '') as payload from pages)
)
select page_id, payload_bytes, payload_digest,
  case when page_id = response_id then 'response' else 'revisit' end as record_type,
  case when page_id <> response_id then response_id end as refers_to
from facts
"""


@_query("op8_warc_archive", WARC_SQL)
def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    warc_store.write_archive(_table(spark, sf_dir, "pages"), folder)
    return warc_store.read_archive(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


@_query("op10_pii_surrogates")
def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_surrogates.with_surrogates(_table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", F.col("new_text").alias("text"), "n_entities")


@_query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_support(_table(spark, sf_dir, "documents"))


@_query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's ``deviation`` is a long: null where the exact value does not fit one."""
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


@_query("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = ("assign", "access", "hex")
    out = secret_scan.find_secrets(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        *[F.size(secret_scan.of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in known],
        F.sha2(secret_scan.joined(secret_scan.of_kinds(F.col("spans"), known)), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )
