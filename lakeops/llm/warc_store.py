"""WARC records in a content-addressed archive.

An archive is a folder with two Parquet tables. ``payloads`` holds every distinct
payload once, under its SHA-256; ``records`` holds the exact header bytes of every
record with the address of its payload. A record's bytes come back by joining the
two. Reading recomputes the SHA-256 and SHA-1 of every stored payload; where they differ
from the address or from the digest in the record's headers, or a payload is missing, each
of the columns that stem from the payload raises. The header columns alone read no payload.

Of the records with equal payloads the one with the largest ``page_id`` is the
response; the others are revisits that refer to it. Which record that is comes from a
grouped maximum over digests, and the payload to store from a join on (page_id,
digest), so a payload shared by any number of pages is neither shuffled more than
once nor gathered in one task.

Edge cases: a null ``html`` is an empty payload; with ``min_bytes`` smaller payloads
are all responses, still stored once; a null ``page_id`` counts as smaller than any
other; rows that repeat the response's ``page_id`` and payload are responses too; a
null ``url`` leaves out the target header, and line breaks in one are percent-encoded.
Columns other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import stash

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_DATE = "1970-01-01T00:00:00Z"  # the pages carry no date
LINE = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: eight characters for each 40 bits."""
    hexed = F.sha1(payload)
    part = lambda i: F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*[part(i) for i in range(4)]), DIGITS32, BASE32)


def _payload(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def _record_id(page_id: Column, address: Column) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), F.substring(address, 1, 16), F.lit(">")
    )


def _headers() -> Column:
    """The WARC header block of a record and, behind the empty line, its HTTP header block."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        F.col("n_bytes").cast("string"), F.lit(LINE + LINE),
    )
    revisit = F.col("record_type") == "revisit"
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.octet_length(http) + F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("n_bytes"))
    lines = F.concat_ws(
        LINE,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("address"))),
        F.lit(f"WARC-Date: {CAPTURE_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("response_id"), F.col("address")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    )
    return F.encode(F.concat(lines, F.lit(LINE + LINE), http), "UTF-8")


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to the archive ``folder``."""
    payload = _payload(F.col("html"))
    facts = stash(
        pages.select(
            F.col("page_id").cast("long").alias("page_id"), "url", F.sha2(payload, 256).alias("address"),
            base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n_bytes"),
        ),
        "warc-facts",
    )
    copies = facts.groupBy("address", "page_id").agg(F.count("*").alias("rows"))
    largest = F.max(F.struct(F.col("page_id").isNotNull().alias("named"), "page_id", "rows"))
    responses = stash(
        copies.groupBy("address").agg(largest.alias("r")).select(
            "address", F.col("r.page_id").alias("response_id"), F.col("r.rows").alias("rows")
        ),
        "warc-responses",
    )
    record_type = F.when(
        (F.col("n_bytes") < min_bytes) | F.col("page_id").eqNullSafe(F.col("response_id")), "response"
    ).otherwise("revisit")
    facts.join(responses.drop("rows"), "address").withColumn("record_type", record_type).select(
        "address", _headers().alias("headers")
    ).write.parquet(f"{folder}/records")

    stored = pages.select(F.col("page_id").cast("long").alias("page_id"), payload.alias("payload")).withColumn(
        "own_address", F.sha2("payload", 256)
    )
    mine = F.col("page_id").eqNullSafe(F.col("response_id")) & (F.col("own_address") == F.col("address"))
    chosen = stored.join(responses.hint("shuffle_hash"), mine).select("address", "rows", "payload")
    single = chosen.filter("rows = 1").drop("rows")
    single.write.parquet(f"{folder}/payloads")
    if not responses.filter("rows > 1").isEmpty():  # rows that repeat a response: one of their equal payloads
        chosen.filter("rows > 1").groupBy("address").agg(F.first("payload").alias("payload")).write.mode("append").parquet(
            f"{folder}/payloads"
        )


def _header(name: str) -> Column:
    value = F.regexp_extract("head", rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(value != "", value)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: what its headers say, its verified payload, and its whole bytes as ``record``.

    A payload's digests are recomputed before the join, so a query that needs no
    payload bytes does not move them.
    """
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "address", "payload", F.sha2("payload", 256).alias("found"), base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    records = spark.read.parquet(f"{folder}/records").withColumn("head", F.decode("headers", "UTF-8"))
    out = records.join(payloads, "address", "left")
    page = rf"<urn:page:(-?\d+):"
    digest = F.regexp_extract(_header("WARC-Payload-Digest"), "sha1:(.*)", 1)
    intact = F.coalesce((F.col("found") == F.col("address")) & (F.col("sha1") == digest), F.lit(False))
    number = lambda h: F.regexp_extract(_header(h), page, 1).try_cast("long")
    body = F.when(_header("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    damaged = F.raise_error(F.concat(F.lit("damaged payload "), "address"))
    checked = lambda c: F.when(intact, c).otherwise(damaged)
    return out.select(
        number("WARC-Record-ID").alias("page_id"),
        _header("WARC-Target-URI").alias("url"),
        _header("WARC-Type").alias("record_type"),
        checked(digest).alias("payload_digest"),
        checked(F.col("payload_bytes")).alias("payload_bytes"),
        number("WARC-Refers-To").alias("refers_to"),
        checked(F.col("payload")).alias("payload"),
        checked(F.concat("headers", body, F.lit((LINE + LINE).encode()))).alias("record"),
    )
