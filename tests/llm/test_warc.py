import base64
import hashlib

import pytest

from lakeops.llm import warc_store
from lakeops.session import scratch_dir

PAGES = "page_id long, url string, html string, address string, rows long"


def _pages(spark, rows):
    return spark.createDataFrame([(p, u, h, "x", 1) for p, u, h in rows], PAGES)


ROWS = [
    (1, "http://a/", "<p>same</p>"), (5, "http://b/", "<p>same</p>"), (3, "http://c/\r\nX: y", "<p>same</p>"), (4, None, None),
    (9, "u", ""), (6, "é", "é漢\r\n\r\n"), (None, "n", "<p>same</p>"), (None, "m", "alone"), (7, "t", "twice"), (7, "t", "twice"),
]


def test_records_round_trip(spark):
    folder = scratch_dir(spark, "t-warc")
    warc_store.write_archive(_pages(spark, ROWS), folder)
    back = warc_store.read_archive(spark, folder).collect()
    payload = [(h or "").encode() for _, _, h in ROWS]
    assert sorted(((r.page_id, bytes(r.payload)) for r in back), key=repr) == sorted(((p, b) for (p, _, _), b in zip(ROWS, payload)), key=repr)
    assert spark.read.parquet(f"{folder}/payloads").count() == len(set(payload))
    for r in back:
        body = bytes(r.payload)
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        largest = max((p for (p, _, h) in ROWS if (h or "").encode() == body and p is not None), default=None)
        if r.page_id == largest:
            assert (r.record_type, r.refers_to) == ("response", None)
        else:
            assert (r.record_type, r.refers_to) == ("revisit", largest)
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(block) - 4
        assert block[:-4].endswith(body) if r.record_type == "response" else block[:-4].startswith(b"HTTP/1.1 200 OK")


def test_small_payloads_are_all_responses(spark):
    folder = scratch_dir(spark, "t-warc")
    warc_store.write_archive(_pages(spark, ROWS), folder, min_bytes=100)
    back = warc_store.read_archive(spark, folder).collect()
    assert {r.record_type for r in back} == {"response"} and len(back) == len(ROWS)


def test_damage_is_found_and_empty_table(spark):
    folder = scratch_dir(spark, "t-warc")
    warc_store.write_archive(_pages(spark, ROWS[:3]), folder)
    bad = spark.read.parquet(f"{folder}/payloads").selectExpr("address", "cast('other' as binary) payload")
    bad.write.parquet(f"{folder}-bad/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}-bad/records")
    with pytest.raises(Exception, match="damaged payload"):
        warc_store.read_archive(spark, f"{folder}-bad").collect()
    empty = scratch_dir(spark, "t-warc")
    warc_store.write_archive(_pages(spark, ROWS).limit(0), empty)
    assert warc_store.read_archive(spark, empty).collect() == []


def test_every_payload_column_is_verified(spark):
    folder = scratch_dir(spark, "t-warc")
    warc_store.write_archive(_pages(spark, ROWS[:3] + [(8, "v", "x" * 2_000_000)]), folder)
    stored = spark.read.parquet(f"{folder}/payloads")
    stored.selectExpr("address", "cast('<p>s4me</p>' as binary) payload").write.parquet(f"{folder}-bad/payloads")
    stored.limit(0).write.parquet(f"{folder}-gone/payloads")
    for kind in ("bad", "gone"):
        spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}-{kind}/records")
        for column in ("payload", "payload_bytes", "payload_digest", "record"):
            with pytest.raises(Exception, match="damaged payload"):
                warc_store.read_archive(spark, f"{folder}-{kind}").select("page_id", column).collect()
    back = {r.page_id: r for r in warc_store.read_archive(spark, folder).select("page_id", "payload", "payload_bytes").collect()}
    assert bytes(back[8].payload) == b"x" * 2_000_000 and back[8].payload_bytes == 2_000_000
