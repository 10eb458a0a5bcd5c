"""WARC archives: exact round trip, revisits, segments, odd payloads."""

import base64
import hashlib
import random

import pytest

from quarterdeck.llm import warc
from quarterdeck.llm.shared import scratch

SCHEMA = "page_id long, url string, html string, refers_to string"


def pages():
    draw = random.Random(8)
    odd = ["", None, "\r\n\r\n", "a\r\nWARC/1.1\r\nb", "\r\nWARC/1.1\r\n" * 3, "WARC/1.1\r\n", "x\r\n", "é" * 100, "y" * 5000, "\r\n" * 400]
    rows = [(i, f"http://h/{i}", draw.choice(odd), "c") for i in range(80)]
    return [*rows, (200, None, "only here", None), (201, "http://bad\r\nX: y", "only there", None), (7, "http://h/7", rows[7][2], "c")]


def wanted(rows, least=0):
    smallest = {}
    for page_id, _, html, _ in rows:
        smallest[html or ""] = min(smallest.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        owner = smallest[html or ""] if len(data) >= least else page_id
        first = owner == page_id and (len(data) < least or not any(o[0] == page_id and o[2] == digest for o in out))
        out.append((page_id, len(data), digest, "response" if first else "revisit", None if first else owner))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("chunk", "compression", "parts"), [(64, "none", 3), (100_000, "gzip", 1), (700, "gzip", 4)])
def test_round_trip(spark, chunk, compression, parts):
    out = scratch(spark, "test-warc")
    df = spark.createDataFrame(pages(), SCHEMA).repartition(parts)
    warc.write_archives(df, out, chunk_bytes=chunk, compression=compression)
    # Small splits, so that records are met across their borders.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = sorted((tuple(r) for r in warc.read_records(spark, out).collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == wanted(pages())


def test_payload_bytes_come_back(spark):
    out = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(pages(), SCHEMA), out, chunk_bytes=50, compression="none")
    rows = warc.read_chunks(spark, out).filter("record_type != 'revisit'").orderBy("origin", "segment").collect()
    texts = {}
    for row in rows:
        texts[row.page_id] = texts.get(row.page_id, b"") + bytes(row.chunk)
        assert len(row.chunk) <= 50
    by_id = {p[0]: (p[2] or "").encode() for p in pages()}
    assert texts and all(by_id[i] == data for i, data in texts.items())
    assert set(texts.values()) == set(by_id.values())


def test_least_size(spark):
    rows = [(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abcd", ""), (4, "u", "abcd", "")]
    out = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), out, min_bytes=3)
    found = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_records(spark, out).collect()}
    assert found == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_nothing(spark):
    out = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), out)
    assert warc.read_records(spark, out).count() == 0


def test_cut_points_never_hold_a_record_start():
    payload = b"WARC/1.1\r\nab" + warc.RECORD_START * 4 + b"cd\r\nWARC/1.1"
    for size in (1, 5, 10, 13, 1000):
        ends = warc.cut_points(memoryview(payload), size)
        pieces = [payload[a:b] for a, b in zip([0, *ends], ends)]
        assert b"".join(pieces) == payload and all(pieces)
        assert not any(warc.RECORD_START in warc.LINE + p + warc.LINE for p in pieces)


def test_a_changed_payload_is_an_error(spark):
    out, changed = scratch(spark, "test-warc"), scratch(spark, "test-warc")
    row = {"page_id": 1, "url": "u", "payload_bytes": 9, "payload_digest": warc.sha1_base32(hashlib.sha1(b"some text").digest()),
           "chunk_no": 0, "chunks": 1, "chunk": b"some text"}
    for path, chunk in ((out, b"some text"), (changed, b"some tent")):
        record = warc.record_bytes(row | {"chunk": chunk}, None).decode()
        frame = spark.createDataFrame([(record,)], "value string").coalesce(1)
        frame.write.option("lineSep", "\r\n\r\n").text(path)
    assert warc.read_records(spark, out).first().record_type == "response"
    with pytest.raises(Exception, match="does not hold the payload"):
        warc.read_records(spark, changed).collect()


def test_no_id_is_an_error(spark):
    with pytest.raises(Exception, match="without page_id"):
        warc.write_archives(spark.createDataFrame([(None, "u", "x", "")], SCHEMA), scratch(spark, "test-warc"))


def test_payloads_move_once(spark):
    chunks = warc.chunk_table(spark.createDataFrame([*pages(), (None, None, "x", None)], SCHEMA))
    heads = chunks.filter("chunk_no = 0").select("page_id", "strong_digest").distinct().limit(50)
    decisions = spark.createDataFrame([(*r, 1) for r in heads.collect()], "page_id long, strong_digest string, owner long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        decided = warc.with_owners(chunks, decisions)
        plan = decided._jdf.queryExecution().executedPlan().toString()
        # One for the chunks and one for the decisions.
        assert plan.count("Exchange hashpartitioning") == 2
        told = {(r.page_id, r.strong_digest): r.owner for r in decided.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    named = {(r.page_id, r.strong_digest) for r in decisions.collect()}
    assert told and all((owner == 1) == (page in named) for page, owner in told.items())
