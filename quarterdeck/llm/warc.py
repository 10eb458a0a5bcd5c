"""WARC archives by way of a chunked record table.

A payload is never handled as one value after it was read: it becomes rows of record
and chunk number, hashed chunk by chunk.  A chunk row is written as one WARC record,
the first as the response, later ones as continuations (record segmentation of WARC
1.1), so writer and reader hold one chunk at a time.  Chunks are cut so that no block
holds the line that begins a record; archives can then be split there and read by
many tasks, whatever bytes the payloads have.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.llm.shared import RowBuffer, stored

CHUNK_BYTES = 1 << 16
RECORDS_PER_FILE = 100_000

# Lines of the format.
VERSION = b"WARC/1.1"
LINE = b"\r\n"
RECORD_START = LINE + VERSION + LINE
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"

CHUNK = "page_id bigint, url string, row_key bigint, payload_bytes bigint, payload_digest string, strong_digest string, chunk_no int, chunks int, chunk binary"
CHUNK_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("row_key", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("strong_digest", pa.string()), ("chunk_no", pa.int32()),
        ("chunks", pa.int32()), ("chunk", pa.binary()),
    ]
)


def cut_points(payload: memoryview, chunk_bytes: int) -> list[int]:
    """Ends of the chunks: at most ``chunk_bytes`` each.

    The line that begins a record stands in no chunk, nor where a chunk meets the line
    ends before and after it: there the payload is cut within that line's version.
    """
    ends, start, size = [], 0, len(payload)
    while start < size:
        end = min(size, start + chunk_bytes)
        inside = b"".join([LINE, payload[start:end], LINE]).find(RECORD_START)
        if inside >= 0:
            end = start + inside + len(VERSION) - 2
        ends.append(end)
        start = end
    return ends or [0]


def sha1_base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(df: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
                chunk_bytes: int = CHUNK_BYTES, payloads: bool = True) -> DataFrame:
    """Rows (page_id, url, row_key, payload_bytes, digests, chunk_no, chunks, chunk) of every record.

    Null payloads count as empty and have one empty chunk.  Digests (SHA-1 in base32,
    and SHA-256) grow chunk by chunk and stand on every row of the record.  Without
    ``payloads`` only the first row of each record is given, its chunk null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = RowBuffer(CHUNK_SCHEMA)
        for batch in batches:
            ids, urls, keys, cells = batch.columns
            for i, cell in enumerate(cells):
                buffer = cell.as_buffer()
                payload = memoryview(buffer) if buffer is not None else memoryview(b"")
                sha1, strong, start = hashlib.sha1(), hashlib.sha256(), 0
                ends = cut_points(payload, chunk_bytes)
                for end in ends:
                    sha1.update(payload[start:end])
                    strong.update(payload[start:end])
                    start = end
                head = (ids[i].as_py(), urls[i].as_py(), keys[i].as_py(), len(payload))
                digests = (sha1_base32(sha1.digest()), strong.hexdigest())
                start = 0
                for number, end in enumerate(ends if payloads else ends[:1]):
                    chunk = bytes(payload[start:end]) if payloads else None
                    rows.add(*head, *digests, number, len(ends), chunk, size=end - start if payloads else 64)
                    start = end
                    if rows.full():
                        yield from rows.take()
        yield from rows.take()

    asked = df.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.monotonically_increasing_id().alias("row_key"),
        F.col(payload_column).cast("string").cast("binary").alias("payload"),
    )
    return asked.mapInArrow(run, CHUNK)


def payload_owners(heads: DataFrame) -> DataFrame:
    """(strong_digest, payload_bytes, owner): the smallest page of every payload."""
    return heads.groupBy("strong_digest", "payload_bytes").agg(F.min("page_id").alias("owner"))


def with_owners(chunks: DataFrame, decisions: DataFrame) -> DataFrame:
    """``chunks`` with the ``owner`` that ``decisions`` (page_id, strong_digest, owner) name, or null; null ids are equal.

    Payloads move once: the keys of the join, without nulls, are those of the one shuffle.  Rows of one page then
    lie side by side, so that of equal rows the first can be told.
    """
    keys = ["nameless", "known", "strong_digest"]

    def keyed(rows: DataFrame) -> DataFrame:
        known = F.coalesce("page_id", F.lit(0).cast("bigint"))
        return rows.withColumns({"nameless": F.isnull("page_id"), "known": known})

    found = keyed(decisions).drop("page_id")
    return keyed(chunks).repartition(*keys).join(found, keys, "left").drop("nameless", "known")


def write_archives(df: DataFrame, out: str, chunk_bytes: int = CHUNK_BYTES, min_bytes: int = 0,
                   compression: str = "gzip", nameless: bool = False, **columns: str) -> None:
    """Writes a record per row of ``df`` under ``out``; equal payloads of at least ``min_bytes`` are written once.

    Of equal payloads the record with the smallest page id is the response and others
    are revisits; of rows that share that id too, one is.  A row without an id is an
    error, or with ``nameless`` a record of its own name: a revisit where a page with an id has its
    payload, else a response, also where rows without id share a payload.  An empty table writes no record.  The files' names and the order of records
    in them carry no meaning.
    """
    first = chunk_table(df, chunk_bytes=chunk_bytes, payloads=False, **columns)
    heads = stored(first.select("page_id", "strong_digest", "payload_bytes"), "heads")
    owners = payload_owners(heads.filter(F.col("payload_bytes") >= min_bytes))
    decisions = heads.join(owners, ["strong_digest", "payload_bytes"]).select("page_id", "strong_digest", "owner").distinct()
    decided = with_owners(chunk_table(df, chunk_bytes=chunk_bytes, **columns), decisions)
    later = F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("page_id"))
    wanted = decided.withColumn("refers_to", F.when(later, F.col("owner"))).filter(~later | (F.col("chunk_no") == 0))
    ordered = wanted.sortWithinPartitions("page_id", "strong_digest", "row_key", "chunk_no")
    asked = ordered.select("page_id", "url", "row_key", "payload_bytes", "payload_digest", "strong_digest",
                           "chunk_no", "chunks", "chunk", "owner", "refers_to")
    records = asked.mapInArrow(_record_writer(nameless), "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", compression)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(out)
    )


def _record_writer(nameless: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = RowBuffer(pa.schema([("record", pa.binary())]))
        group, response_key, copies, copy_key = None, None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["page_id"] is None and not nameless:
                    raise ValueError("a record without page_id")
                if (row["page_id"], row["strong_digest"]) != group:
                    group, response_key = (row["page_id"], row["strong_digest"]), row["row_key"]
                    copies, copy_key = 0, row["row_key"]
                if row["row_key"] != copy_key:
                    copies, copy_key = copies + 1, row["row_key"]
                again = row["owner"] is not None and row["row_key"] != response_key
                refers_to = row["page_id"] if again and row["refers_to"] is None else row["refers_to"]
                if refers_to is not None and row["chunk_no"]:
                    continue
                record = record_bytes(row, refers_to, copies)
                rows.add(record, size=len(record))
                if rows.full():
                    yield from rows.take()
        yield from rows.take()

    return run


def record_bytes(row: dict, refers_to: int | None, copy: int = 0) -> bytes:
    """One WARC record without the empty lines that end it."""
    page = f"none:{row['strong_digest']}" if row["page_id"] is None else row["page_id"]
    name = f"urn:x-page:{page}" + f":copy-{copy}" * bool(copy)
    kind = "revisit" if refers_to is not None else "continuation" if row["chunk_no"] else "response"
    head = http_head(row["payload_bytes"]) if not row["chunk_no"] else b""
    block = head + (row["chunk"] if refers_to is None else b"")
    url = (row["url"] or "about:blank").translate({10: "%0A", 13: "%0D"})
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{name}>" if not row["chunk_no"] else f"<{name}:segment-{row['chunk_no'] + 1}>",
        "WARC-Date": EPOCH,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
    }
    if kind == "revisit":
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:x-page:{refers_to}>"}
    elif row["chunks"] > 1:
        fields["WARC-Segment-Number"] = str(row["chunk_no"] + 1)
        if row["chunk_no"]:
            fields["WARC-Segment-Origin-ID"] = f"<{name}>"
        if row["chunk_no"] + 1 == row["chunks"]:
            fields["WARC-Segment-Total-Length"] = str(len(http_head(row["payload_bytes"])) + row["payload_bytes"])
    if not row["chunk_no"]:
        fields["Content-Type"] = "application/http; msgtype=response"
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return VERSION + LINE + lines.encode() + LINE + block


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


# ---- reading

PART = "page_id bigint, origin string, record_type string, refers_to bigint, declared string, payload_bytes bigint, segment int, total int, chunk binary"
PART_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()), ("origin", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("declared", pa.string()), ("payload_bytes", pa.int64()), ("segment", pa.int32()), ("total", pa.int32()),
        ("chunk", pa.binary()),
    ]
)


def read_chunks(spark: SparkSession, out: str) -> DataFrame:
    """The archives' records as chunk rows.

    ``origin`` is the id of the record a chunk belongs to, ``segment`` its number from
    1, ``total`` the bytes of HTTP head and payload, stated in the last segment.  A
    file's order of records is not relied on.
    """
    # The first record of a file keeps its version line; the others lost it with the split.
    lines = spark.read.option("lineSep", RECORD_START.decode()).text(out)
    return lines.select(F.col("value").cast("binary").alias("record")).mapInArrow(_parse_records, PART)


def _parse_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = RowBuffer(PART_SCHEMA)
    for batch in batches:
        for cell in batch.column(0):
            part = parse_record(cell.as_py())
            if part is not None:
                rows.add(*part, size=len(part[-1]))
            if rows.full():
                yield from rows.take()
    yield from rows.take()


def parse_record(record: bytes) -> tuple | None:
    """A chunk row; None for kinds of records that hold no payload of a page."""
    head, found, rest = record.removeprefix(VERSION + LINE).partition(LINE + LINE)
    if not found:
        raise ValueError("a record without a header")
    fields = {}
    for line in head.decode().split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    kind = fields["warc-type"]
    if kind not in ("response", "continuation", "revisit"):
        return None
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length:
        raise ValueError("a record shorter than its length says")
    origin = fields.get("warc-segment-origin-id", fields["warc-record-id"]).strip("<>")
    declared = fields["warc-payload-digest"].removeprefix("sha1:")
    size, refers_to = None, None
    if kind != "continuation":
        http, _, block = block.partition(LINE + LINE)
        size = int(http.lower().split(b"content-length:")[1].split()[0])
    if kind == "revisit":
        refers_to = int(fields["warc-refers-to"].strip("<>").split(":")[2])
    segment = int(fields.get("warc-segment-number", 1 if kind != "revisit" else 0))
    stated = fields.get("warc-segment-total-length")
    # A record of one segment is its own last one.
    total = int(stated) if stated else None if "warc-segment-number" in fields else length
    page = origin.split(":")[2]
    return None if page == "none" else int(page), origin, kind, refers_to, declared, size, segment, total, block


def read_records(spark: SparkSession, out: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, from the archives.

    Payloads are hashed again, chunk by chunk; one that differs from its stated digest
    or length is an error.  Only chunks of segmented records are brought together, in
    order and never as one value.
    """
    parts = read_chunks(spark, out)
    # A record of one segment is hashed where it was read.
    alone = parts.filter("record_type = 'revisit' OR (segment = 1 AND total IS NOT NULL)")
    checked = alone.mapInArrow(_verify, RECORD)
    split = parts.filter("NOT (record_type = 'revisit' OR (segment = 1 AND total IS NOT NULL))")
    joined = split.repartition("origin").sortWithinPartitions("origin", "segment").mapInArrow(_verify, RECORD)
    return checked.unionByName(joined)


RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = RowBuffer(RECORD_SCHEMA)
    current, sha1, size = None, None, 0

    def close() -> None:
        if current is None:
            return
        digest = sha1_base32(sha1.digest())
        if digest != current["declared"] or size != current["payload_bytes"]:
            raise ValueError(f"{current['origin']} does not hold the payload it states")
        rows.add(current["page_id"], size, digest, "response", None)

    new_hash = functools.partial(hashlib.sha1, usedforsecurity=False)
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "chunk"}
            if row["record_type"] == "revisit":
                rows.add(row["page_id"], row["payload_bytes"], row["declared"], "revisit", row["refers_to"])
            else:
                if current is None or row["origin"] != current["origin"]:
                    close()
                    if row["segment"] != 1:
                        raise ValueError(f"{row['origin']} lacks its first segment")
                    current, sha1, size = row, new_hash(), 0
                chunk = memoryview(batch.column("chunk")[i].as_buffer())
                sha1.update(chunk)
                size += len(chunk)
            if rows.full():
                yield from rows.take()
    close()
    yield from rows.take()
