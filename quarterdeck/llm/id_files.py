"""Token ids in binary files: one frame per document, one shared dictionary.

A zstandard dictionary is trained on the serialized id arrays of a bounded sample;
every document is then compressed by itself, so that any of them can be read alone.
Files hold one segment each:

    magic (8 bytes) | SHA-256 of the dictionary (32) | header (big-endian 64-bit:
    shard, sequence, documents, ids, first doc_id, last doc_id) |
    index: doc_ids, ids per document, end of each frame | frames

Segments ascend by shard, then by sequence; doc_ids ascend through them.  Documents
without id stand before all others, in shards of negative numbers; 0 fills their place
in header and index.  The
manifest beside the files says how many ids stand before every segment.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.llm.shared import RowBuffer, one_row_each
from quarterdeck.llm.words import tokenizer_of

MAGIC = b"QDTOKIDS"
HEADER = ("shard", "sequence", "documents", "ids", "first_doc", "last_doc")
HEADER_BYTES = len(MAGIC) + 32 + 8 * len(HEADER)

DICTIONARY_SAMPLE = 2000  # documents the dictionary is trained on, about
DICTIONARY_SAMPLE_BYTES = 16_384  # of each of them
DICTIONARY_BYTES = 65_536
DOCS_PER_SHARD = 8192
MAX_SHARDS = 32_768
SEGMENT_BYTES = 16 << 20


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; samples too few or too small to train on serve as they are."""
    samples = [s for s in samples if s]
    if sum(map(len, samples)) >= 8 * size and len(samples) >= 64:
        return zstandard.train_dictionary(size, samples, level=3).as_bytes()
    return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def sample_dictionary(df: DataFrame, path: str, end_id: int, rows: int, sample: int = DICTIONARY_SAMPLE) -> bytes:
    """Trained on documents whose id hashes into the sample's share; about ``sample`` of them reach the driver,
    one for each id however many rows share it."""
    tail = end_id.to_bytes(4, "little")
    share = min(1.0, sample / max(rows, 1))
    chosen = F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        tokenizer = tokenizer_of(path)
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column(0))
            ids = [(i + tail)[:DICTIONARY_SAMPLE_BYTES] for i in tokenizer.encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    found = one_row_each(df.filter(chosen), "doc_id", "text").select("text").mapInArrow(run, "ids binary")
    return train_dictionary(sorted(bytes(r[0]) for r in found.collect()))


# ---- segments


def segment_bytes(shard: int, sequence: int, dictionary_hash: bytes, docs: list[tuple[int, int, bytes]]) -> bytes:
    """One segment of documents (doc_id, ids, frame)."""
    doc_ids = np.array([d[0] or 0 for d in docs], "<i8")
    sizes = np.array([d[1] for d in docs], "<u4")
    ends = np.cumsum([len(d[2]) for d in docs], dtype="<u8")
    header = np.array([shard, sequence, len(docs), sizes.sum(dtype=np.int64), doc_ids[0], doc_ids[-1]], ">i8")
    parts = (MAGIC, dictionary_hash, header, doc_ids, sizes, ends)
    return b"".join([p if isinstance(p, bytes) else p.tobytes() for p in parts] + [d[2] for d in docs])


class Segment:
    """A segment's header and index; frames are cut out when asked for."""

    def __init__(self, content: bytes, dictionary_hash: bytes):
        if content[:8] != MAGIC or content[8:40] != dictionary_hash:
            raise ValueError("not a segment written with this dictionary")
        header = np.frombuffer(content, ">i8", len(HEADER), 40)
        self.shard, self.sequence, count = (int(x) for x in header[:3])
        at = HEADER_BYTES
        self.doc_ids = np.frombuffer(content, "<i8", count, at)
        self.sizes = np.frombuffer(content, "<u4", count, at + 8 * count)
        self.ends = np.frombuffer(content, "<u8", count, at + 12 * count)
        self.frames_at = at + 20 * count
        self.content = memoryview(content)

    def frame(self, place: int) -> memoryview:
        start = int(self.ends[place - 1]) if place else 0
        return self.content[self.frames_at + start : self.frames_at + int(self.ends[place])]


# ---- writing


def write_documents(
    df: DataFrame,
    out: str,
    path: str,
    end_id: int,
    docs_per_shard: int = DOCS_PER_SHARD,
    segment_limit: int = SEGMENT_BYTES,
    nameless: bool = False,
) -> None:
    """Tokenizes (doc_id, text), appends ``end_id`` and writes segments, dictionary and manifest under ``out``.

    Null texts count as empty.  Rows without an id are an error, or with ``nameless``
    stand before the smallest id, spread over shards of their own by a hash of their ids
    of words; the dictionary is not trained on them.  Rows that share an id are all written, one after the other.  An empty
    table writes a manifest of no segments.  Other columns are left out.  Memory
    follows the segment limit and the longest document.
    """
    spark = df.sparkSession
    asked = df.selectExpr("CAST(doc_id AS bigint) AS doc_id", "CAST(text AS string) AS text")
    rows, missing = asked.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    if missing and not nameless:
        raise ValueError(f"{missing} rows without doc_id")
    dictionary = sample_dictionary(asked, path, end_id, rows)
    written = spark.createDataFrame([(dictionary, hashlib.sha256(dictionary).hexdigest())], "dictionary binary, sha256 string")
    written.coalesce(1).write.parquet(f"{out}/dictionary")

    shards = max(1, min(MAX_SHARDS, -(-rows // docs_per_shard)))
    bounds = np.array([], np.int64)
    if shards > 1:
        cuts = [i / shards for i in range(1, shards)]
        found = asked.agg(F.percentile_approx("doc_id", cuts, 10 * max(shards, 1000))).first()[0]
        bounds = np.unique(np.array(found or [], np.int64))
    frames = asked.mapInArrow(_compress(path, end_id, dictionary, bounds), "shard int, doc_id bigint, n int, frame binary")
    part = F.expr("IF(shard < 0, -1 - shard, shard)")
    ordered = frames.repartitionById(len(bounds) + 1, part).sortWithinPartitions("shard", "doc_id", "frame")
    segments = ordered.mapInArrow(_segments(hashlib.sha256(dictionary).digest(), segment_limit), "segment binary")
    # A text file of one row holds the row's bytes and a line end; the segment knows its own length.
    segments.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{out}/segments")
    _manifest(spark, out).write.parquet(f"{out}/manifest")


def _compress(path: str, end_id: int, dictionary: bytes, bounds: np.ndarray):
    tail = end_id.to_bytes(4, "little")
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()), ("frame", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, rows = tokenizer_of(path), RowBuffer(schema)
        shared = _dictionary(dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=False, write_dict_id=False)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            shards = np.searchsorted(bounds, np.array([d or 0 for d in doc_ids], np.int64), "right").tolist()
            texts = (t.as_py() or "" for t in batch.column(1))  # one at a time: a batch may hold long ones
            for shard, doc_id, ids in zip(shards, doc_ids, tokenizer.encode(texts), strict=True):
                if doc_id is None:
                    shard = -1 - zlib.crc32(ids) % (len(bounds) + 1)
                frame = packer.compress(ids + tail)
                rows.add(shard, doc_id, len(ids) // 4 + 1, frame, size=len(frame))
                if rows.full():
                    yield from rows.take()
        yield from rows.take()

    return run


def _segments(dictionary_hash: bytes, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int, int, bytes]] = []
        size, shard, sequence = 0, None, 0

        def cut():
            data = segment_bytes(shard, sequence, dictionary_hash, docs)
            docs.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["segment"])

        for batch in batches:
            for now, doc_id, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (now != shard or size + len(frame) > limit):
                    yield cut()
                    size, sequence = 0, sequence + 1
                if now != shard:
                    shard, sequence = now, 0
                docs.append((doc_id, n, frame))
                size += len(frame)
        if docs:
            yield cut()

    return run


def _files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{out}/segments")


def _manifest(spark: SparkSession, out: str) -> DataFrame:
    """Header fields of every segment and ``ids_before``; shards are summed up first, then segments within each."""
    at = len(MAGIC) + 32 + 1
    fields = {
        name: F.conv(F.hex(F.substring("content", at + 8 * i, 8)), 16, -10).cast("bigint") for i, name in enumerate(HEADER)
    }
    heads = _files(spark, out).filter("length > 1").select(*(c.alias(n) for n, c in fields.items()))
    shards = heads.groupBy("shard").agg(F.sum("ids").alias("shard_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_SHARDS rows
    inside = Window.partitionBy("shard").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("shard", F.coalesce(F.sum("shard_ids").over(before), F.lit(0)).alias("_base"))
    placed = heads.withColumn("_inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return placed.join(bases, "shard").select(*HEADER, (F.col("_base") + F.col("_inside")).alias("ids_before"))


# ---- reading


def read_dictionary(spark: SparkSession, out: str) -> bytes:
    data, digest = spark.read.parquet(f"{out}/dictionary").first()
    if hashlib.sha256(bytes(data)).hexdigest() != digest:
        raise ValueError("the dictionary does not have its hash")
    return bytes(data)


def read_segments(spark: SparkSession, out: str, doc_id: int | None = None) -> DataFrame:
    """(shard, sequence, doc_id, start_in_segment, n_tokens, token_ids); with ``doc_id`` only that document's frames
    are decompressed."""
    dictionary = read_dictionary(spark, out)
    digest = hashlib.sha256(dictionary).digest()
    long = pa.int64()
    names = ("shard", "sequence", "doc_id", "start_in_segment", "n_tokens")
    schema = pa.schema([*((n, long) for n in names), ("token_ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, rows = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)), RowBuffer(schema)
        for batch in batches:
            for cell in batch.column(0):
                segment = Segment(cell.as_py(), digest)
                starts = np.cumsum(segment.sizes, dtype=np.int64) - segment.sizes
                named = segment.shard >= 0
                places = range(len(starts)) if doc_id is None else np.flatnonzero(named & (segment.doc_ids == doc_id)).tolist()
                for i in places:
                    ids = reader.decompress(segment.frame(i))
                    if len(ids) != 4 * segment.sizes[i]:
                        raise ValueError(f"document {segment.doc_ids[i]} has another length than its index says")
                    place = (segment.shard, segment.sequence, int(segment.doc_ids[i]) if named else None, int(starts[i]), int(segment.sizes[i]))
                    rows.add(*place, ids, size=len(ids))
                    if rows.full():
                        yield from rows.take()
        yield from rows.take()

    files = _files(spark, out).filter("length > 1").select("content")
    return files.mapInArrow(run, "shard bigint, sequence bigint, doc_id bigint, start_in_segment bigint, n_tokens bigint, token_ids binary")


def with_starts(rows: DataFrame, spark: SparkSession, out: str) -> DataFrame:
    """Adds ``start``: the ids of all documents before, from the manifest."""
    manifest = spark.read.parquet(f"{out}/manifest").select("shard", "sequence", "ids_before")
    placed = rows.join(manifest, ["shard", "sequence"])
    return placed.withColumn("start", F.col("ids_before") + F.col("start_in_segment")).drop("ids_before")


def read_document(spark: SparkSession, out: str, doc_id: int) -> DataFrame:
    """One document by its id: (doc_id, start, n_tokens, token_ids)."""
    rows = with_starts(read_segments(spark, out, doc_id), spark, out)
    return rows.select("doc_id", "start", "n_tokens", "token_ids")
