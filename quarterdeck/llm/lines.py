"""Removal of repeated passages of lines.

Lines are hashed, and a rolling hash over two lines chooses boundaries: a boundary depends
on the lines beside it alone, so a passage shifted by other lines is cut alike wherever it
stands.  A chunk reaches from one boundary line to the next and holds both, so every pair
of neighbouring lines lies in exactly one chunk.

Chunks that occur more than once in the whole table go as a whole, after their bytes are
compared, except where they stand first.  That leaves the lines of a passage before its
first boundary and after its last one.  For these, and for passages without a whole chunk,
the pairs of all chunks that do not go are looked up one by one.  Nothing is missed by this:
the first place of a pair is never in a chunk that goes, for the chunk's own first place
holds it earlier.  Runs found in both ways are grown together to passages.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.llm.shared import RowBuffer, may_hold, stored

CHUNK_PAIRS = 3  # pairs of lines in a chunk on average
PAIR_LINES = 2  # lines the rolling hash looks back on, and of the shortest passage
BASE = 0x9E3779B97F4A7C15  # of the rolling hash; any odd number serves


def line_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of every line, its line feed included."""
    spans, start = [], 0
    while start < len(text):
        end = text.find("\n", start) + 1 or len(text)
        spans.append((start, end))
        start = end
    return spans


def rolling(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every line the hash of the last ``window`` lines, each times a power of the base by its distance.

    The step from one line to the next takes in a hash and gives one back; here all
    steps are done at once by shifted sums.
    """
    out, power = np.zeros(len(hashes), np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for distance in range(min(window, len(hashes))):
            out[distance:] += hashes[: len(hashes) - distance] * power
            power *= np.uint64(BASE)
        # The low bits of a product are weak: mix before they are looked at.
        out ^= out >> np.uint64(29)
        out *= np.uint64(BASE)
        return out ^ (out >> np.uint64(32))


def line_hashes(text: str) -> np.ndarray:
    # A line counts without its line feed, so the last line of a text can match one amid another.
    return np.array([xxhash.xxh64_intdigest(text[a:b].removesuffix("\n")) for a, b in line_spans(text)], np.uint64)


def boundaries(pairs: np.ndarray, mean: int = CHUNK_PAIRS) -> np.ndarray:
    """Numbers of the lines at which chunks begin and end, by the hashes of the pairs of a text: its
    first and last line, and every line whose pair with the one before falls so."""
    if not len(pairs):
        return np.zeros(0, np.int64)
    inner = np.flatnonzero(pairs[:-1] % np.uint64(mean) == 0) + 1
    return np.concatenate([[0], inner, [len(pairs)]])


def _chunk_rows(mean: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [("row", pa.binary()), ("id", pa.int64()), ("line", pa.int32()), ("hash", pa.binary()), ("pairs", pa.list_(pa.int64()))]
    schema = pa.schema(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = RowBuffer(schema)
        for batch in batches:
            for row, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                each = line_hashes(text)
                pairs = rolling(each, PAIR_LINES)[PAIR_LINES - 1 :]
                bounds, signed = boundaries(pairs, mean).tolist(), pairs.view(np.int64)
                for first, last in zip(bounds, bounds[1:]):
                    digest = xxhash.xxh3_128_digest(each[first : last + 1].tobytes())
                    rows.add(row, key, first, digest, signed[first:last], size=8 * (last - first) + 64)
                    if rows.full():
                        yield from rows.take()
        yield from rows.take()

    return run


CHUNKS = "row binary, id bigint, line int, hash binary, pairs array<bigint>"
BODIES = "row binary, id bigint, line int, lines int, start int, end int, body string"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per asked run (line, lines) with its text; a line feed at its end is not compared."""
    ints = [(n, pa.int32()) for n in ("line", "lines", "start", "end")]
    rows = RowBuffer(pa.schema([("row", pa.binary()), ("id", pa.int64()), *ints, ("body", pa.string())]))
    for batch in batches:
        for row, key, text, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            spans = line_spans(text)
            for run in asked:
                line, after = run["line"], run["line"] + run["lines"]
                if after > len(spans):  # asked of another text with the same short key
                    continue
                start, end = spans[line][0], spans[after - 1][1]
                body = text[start:end].removesuffix("\n")
                rows.add(row, key, line, run["lines"], start, end, body, size=len(body) + 48)
                if rows.full():
                    yield from rows.take()
    yield from rows.take()


def _place():
    """Rank of a run among equal ones: ids, then rows, then lines; documents without id come last."""
    return F.struct(F.col("id").isNull().alias("unnamed"), "id", "row", "line")


def _apart(first: str):
    """A run that only shares a line with its first place, as in three equal lines, is no repetition."""
    return (F.col(f"{first}.row") != F.col("row")) | (F.col("line") - F.col(f"{first}.line") >= PAIR_LINES)


def chunk_table(docs: DataFrame, mean: int = CHUNK_PAIRS) -> DataFrame:
    """(row, id, line, hash, pairs, repeated) of every chunk of ``docs`` (row, id, text): its first line, the
    hashes of its pairs, and whether its own hash occurs more than once."""
    chunks = stored(docs.select("row", "id", "text").mapInArrow(_chunk_rows(mean), CHUNKS), "chunks")
    again = chunks.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash", F.lit(True).alias("repeated"))
    return stored(chunks.join(again, "hash", "left").withColumn("repeated", F.coalesce("repeated", F.lit(False))), "chunks")


def copied_chunks(chunks: DataFrame) -> DataFrame:
    """(row, line, lines, hash) of the chunks of ``chunk_table`` whose hash has an earlier place."""
    repeated = chunks.filter("repeated").withColumn("lines", F.size("pairs") + 1).drop("pairs", "repeated")
    first = repeated.groupBy("hash").agg(F.min(_place()).alias("first"))
    return repeated.join(first, "hash").filter(_apart("first")).select("row", "line", "lines", "hash").distinct()


def asked_runs(chunks: DataFrame, copies: DataFrame) -> DataFrame:
    """(short, asked): the runs whose bytes are to be compared, by a 64-bit key of their document.

    These are all repeated chunks, and of the chunks that are no ``copies`` the pairs whose hash occurs more than once.
    """
    short = F.xxhash64("row").alias("short")
    whole = chunks.filter("repeated").select(short, "line", (F.size("pairs") + 1).alias("lines"))
    plain = chunks.filter("NOT repeated").select("row", "line", "pairs")
    owners = chunks.filter("repeated").join(copies.select("row", "line"), ["row", "line"], "left_anti")
    left = plain.unionByName(owners.select("row", "line", "pairs"))
    pairs = left.select(short, "line", F.posexplode("pairs").alias("at", "pair"))
    pairs = pairs.select("short", (F.col("line") + F.col("at")).alias("line"), "pair")
    again = pairs.groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1").select("pair")
    single = pairs.join(again, "pair", "left_semi").select("short", "line", F.lit(PAIR_LINES).alias("lines"))
    both = whole.unionByName(single)
    return both.groupBy("short").agg(F.collect_set(F.struct("line", "lines")).alias("asked"))


def repeated_runs(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(row, line, lines, start, end) of the ``asked`` runs of ``docs`` that stand, byte for byte, at an earlier place too."""
    keyed = may_hold(docs.withColumn("short", F.xxhash64("row")), asked, "short", "may").filter("may")
    texts = keyed.join(asked, "short").select("row", "id", "text", "asked")
    cut = stored(texts.mapInArrow(_bodies, BODIES), "bodies")
    owners = cut.groupBy("body").agg(F.min(_place()).alias("owner"), F.max(_place()).alias("last"))
    equal = cut.join(owners.filter("owner != last").drop("last"), "body")
    return equal.filter(_apart("owner")).select("row", "line", "lines", "start", "end").distinct()


def found_runs(docs: DataFrame, mean: int = CHUNK_PAIRS) -> DataFrame:
    """``repeated_runs`` of ``docs``: whole chunks, and pairs of lines where no chunk goes."""
    chunks = chunk_table(docs, mean)
    copies = stored(copied_chunks(chunks), "copies")
    found = stored(repeated_runs(docs, stored(asked_runs(chunks, copies), "asked")), "found")
    unlike = copies.join(found, ["row", "line", "lines"], "left_anti").select("hash").distinct()
    if unlike.isEmpty():
        return found
    # Equal in hash but not in bytes: these chunks do not go, so their pairs count like all others.
    proven = stored(copies.join(unlike, "hash", "left_anti"), "copies")
    return stored(repeated_runs(docs, stored(asked_runs(chunks, proven), "asked")), "found")


PASSAGES_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lines", pa.int32())]))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("start", "end", "lines")])))
def grown_together(runs: pa.Array) -> pa.Array:
    """Runs (line, lines, start, end) in order, those that overlap or touch made one passage."""
    out = []
    for found in runs.to_pylist():
        passages: list[dict] = []
        after = -1
        for r in found or ():
            if r["line"] > after:
                passages.append({"start": r["start"], "end": r["end"], "lines": r["lines"]})
                after = r["line"] + r["lines"]
            elif r["line"] + r["lines"] > after:
                passages[-1]["end"] = r["end"]
                passages[-1]["lines"] += r["line"] + r["lines"] - after
                after = r["line"] + r["lines"]
        out.append(passages)
    return pa.array(out, PASSAGES_TYPE)


@F.arrow_udf(T.StringType())
def without_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Each text without its (start, end) spans, which are in order and do not overlap; null spans take nothing away."""
    out = []
    for text, gaps in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        kept, start = [], 0
        for gap in gaps or ():
            kept.append(text[start : gap["start"]])
            start = gap["end"]
        out.append("".join([*kept, text[start:]]))
    return pa.array(out, pa.string())


def remove_repeated_passages(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", mean: int = CHUNK_PAIRS) -> DataFrame:
    """One row per input row: (id, clean_text, removed_chunks, removed_lines, removed_spans).

    A line goes when a run of two lines or more that holds it stands, byte for byte, at an
    earlier place of the table and does not overlap itself there; a blank line is a line.
    Earlier is the document with the smaller id, in it the line further ahead; documents that share an
    id follow a hash, those without id come last.  Places are those of the texts as given: a run may
    go although longer runs took its earlier place, but every line that is removed stays somewhere.
    Rows with equal id and text are one document and are cleaned
    alike.  A null or empty text stays an empty one.  A line feed at a run's end is not compared.
    Very long texts are cut line by line like others; ``mean``, the pairs of a chunk on average, does
    not change the result.
    Spans are (start, end) in characters and the longest stretches of lines removed; their number is
    ``removed_chunks``.  Other columns are left out.  An empty table gives an empty result.
    """
    texts = df.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    parts = (F.lpad(F.hex(F.xxhash64(*pair)), 16, "0") for pair in (("id", "text"), ("text", "id")))
    name = F.unhex(F.concat(*parts))
    docs = texts.withColumn("row", name)
    found = found_runs(docs, mean)
    runs = found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("line", "lines", "start", "end"))).alias("runs"))
    passages = runs.select("row", grown_together("runs").alias("passages"))
    # Texts that lose nothing are not moved.
    marked = may_hold(docs, found.select("row").distinct(), "row", "may")
    touched = marked.filter("may").join(passages, "row", "left").select("id", "text", "passages")
    untouched = marked.filter("NOT may").select("id", "text", F.lit(None).cast(passages.schema["passages"].dataType).alias("passages"))
    joined = touched.unionByName(untouched)
    spans = F.coalesce(F.transform("passages", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))),
                       F.array().cast("array<struct<start:int,end:int>>"))
    count = F.aggregate("passages", F.lit(0), lambda n, p: n + p["lines"])
    return joined.select(
        F.col("id").alias(id_column),
        without_spans("text", spans).alias("clean_text"),
        F.size(spans).cast("long").alias("removed_chunks"),
        F.coalesce(count, F.lit(0)).cast("long").alias("removed_lines"),
        spans.alias("removed_spans"),
    )
