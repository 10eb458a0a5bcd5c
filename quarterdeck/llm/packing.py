"""Bounded-space online packing of documents into sequences of a fixed window.

Every partition keeps a fixed number of open windows.  A document gives away whole
windows first; its rest goes into the open window it fills best; when it fits into
none, the fullest window is closed and a new one opened.  What is still open at the
end of the partitions is merged: few windows per partition, poured one after the
other with cuts where a window is full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import RowBuffer, stored
from quarterdeck.llm.words import tokenizer_of

WINDOW = 4096
OPEN_WINDOWS = 64
# Partitions whose open windows are merged together: at most this many times OPEN_WINDOWS windows in a task.
MERGE_FAN_IN = 16

PIECE = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


@dataclass
class Window:
    """Pieces (doc_id, start, ids, doc_tokens) of one sequence to be, and how many ids they hold."""

    pieces: list = field(default_factory=list)
    used: int = 0

    def put(self, doc_id: int, start: int, ids: bytes, doc_tokens: int) -> None:
        self.pieces.append((doc_id, start, ids, doc_tokens))
        self.used += len(ids) // 4


class Packer:
    """Online packing in bounded space; ``place`` and ``finish`` hand out windows that are closed."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.limit = window, open_windows
        self.open: list[Window] = []

    def place(self, doc_id: int, ids: bytes) -> Iterator[Window]:
        total = len(ids) // 4
        whole = total - total % self.window
        for start in range(0, whole, self.window):
            full = Window()
            full.put(doc_id, start, ids[4 * start : 4 * (start + self.window)], total)
            yield full
        rest = total - whole
        if not rest:
            return
        best = max((w for w in self.open if w.used + rest <= self.window), key=lambda w: w.used, default=None)
        if best is None:
            if len(self.open) >= self.limit:
                fullest = max(range(len(self.open)), key=lambda i: self.open[i].used)
                yield self.open.pop(fullest)
            best = Window()
            self.open.append(best)
        best.put(doc_id, whole, ids[4 * whole :], total)
        if best.used == self.window:
            self.open.remove(best)
            yield best


def pour(pieces: Iterator[tuple[int, int, bytes, int]], window: int) -> Iterator[Window]:
    """Windows filled one after the other, cutting the piece that reaches over the end."""
    current = Window()
    for doc_id, start, ids, total in pieces:
        while ids:
            room = 4 * (window - current.used)
            current.put(doc_id, start, ids[:room], total)
            start, ids = start + room // 4, ids[room:]
            if current.used == window:
                yield current
                current = Window()
    if current.used:
        yield current


def _add(rows: RowBuffer, window: Window, sequence_id: int, *more) -> None:
    offset = 0
    for doc_id, start, ids, total in window.pieces:
        length = len(ids) // 4
        rows.add(doc_id, start, length, total, sequence_id, offset, ids, *more, size=len(ids))
        offset += length


def _schema(*more: tuple[str, pa.DataType]) -> pa.Schema:
    long = pa.int64()
    names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")
    return pa.schema([*((n, long) for n in names), ("ids", pa.binary()), *more])


def pack_documents(
    df: DataFrame,
    path: str,
    end_id: int,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    fan_in: int = MERGE_FAN_IN,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (packed 32-bit).

    A null or empty text is its end id alone.  Each input row is packed as a document
    of its own, equal rows and equal ids too; a null id is kept.  Ties for the best
    window go to the one opened first.  Other columns are left out.  An empty table
    gives no sequence.  Memory follows the longest document and the open windows.
    The sequences depend on how the rows lie in partitions, their rules do not.
    """
    tail = end_id.to_bytes(4, "little")
    schema = _schema(("leftover", pa.int32()))

    def run(batches):
        tokenizer, packer, rows = tokenizer_of(path), Packer(window, open_windows), RowBuffer(schema)
        part = TaskContext.get().partitionId()
        number = part << 40
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = (t or "" for t in batch.column(1).to_pylist())
            for key, ids in zip(keys, tokenizer.encode(texts), strict=True):
                for closed in packer.place(key, ids + tail):
                    _add(rows, closed, number, None)
                    number += 1
                if rows.full():
                    yield from rows.take()
        for still_open in packer.open:
            _add(rows, still_open, number, part // fan_in)
            number += 1
        yield from rows.take()

    asked = df.selectExpr(f"CAST(`{id_column}` AS bigint) AS doc_id", f"CAST(`{text_column}` AS string) AS text")
    packed = stored(asked.mapInArrow(run, PIECE + ", leftover int"), "packed")
    closed = packed.filter("leftover IS NULL").drop("leftover")
    return closed.unionByName(merge_leftovers(packed.filter("leftover IS NOT NULL"), window))


def merge_leftovers(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """The pieces of open windows poured together, group by group of ``leftover``.

    A group has the open windows of a fixed number of partitions, so it is bounded.
    """
    schema = _schema()

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = RowBuffer(schema)
        number = (1 << 62) + (key[0].as_py() << 32)

        def stream():
            for batch in batches:
                columns = (batch.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens"))
                yield from zip(*columns, strict=True)

        for full in pour(stream(), window):
            _add(rows, full, number)
            number += 1
            if rows.full():
                yield from rows.take()
        yield from rows.take()

    return pieces.groupBy("leftover").applyInArrow(run, PIECE)


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: sequences, ids, and padding; a length that is a power of two is left as it is."""
    used = pieces.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.bit_count("used") == 1
    return used.agg(
        F.count("*").alias("sequences"),
        F.sum("used").alias("ids"),
        F.sum(F.when(power, 0).otherwise(window - F.col("used"))).alias("padding"),
    )
