"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to whole numbers.  Rows lie in blocks; a block keeps, for every
attribute and every bit, a bitmap over its rows.  A query's scores are added up with
bitmap arithmetic alone: each set bit of a query component adds the attribute's slices
at its place, full adders bring the sum of many bitmaps down to one per place.  The
top rows are then taken from the most significant slice downward; rows that cannot be
told apart at the boundary have equal scores and are taken by their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.shared import stored

SCALE = 1024
BLOCK_ROWS = 8192  # about as many rows of a slot make one block
LONGEST = 1 << 62  # squared length of a scaled vector whose scores surely fit 64 bits
QUERY_ROWS = 256  # queries travel in groups of this many


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as 64-bit integers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("bigint"))


def usable(vector: Column, scale: int = SCALE) -> Column:
    """Neither null nor empty nor holding null or non-finite components, and short enough for its scores.

    Scaled vectors of a squared length up to 2^62 have inner products of at most 2^62.
    """
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.pow(x.cast("double") * F.lit(float(scale)), F.lit(2.0)))
    return F.coalesce(finite & (F.size(vector) > 0) & (squares <= F.lit(float(LONGEST))), F.lit(False))


# ---- bitmaps of one block


class Block:
    """Bitmaps of the rows' components above each attribute's minimum."""

    def __init__(self, vec_ids: np.ndarray, low: np.ndarray, slices: np.ndarray):
        self.vec_ids, self.low, self.slices = vec_ids, low, slices
        _, self.width, self.words = slices.shape
        self.valid = np.packbits(np.arange(self.words * 64) < len(vec_ids), bitorder="little").view(np.uint64)

    @classmethod
    def build(cls, vec_ids: np.ndarray, vectors: np.ndarray) -> Block:
        """Rows must be in order of their ids."""
        low = vectors.min(axis=0)
        above = (vectors - low).astype(np.uint64)
        width = max(1, int(above.max()).bit_length())
        bits = np.zeros((vectors.shape[1], width, -(-len(vec_ids) // 64) * 64), np.uint8)
        for b in range(width):
            bits[:, b, : len(vec_ids)] = ((above >> np.uint64(b)) & np.uint64(1)).T
        return cls(vec_ids, low, np.packbits(bits, axis=-1, bitorder="little").view(np.uint64))

    def score_slices(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of the scores, lowest first; what to add to them for the score).

        A negative component adds its size times what is missing to the attribute's
        greatest possible value, so that everything is a sum of bitmaps.
        """
        top = (1 << self.width) - 1
        negative = query < 0
        constant = sum(q * low for q, low in zip(query.tolist(), self.low.tolist())) + int(query[negative].sum()) * top
        size = np.abs(query)
        places: dict[int, list[np.ndarray]] = {}
        for shift in range(int(size.max(initial=0)).bit_length()):
            chosen = ((size >> shift) & 1).astype(bool)
            for flip in (False, True):
                rows = self.slices[chosen & (negative == flip)]
                if len(rows):
                    for b in range(self.width):
                        places.setdefault(shift + b, []).append(~rows[:, b] if flip else rows[:, b])
        return add_bitmaps({p: np.concatenate(v) for p, v in places.items()}, self.words), constant

    def top(self, query: np.ndarray, k: int, own: int | None) -> list[tuple[int, int]]:
        """(vec_id, score) of the k best rows other than ``own``; ties go to the smaller vec_id."""
        slices, constant = self.score_slices(query)
        rest = self.valid.copy()
        if own is not None:
            for row in np.flatnonzero(self.vec_ids == own):
                rest[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        sure = np.zeros_like(rest)
        taken = 0
        for bitmap in slices[::-1]:
            ones = rest & bitmap
            count = int(np.bitwise_count(ones).sum())
            if taken + count > k:
                rest = ones
            else:
                sure |= ones
                taken += count
                rest &= ~bitmap
        # Rows left over agree in every slice.  They are in order of vec_id, so the first ones win.
        rows = np.concatenate([_places(sure), _places(rest)[: k - taken]])
        scores = np.zeros(len(rows), object)
        for place, bitmap in enumerate(slices):
            scores += ((bitmap[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(object) << place
        return [(int(self.vec_ids[r]), int(s) + constant) for r, s in zip(rows, scores)]


def add_bitmaps(places: dict[int, np.ndarray], words: int) -> np.ndarray:
    """Sum of bitmaps, given by place value, as one bitmap per place.

    Three bitmaps of a place become one there and one at the next place.
    """
    out, place = [], 0
    carried: dict[int, list[np.ndarray]] = {p: [v] for p, v in places.items()}
    while carried:
        stack = carried.pop(place, None)
        rows = np.concatenate(stack) if stack else np.zeros((0, words), np.uint64)
        while len(rows) > 1:
            third = len(rows) // 3
            if third:
                a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                both = a ^ b
                carry = (a & b) | (both & c)
                rows = np.concatenate([both ^ c, rows[3 * third :]])
            else:
                carry = (rows[0] & rows[1])[None]
                rows = (rows[0] ^ rows[1])[None]
            carried.setdefault(place + 1, []).append(carry)
        out.append(rows[0] if len(rows) else np.zeros(words, np.uint64))
        place += 1
    return np.stack(out) if out else np.zeros((0, words), np.uint64)


def _places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


# ---- the search as a Spark job


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for every row that ``is_query`` picks, itself left out.

    Scores are inner products of the quantised vectors; ties go to the smaller id.
    Vectors that are null, empty, or hold null or non-finite components take no part,
    nor do vectors too long for scores of 64 bits (``LONGEST``) and rows without id.  Rows
    that share an id, or are equal, are each a candidate and, if asked, each a query; the answers of one
    id are ranked together, and no row of a query's own id is among them.  A
    query of another length than a block's vectors is matched with vectors of its own
    length only.  Other columns are left out.  An empty table gives an empty result.
    ``is_query`` reads the id as ``id``.
    """
    asked = df.filter(usable(F.col(vector_column), scale) & F.col(id_column).isNotNull())
    vectors = asked.select(F.col(id_column).cast("bigint").alias("id"), quantised(F.col(vector_column), scale).alias("v"))
    vectors = stored(vectors, "vectors")
    slots = max(1, -(-vectors.count() // block_rows))
    slotted = vectors.withColumn("slot", F.pmod(F.xxhash64("id", "v"), F.lit(slots)).cast("int"))
    rows = slotted.repartition(slots, "slot").sortWithinPartitions("slot", F.size("v"), "id")
    index = rows.select("slot", "id", "v").mapInArrow(_index_blocks(2 * block_rows), INDEX)

    queries = vectors.filter(is_query)
    groups = queries.count() // QUERY_ROWS + 1
    grouped = queries.withColumn("group", F.pmod(F.xxhash64("id", "v"), F.lit(groups))).repartition(groups, "group")
    gathered = grouped.groupBy("group").agg(F.collect_list(F.struct("id", "v")).alias("queries"))
    # The stated queries go to every slot of the index; rows never meet rows one by one.
    spread = gathered.select("queries", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    # Spark's size check counts the queries once and not once for each slot: unless told so, it may
    # gather them all in the driver to broadcast them.  A slot's search is long for its few bytes, so
    # the number of partitions is stated and small ones are not merged.
    apart, asking = (side.repartition(slots, "slot") for side in (index, spread))
    met = apart.join(asking.hint("merge"), "slot").select(
        "ids", "low", "slices", F.col("queries.id").alias("q_ids"), F.col("queries.v").alias("q")
    )
    found = met.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


INDEX = "slot int, ids binary, low binary, slices binary"


def _index_blocks(limit: int):
    """Rows of a slot, by length and id, to blocks of at most ``limit`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, ids, vectors = None, [], []

        def cut():
            block = Block.build(np.array(ids, "<i8"), np.array(vectors, "<i8"))
            parts = (block.vec_ids, block.low, block.slices)
            arrays = [pa.array([slot], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
            ids.clear()
            vectors.clear()
            return pa.RecordBatch.from_arrays(arrays, ["slot", "ids", "low", "slices"])

        for batch in batches:
            for now, one, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (now != slot or len(ids) >= limit or len(vector) != len(vectors[0])):
                    yield cut()
                slot = now
                ids.append(one)
                vectors.append(vector)
        if ids:
            yield cut()

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = None, None
        for batch in batches:
            for ids, low, slices, q_ids, queries in zip(*batch.columns, strict=True):
                vec_ids = np.frombuffer(ids.as_buffer(), "<i8")
                if held is None or not np.array_equal(held, vec_ids):
                    held, least = vec_ids.copy(), np.frombuffer(low.as_buffer(), "<i8").copy()
                    shape = (len(least), -1, -(-len(held) // 64))
                    block = Block(held, least, np.frombuffer(slices.as_buffer(), np.uint64).reshape(shape).copy())
                size = block.slices.shape[0]
                out: tuple[list, list, list] = ([], [], [])
                for own, query in zip(q_ids.as_py(), queries.as_py(), strict=True):
                    if len(query) != size:
                        continue
                    for vec_id, score in block.top(np.array(query, np.int64), k, own):
                        for column, value in zip(out, (own, vec_id, score), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"]
                )

    return run
