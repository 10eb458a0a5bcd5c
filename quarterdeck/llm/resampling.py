"""Importance resampling towards a target distribution by hashed word runs.

One 256-byte table lower-cases A-Z and blanks separators in a text's UTF-8; splitting
at blanks gives the words.  A run of words is hashed by crc32, chained from word to
word, so a run costs no more than its last word.  Counters reduce a task's runs to
buckets, Spark adds the buckets of all tasks up.  A document's weight is the sum of the
log gains of its runs; with Gumbel noise from a hash of its id, the highest scores are
a draw without replacement by weight.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.fill_middle import seeded
from quarterdeck.llm.shared import stored, text_or_empty

BUCKETS = 10_000
UNITS = 1 << 32  # values of eight hex digits

# A-Z become a-z; digits, letters and all bytes of other characters stay; the rest is blank.
TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split()


def run_hashes(words: list[bytes], longest: int) -> Iterator[list[int]]:
    """crc32 of all runs of 1, 2, ... ``longest`` words joined by a blank, one list for each length."""
    hashes = list(map(crc32, words))
    yield hashes
    for extra in range(1, longest):
        seeds = map(crc32, repeat(b" "), hashes)
        hashes = list(map(crc32, words[extra:], seeds))
        yield hashes


def run_buckets(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of every run, repeats included."""
    parts = [np.fromiter(h, np.int64, len(h)) for h in run_hashes(words, longest)]
    return np.concatenate(parts) % buckets


def bucket_counts(df: DataFrame, text_column: str, longest: int, buckets: int) -> dict[int, int]:
    """Runs of all texts by bucket.  Tasks send at most ``buckets`` rows each, and so many reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(run_buckets(words_of(text.as_py()), longest, buckets).tolist())
        if counts:
            arrays = [pa.array(list(c), pa.int64()) for c in (counts.keys(), counts.values())]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "n"])

    found = df.select(text_or_empty(text_column).alias("text")).mapInArrow(count, "bucket long, n long")
    return dict(found.groupBy("bucket").agg(F.sum("n").alias("n")).collect())


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Per bucket the floor of 1000 times the log of its smoothed share in the target over that in the source."""
    in_source, in_target = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    shares = (
        float(target.get(b, 0) + 1) * in_source / (float(source.get(b, 0) + 1) * in_target) for b in range(buckets)
    )
    return np.array([math.floor(1000 * math.log(share)) for share in shares], np.int64)


def weighed(df: DataFrame, gain: np.ndarray, id_column: str, text_column: str, longest: int) -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    kind = df.schema[id_column].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                words = words_of(text.as_py())
                found = run_buckets(words, longest, len(gain))
                rows.append((len(words), len(found), int(gain[found].sum())))
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n_words", "n_features", "weight"])

    asked = df.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return asked.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def first_places(rows: DataFrame, order: list, count: int) -> DataFrame:
    """``rows`` with ``rank``, from 1 in the given order, null beyond ``count``.

    Rows are dealt out by ranges of the order and sorted there; the sizes of the ranges, one number
    for each partition, give where each begins.  No task sees more than its range.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("place", F.monotonically_increasing_id()), "places")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    begins, total = [], 0
    for size in sizes:
        begins.append((size.part, total))
        total += size.n
    offsets = rows.sparkSession.createDataFrame(begins, "part long, begin long")
    place = F.col("begin") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    joined = placed.join(F.broadcast(offsets), part == F.col("part"))
    return joined.select(*rows.columns, F.when(place <= count, place).alias("rank"))


def importance_resample(
    df: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """One row per input row: (id, n_features, weight, score, rank).

    Of the rows with at least ``least_words`` words ``percent`` percent, rounded down, are drawn
    without replacement, towards the texts of ``target``; ``rank`` is their place by falling score, ties
    by smaller id, null for all others.  ``n_features`` counts the runs of 1 to ``longest`` words.

    A null text has no words and weight 0; a null id has the noise of the empty string and comes last
    among ties.  Rows that share an id share the noise; equal rows have ranks of their own,
    in no fixed order.  Whole texts are counted, however long; one is worked on at a time.  Other
    columns are left out, so their names cannot clash.  Empty tables, of documents or of
    targets, give results like any others: the counts are smoothed by one.
    """
    source = bucket_counts(df, text_column, longest, buckets)
    wanted = bucket_counts(target, target_column, longest, buckets)
    rows = weighed(df, gains(source, wanted, buckets), id_column, text_column, longest)
    uniform = (seeded("id", seed, 1) + F.lit(0.5)) / F.lit(float(UNITS))
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log(uniform)))
    scored = stored(
        rows.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id()), "scores"
    )
    enough = F.col("n_words") >= least_words
    able = scored.filter(enough)
    drawn = able.count() * percent // 100
    # The row settles ties of all else, and lets a range of equal rows be cut.
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ranked = first_places(able, order, drawn)
    others = scored.filter(~enough).withColumn("rank", F.lit(None).cast("long"))
    both = ranked.unionByName(others)
    return both.select(F.col("id").alias(id_column), "n_features", "weight", "score", "rank")
