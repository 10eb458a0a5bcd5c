"""Fill-in-the-middle: cuts found by an indexable skip list over the units of a text.

The units are runs of ASCII letters and single other characters.  Every link of the
list, on the lowest lane and on the express lanes above, carries two widths: the units
it skips and the code points they hold.  Going down from the highest lane and adding up
widths leads to the unit of any rank, and to its place in the text, without counting
through the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import SLICE_CHARS, free_name, text_or_empty

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

LANE_STEP = 8  # links of a lane under one express link, on average
TOP_LINKS = 16  # a lane this short needs no lane above it


def unit_widths(text: str) -> np.ndarray:
    """Code points of every unit; numpy's arrays are made for one slice of the text at a time."""
    starts, inside = [], False
    for at in range(0, len(text), SLICE_CHARS):
        points = np.frombuffer(text[at : at + SLICE_CHARS].encode("utf-32-le"), "<u4")
        folded = points | 32
        letter = (folded >= ord("a")) & (folded <= ord("z"))
        goes_on = np.concatenate([[inside], letter[:-1]]) & letter
        starts.append(np.flatnonzero(~goes_on) + at)
        inside = bool(letter[-1])
    return np.diff(np.concatenate([*starts, [len(text)]])) if starts else np.zeros(0, np.int64)


def tosses(count: int, lane: int) -> np.ndarray:
    """For each link of a lane whether an express link begins there: a fixed hash of its place, one in ``LANE_STEP``."""
    mixed = (np.arange(count, dtype=np.uint64) + np.uint64(1 + lane)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) % np.uint64(LANE_STEP) == 0


class SkipList:
    """An indexable skip list over units of the given widths in code points.

    ``lanes`` go from the lowest to the highest; a lane is (units skipped, code points
    skipped, place on the lane below) of its links.
    """

    def __init__(self, widths: np.ndarray):
        units, points = np.ones(len(widths), np.int64), widths.astype(np.int64)
        self.lanes = [(units, points, None)]
        while len(units) > TOP_LINKS:
            begins = tosses(len(units), len(self.lanes))
            begins[0] = True
            below = np.flatnonzero(begins)
            if len(below) == len(units):
                break
            units, points = np.add.reduceat(units, below), np.add.reduceat(points, below)
            self.lanes.append((units, points, below))

    def __len__(self) -> int:
        return len(self.lanes[0][0])

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        place = total = 0
        for depth in range(len(self.lanes) - 1, -1, -1):
            units, points, below = self.lanes[depth]
            while place < len(units) and units[place] <= rank:
                rank -= int(units[place])
                total += int(points[place])
                place += 1
            if below is not None:
                place = int(below[place]) if place < len(below) else len(self.lanes[depth - 1][0])
        return total


def seeded(id_column: str, seed: int, group: int) -> Column:
    """The ``group``-th eight hex digits, from 1, of sha256 of ``seed:id``; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 8 * group - 7, 8), 16, 10).cast("long")


CUTS = pa.schema([("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])


def _cut(batches):
    for batch in batches:
        columns: list[list[int]] = [[], [], []]
        draws = zip(*(batch.column(name).to_pylist() for name in ("first", "second")), strict=True)
        for text, (first, second) in zip(batch.column("text"), draws, strict=True):
            units = SkipList(unit_widths(text.as_py()))
            ranks = sorted((first % (len(units) + 1), second % (len(units) + 1)))
            begin, end = map(units.points_before, ranks)
            for column, value in zip(columns, (len(units), begin, end - begin), strict=True):
                column.append(value)
        arrays = [pa.array(c, pa.int64()) for c in columns]
        kept = [batch.column(name) for name in ("id", "text", "third", "fourth")]
        yield pa.RecordBatch.from_arrays([*kept, *arrays], ["id", "text", "third", "fourth", *CUTS.names])


def fill_in_middle(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 1,
    rate: int = 90,
    suffix_first_rate: int = 20,
) -> DataFrame:
    """One row per input row: (id, n, form, prefix_chars, middle_chars, output).

    ``n`` counts the units.  Two draws from a hash of the id cut the text after so many
    units.  ``rate`` percent of the documents are transformed, ``suffix_first_rate`` percent
    of those into form spm (suffix, prefix, middle), the others into psm (prefix, suffix,
    middle); the rest, empty texts and texts that hold one of the three marks are ``plain``
    and stay as they are, without lengths.

    A null text counts as empty, a null id as the empty string.  Rows that share an id are
    cut by the same draws, equal rows alike.  A very long text is worked on alone, in slices;
    memory follows the longest text.  Other columns are left out, so their names cannot
    clash.  An empty table gives an empty result.
    """
    kind = df.schema[id_column].dataType.simpleString()
    draws = [seeded(id_column, seed, i).alias(n) for i, n in enumerate(("first", "second", "third", "fourth"), 1)]
    asked = df.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"), *draws)
    cut = asked.mapInArrow(
        _cut, f"id {kind}, text string, third long, fourth long, n long, prefix_chars long, middle_chars long"
    )
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(mark)
    plain = (F.col("text") == "") | marked | (F.col("third") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("fourth") % 100 < suffix_first_rate, "spm").otherwise("psm")
    prefix = F.substring("text", F.lit(1), F.col("prefix_chars").cast("int"))
    middle = F.substring("text", (F.col("prefix_chars") + 1).cast("int"), F.col("middle_chars").cast("int"))
    suffix = F.substring("text", (F.col("prefix_chars") + F.col("middle_chars") + 1).cast("int"), F.length("text"))
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    known = F.col("form") != "plain"
    return cut.withColumn("form", form).select(
        F.col("id").alias(id_column),
        "n",
        "form",
        F.when(known, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(known, F.col("middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def with_restored(df: DataFrame, name: str = "restored") -> DataFrame:
    """Adds the text that (form, output) were made of; a null output gives null.

    The marks occur nowhere else: no mark begins inside another or across its edge, and
    texts that held one stayed plain.
    """
    first, second, third = (free_name(df.columns, n) for n in ("first_piece", "second_piece", "third_piece"))
    body = F.substring("output", F.lit(len(PREFIX) + 1), F.length("output"))

    inner = F.when(F.col("form") == "psm", SUFFIX).otherwise(PREFIX)
    at = F.call_function("locate", inner, body)
    rest = F.substring(body, at + len(MIDDLE), F.length(body))
    end = F.call_function("locate", F.lit(MIDDLE), rest)
    pieces = {
        first: F.substring(body, F.lit(1), at - 1),
        second: F.substring(rest, F.lit(1), end - 1),
        third: F.substring(rest, end + len(MIDDLE), F.length(rest)),
    }
    restored = (
        F.when(F.col("form") == "plain", F.col("output"))
        .when(F.col("form") == "psm", F.concat(first, third, second))
        .otherwise(F.concat(second, third, first))
    )
    return df.withColumns(pieces).withColumn(name, restored).drop(first, second, third)
