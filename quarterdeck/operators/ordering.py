"""Positions and first rows within groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def positions(
    df: DataFrame,
    group: Sequence[str],
    blocks: Sequence[Column],
    order: Sequence[str | Column],
    position: str = "position",
    total: str | None = None,
) -> DataFrame:
    """0-based position of every row in its group, and optionally the group size.

    ``blocks`` are ever finer pieces of the sort order, coarsest first: rows sort
    by the blocks and then by ``order`` inside the last block.  Rows are counted
    per block (combined before the shuffle), the counts are summed up block by
    block, and only the rows of one finest block are ever sorted together.  So a
    group may be as large as the table.  Rows without a key form a group like any
    other, and rows without a block sort first.
    """
    group = list(group)
    names = [f"_block{i}" for i in range(len(blocks))]
    blocked = df.withColumns(dict(zip(names, blocks, strict=True)))
    counts = blocked.groupBy(*group, *names).agg(F.count("*").alias("_n"))

    # From the finest block up: rows before this block within its parent.
    level = counts
    steps = []
    for depth in range(len(names), 0, -1):
        parent = names[: depth - 1]
        ordered = Window.partitionBy(*group, *parent).orderBy(names[depth - 1])
        running = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = level.withColumn(f"_before{depth}", running - F.col("_n"))
        if depth == 1 and total:
            found = found.withColumn(total, F.sum("_n").over(Window.partitionBy(*group)))
        steps.append(found.drop("_n"))
        if depth > 1:
            level = level.groupBy(*group, *parent).agg(F.sum("_n").alias("_n"))
    starts = steps[-1]
    for depth in range(2, len(names) + 1):
        starts = _null_safe_join(steps[len(names) - depth], starts, [*group, *names[: depth - 1]])
    start = sum((F.col(f"_before{d}") for d in range(1, len(names) + 1)), F.lit(0))
    starts = starts.select(*group, *names, start.alias("_start"), *([total] if total else []))

    # One key that is never null, nulls inside it being equal: the window and the join share one shuffle of the rows.
    place = F.struct(*group, *names)
    inside = Window.partitionBy("_place").orderBy(*order)
    numbered = blocked.withColumn("_place", place).drop(*names).withColumn("_row", F.row_number().over(inside))
    starts = starts.select(place.alias("_place"), "_start", *([total] if total else []))
    placed = numbered.join(starts, "_place")
    return placed.withColumn(position, F.col("_start") + F.col("_row") - 1).drop("_row", "_start", "_place")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which null keys are equal; the keys come from the left side."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, same).drop(*(f"_right_{k}" for k in keys))


def ordinal_blocks(ordinal: str | Column) -> list[Column]:
    """Blocks for a unique whole-number order: at most 2^16 rows in the finest."""
    value = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return [F.shiftright(value, 36), F.shiftright(value, 16)]


def head_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows of each group, with their rank from 1 if named.

    Spark limits each group once more before the shuffle, so a map task forwards at
    most ``n`` rows of a group however large it is.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    name = rank or "_row"
    first = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return first if rank else first.drop(name)
