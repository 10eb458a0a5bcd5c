"""Joins of a large table with a per-key table when some keys hold many of the rows.

Spark's adaptive execution splits hot keys of a plain join by their measured size; that
is enough wherever nothing above the join needs the rows of a key together.  ``salted_join``
is for the other joins: it cuts hot keys into parts before the shuffle.  ``may_hold`` tells which rows need no join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one part.  The more rows a table has, the more parts a hot key is cut into.
PART_ROWS = 500_000
# The most frequent keys that are looked at.  Their list is bounded and may be broadcast.
MAX_HOT_KEYS = 2048


def hot_keys(large: DataFrame, keys: Sequence[str], part_rows: int = PART_ROWS, max_hot: int = MAX_HOT_KEYS) -> DataFrame:
    """(_hash, _parts) of the frequent keys with more than ``part_rows`` rows: key hash and number of parts.

    Found by one sketch of bounded size over the key columns.  Its counts are estimates:
    they decide how rows are spread and never which rows meet.
    """
    item = F.when(_all_present(keys), F.xxhash64(*keys))
    sketch = F.call_function("approx_top_k", item, F.lit(max_hot), F.lit(8 * max_hot))
    found = large.agg(sketch.alias("top")).select(F.inline("top")).filter("item IS NOT NULL")
    parts = F.ceil(F.col("count") / F.lit(part_rows)).cast("int")
    return found.select(F.col("item").alias("_hash"), parts.alias("_parts")).filter("_parts > 1")


def salted_join(
    large: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    spread_on: Sequence[str | Column],
    how: str = "left",
    part_rows: int = PART_ROWS,
    max_hot: int = MAX_HOT_KEYS,
) -> DataFrame:
    """``large`` joined with ``per_key``, each hot key cut into parts by a hash of ``spread_on``.

    A part has about ``part_rows`` rows.  Only the rows of hot keys in ``per_key`` are
    repeated, once per part.  Rows without a key match nothing and are spread as well.
    The parts come from row values, so a rerun task sends each row to the same place.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(large, keys, part_rows, max_hot))
    parts = F.when(~_all_present(keys), F.lit(max_hot)).otherwise(F.coalesce("_parts", F.lit(1)))
    spread = F.pmod(F.xxhash64(*spread_on), parts).cast("int")
    hashed = F.xxhash64(*keys)
    left = large.withColumn("_hash", hashed).join(hot, "_hash", "left").withColumn("_part", spread)
    right = (
        per_key.withColumn("_hash", hashed)
        .join(hot, "_hash", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
    )
    helpers = ("_hash", "_parts")
    return left.drop(*helpers).join(right.drop(*helpers), [*keys, "_part"], how).drop("_part")


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


MAP_BITS = 1 << 24  # of the map of keys
PART_BITS = 1 << 15  # of a bitmap of Spark's


def may_hold(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` and the column ``flag``: false only where ``key`` is not among those of ``keys``, so such rows need not be moved.

    One bit map of 2 MB at most goes to all tasks, whatever the size of the tables.
    """
    bit = keys.select(_bit(key).alias("bit"))
    part, place = F.floor(F.col("bit") / PART_BITS), F.col("bit") % PART_BITS
    part_name, map_name = free_name(rows.columns, "part"), free_name(rows.columns, "map")
    maps = bit.groupBy(part.alias(part_name)).agg(F.bitmap_construct_agg(place).alias(map_name))
    at = _bit(key)
    byte = F.substring(F.col(map_name), (F.floor(at % PART_BITS / 8) + 1).cast("int"), F.lit(1))
    known = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    joined = rows.join(F.broadcast(maps), F.floor(at / PART_BITS) == F.col(part_name), "left")
    return joined.withColumn(flag, F.coalesce(known, F.lit(False))).drop(part_name, map_name)


def _bit(key: str):
    return F.pmod(F.xxhash64(key), F.lit(MAP_BITS))


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
