"""Exact de-duplication by progressive refinement, with Spark's own functions.

Texts that share their length with no other are done; of the rest, texts that share
length and the hash of a prefix with no other are done; only the full hashes of what is
left are held against each other.  All three are taken as a text is read, so no text is
shuffled: a row is its id, length and hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import free_name, may_hold, stored, text_or_empty

PREFIX_CHARS = 256


def surviving_keys(rows: DataFrame) -> DataFrame:
    """(size, prefix) that two of ``rows`` share at least; copies are counted where they are read."""
    sizes = rows.groupBy("size").count().filter("count > 1").select("size")
    prefixes = rows.groupBy("size", "prefix").count().filter("count > 1")
    return prefixes.join(sizes, "size", "left_semi").select("size", "prefix")


def equal_groups(rows: DataFrame) -> DataFrame:
    """(digest, best, n) of the texts that stand in more than one of ``rows``; ``best`` is the row that stays."""
    best = F.max(F.struct("id", "row")).alias("best")
    refined = rows.join(surviving_keys(rows), ["size", "prefix"], "left_semi")
    return refined.groupBy("digest").agg(best, F.count("*").alias("n")).filter("n > 1")


def hashed_rows(df: DataFrame, id_column: str, text_column: str, prefix_chars: int) -> DataFrame:
    """(id, size, prefix, digest, row) of every row, stored: the one pass over the texts."""
    text = text_or_empty(text_column)
    rows = df.select(
        F.col(id_column).alias("id"),
        F.octet_length(text).alias("size"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
    )
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "exact")


def exact_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when their bytes are; a null text counts as empty, a very long one is
    hashed whole.  Of equal texts the row with the largest id stays, a null id counting as
    the smallest; of rows that also share the id one stays.  ``text_sha256`` is given for
    every row; that of a text that dropped out early is compared with nothing.
    Other columns are left out.  An empty table gives an empty result.
    """
    rows = hashed_rows(df, id_column, text_column, prefix_chars)
    groups = equal_groups(rows)
    # Most rows have no equal: they pass by the join, which takes the others only.
    marked = may_hold(rows, groups, "digest", "may")
    alone = marked.filter("NOT may").drop("may").withColumns(
        {"best": F.lit(None).cast(groups.schema["best"].dataType), "n": F.lit(None).cast("long")}
    )
    decided = marked.filter("may").drop("may").join(groups, "digest", "left").unionByName(alone)
    return decided.select(
        F.col("id").alias(id_column),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The input without the rows that ``exact_duplicates`` drops, all columns kept.

    Rows without an equal stay where they are; only those of groups are moved, to the id that stays.
    """
    groups = equal_groups(hashed_rows(df, id_column, text_column, prefix_chars))
    digest, may, stay_id, stay_digest = (free_name(df.columns, n) for n in ("digest", "may", "stay_id", "stay_digest"))
    stay = groups.select(F.col("best.id").alias(stay_id), F.col("digest").alias(stay_digest))
    rows = df.withColumn(digest, F.unhex(F.sha2(text_or_empty(text_column).cast("binary"), 256)))
    marked = may_hold(rows, stay.withColumnRenamed(stay_digest, digest), digest, may)
    alone = marked.filter(~F.col(may)).drop(may, digest)
    found = marked.filter(may).drop(may)
    joined = found.join(stay, found[digest] == stay[stay_digest], "left")
    best = F.col(stay_digest).isNull() | F.col(id_column).eqNullSafe(F.col(stay_id))
    # A pair of id and text may stand in several rows, of which one stays; a row falsely marked has no other.
    one = joined.filter(best).dropDuplicates([id_column, digest]).select(*df.columns)
    return one.unionByName(alone)
