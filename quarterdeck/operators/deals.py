"""Deals and their activity log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.scores import engagement
from quarterdeck.functions.text import strip
from quarterdeck.operators.contracts import day_or_fail, key_or_fail, require_columns
from quarterdeck.params import ActivityRules
from quarterdeck.sources.writers import Keep, not_kept

# Column names of the exports.
DEAL_COLUMNS = ("deal_id", "stage", "close_date", "arr", "rep_name", "account_name")
ACTIVITY_COLUMNS = ("deal_id", "activity_type", "activity_date", "contact_role")


def normalize_deals(raw: DataFrame) -> DataFrame:
    """Trimmed text, whole-number value; an empty deal id fails the load."""
    require_columns(raw, [*DEAL_COLUMNS, "ordinal"])
    text = {name: strip(F.col(name).cast("string")) for name in ("stage", "close_date", "rep_name", "account_name")}
    return raw.select(
        key_or_fail("deal_id").alias("deal_id"),
        text["stage"].alias("stage"),
        text["close_date"].alias("close_date"),
        F.col("arr").cast("long").alias("arr"),
        text["rep_name"].alias("rep_name"),
        text["account_name"].alias("account_name"),
        "ordinal",
    )


def one_row_per_deal(deals: DataFrame) -> DataFrame:
    """Each deal once: attributes of its last row, ``first_seen`` of its first.

    Both come from one aggregation that is combined before the shuffle.
    """
    attributes = ("stage", "close_date", "arr", "rep_name", "account_name")
    return (
        deals.groupBy("deal_id")
        .agg(F.min("ordinal").alias("first_seen"), F.max_by(F.struct(*attributes), "ordinal").alias("last"))
        .select("deal_id", "first_seen", "last.*")
    )


def deal_order(deals: DataFrame) -> DataFrame:
    """Unique deal ids in order of first occurrence."""
    return deals.groupBy("deal_id").agg(F.min("ordinal").alias("first_seen")).orderBy("first_seen")


def requested_keys(ids: DataFrame, key: str = "deal_id") -> DataFrame:
    """Trimmed keys without the blank ones."""
    trimmed = ids.withColumn(key, strip(F.col(key).cast("string")))
    return trimmed.filter(F.col(key) != "")


def activity_counts(log: DataFrame) -> DataFrame:
    """Activities and latest day by deal; one bad date fails the whole batch."""
    require_columns(log, ACTIVITY_COLUMNS)
    parsed = log.select(
        strip(F.col("deal_id").cast("string")).alias("deal_id"),
        day_or_fail("activity_date").alias("activity_day"),
    )
    return parsed.groupBy("deal_id").agg(
        F.count("*").alias("activity_count"),
        F.max("activity_day").alias("last_activity_date"),
    )


def max_activity(requested: DataFrame, counts: DataFrame) -> DataFrame:
    """One row: the largest count among the requested deals, 0 without any."""
    among = counts.join(requested.select("deal_id"), "deal_id", "left_semi")
    return among.agg(F.coalesce(F.max("activity_count"), F.lit(0).cast("long")).alias("max_count"))


def activity_signals(
    requested: DataFrame, log: DataFrame, as_of: dt.date | Column, rules: ActivityRules, keep: Keep = not_kept
) -> DataFrame:
    """``requested`` with engagement and gap; a deal without activity scores 0 with a gap.

    The counts by deal are used twice, for the deal and for the largest among all; with ``keep``
    the log is read once.
    """
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    counts = keep(activity_counts(log), "activity_counts")
    known = F.col("activity_count").isNotNull()
    score = engagement(F.col("days_since_last"), F.col("activity_count"), F.col("_max_count"), rules)
    joined = (
        requested.join(counts, "deal_id", "left")
        .withColumn("_max_count", max_activity(requested, counts).scalar())
        .withColumn("days_since_last", F.datediff(today, F.col("last_activity_date")))
    )
    return joined.withColumns(
        {
            "engagement_score": F.when(known, score).otherwise(F.lit(0.0)),
            "activity_gap_flag": F.coalesce(F.col("days_since_last") > rules.gap_days, F.lit(True)),
            "activity_count": F.coalesce("activity_count", F.lit(0).cast("long")),
        }
    ).drop("_max_count")
