"""Screening and redaction of text tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.text import first_topic, redact_email, redact_phone
from quarterdeck.params import BLOCKED_TOPICS, PII_KINDS


def redact_pii(df: DataFrame, column: str, kinds: Sequence[str] = PII_KINDS) -> DataFrame:
    """Adds ``sanitized_text``, ``redacted`` and ``pii_types``.

    E-mail addresses go first, then phone numbers in what is left.  A mark always
    differs from what it replaces, so a changed text tells that a kind was found
    and no pattern runs twice.
    """
    kinds = {k.lower().strip() for k in kinds}
    out = df.withColumn("_plain", F.coalesce(F.col(column), F.lit("")))
    out = out.withColumn("_mailed", redact_email(F.col("_plain")) if "email" in kinds else F.col("_plain"))
    out = out.withColumn("sanitized_text", redact_phone(F.col("_mailed")) if "phone" in kinds else F.col("_mailed"))
    found = F.array_compact(
        F.array(
            F.when(F.col("_mailed") != F.col("_plain"), F.lit("email")),
            F.when(F.col("sanitized_text") != F.col("_mailed"), F.lit("phone")),
        )
    )
    return (
        out.withColumn("pii_types", found)
        .withColumn("redacted", F.size("pii_types") > 0)
        .drop("_plain", "_mailed")
    )


def screen_topics(df: DataFrame, column: str, topics: Sequence[str] = BLOCKED_TOPICS) -> DataFrame:
    """Adds ``matched_topic`` (null when none) and ``allowed``; empty text is allowed."""
    lowered = df.withColumn("_lowered", F.lower(F.coalesce(F.col(column), F.lit(""))))
    return (
        lowered.withColumn("matched_topic", first_topic(F.col("_lowered"), topics))
        .withColumn("allowed", F.col("matched_topic").isNull())
        .drop("_lowered")
    )
