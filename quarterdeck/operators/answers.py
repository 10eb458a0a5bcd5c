"""Tables of model answers to typed columns, with a reason where an answer is unusable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.answers import answer_json, fenced_json, object_only, text_field


def parse_benchmarks(answers: DataFrame, text: str) -> DataFrame:
    """Adds benchmark_growth_pct, source_summary, confidence, ok and error."""
    parsed = answers.withColumn("_payload", answer_json(F.col(text)))
    growth = F.try_variant_get(F.col("_payload"), "$.benchmark_growth_pct", "double")
    return (
        parsed.withColumn("benchmark_growth_pct", growth)
        .withColumn("source_summary", text_field(F.col("_payload"), "source_summary", ""))
        .withColumn("confidence", text_field(F.col("_payload"), "confidence", "low"))
        .withColumn(
            "error",
            F.when(F.col("_payload").isNull(), F.lit("no JSON object found"))
            .when(F.col("benchmark_growth_pct").isNull(), F.lit("benchmark_growth_pct missing"))
            .otherwise(F.lit("")),
        )
        .withColumn("ok", F.col("error") == "")
        .drop("_payload")
    )


def parse_actions(answers: DataFrame, text: str, action_count: int) -> DataFrame:
    """Adds actions_json, narrative, ok and error; the action count must match exactly."""
    parsed = (
        answers.withColumn("_payload", fenced_json(F.col(text)))
        .withColumn("_actions", F.try_variant_get(F.col("_payload"), "$.actions", "array<variant>"))
        .withColumn("_field", F.try_variant_get(F.col("_payload"), "$.narrative", "variant"))
        .withColumn(
            "_narrative",
            F.when(F.schema_of_variant("_field") == "STRING", F.try_variant_get("_field", "$", "string")),
        )
    )
    count = F.coalesce(F.when(F.col("_actions").isNotNull(), F.size("_actions")), F.lit(0))
    return (
        parsed.withColumn("action_count", count)
        .withColumn(
            "error",
            F.when(F.col("_payload").isNull(), F.lit("no JSON object found"))
            .when(
                F.col("_actions").isNull() | (F.col("action_count") != action_count),
                F.concat(F.lit(f"expected {action_count} actions, got "), F.col("action_count")),
            )
            .when(F.trim(F.coalesce("_narrative", F.lit(""))) == "", F.lit("narrative missing or empty"))
            .otherwise(F.lit("")),
        )
        .withColumn("ok", F.col("error") == "")
        .withColumn("actions_json", F.when(F.col("ok"), F.to_json("_actions")))
        .withColumn("narrative", F.when(F.col("ok"), F.col("_narrative")))
        .drop("_payload", "_actions", "_field", "_narrative")
    )


# Fields of a competitor signal and their defaults.
SIGNAL_DEFAULTS = {
    "g2_sentiment": "mixed",
    "g2_summary": "",
    "pricing_signal": "",
    "threat_level": "medium",
    "headline": "",
}


def parse_signals(answers: DataFrame, text: str) -> DataFrame:
    """Adds the signal fields with their defaults, recent_launches as text list, and ok."""
    parsed = answers.withColumn("_payload", object_only(answer_json(F.col(text))))
    launches = F.transform(
        F.try_variant_get(F.col("_payload"), "$.recent_launches", "array<variant>"),
        lambda v: F.try_variant_get(v, "$", "string"),
    )
    fields = {name: text_field(F.col("_payload"), name, default) for name, default in SIGNAL_DEFAULTS.items()}
    fields["recent_launches"] = F.coalesce(launches, F.array().cast("array<string>"))
    fields["ok"] = F.col("_payload").isNotNull()
    return parsed.withColumns(fields).drop("_payload")
