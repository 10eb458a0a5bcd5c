"""Deal health: assembly of all signals, hand-offs, prompts and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import report
from quarterdeck.functions.scores import deal_health, slip_risk
from quarterdeck.operators.guardrails import redact_pii
from quarterdeck.params import PII_KINDS, HealthRules


# Signal columns and their types, for runs in which a signal is not available.
SIGNALS = {
    "engagement_score": "double",
    "activity_gap_flag": "boolean",
    "sentiment_score": "double",
    "tone_trajectory": "double",
    "sentiment_decline_flag": "boolean",
    "retrieval_ok": "boolean",
    "context_block": "string",
}


def score_health(deals: DataFrame, rules: HealthRules, pii_kinds: tuple[str, ...] = PII_KINDS) -> DataFrame:
    """Health, slip risk, hand-off flag and redacted context beside the signal columns.

    Any signal may be absent or null: no activity counts as engagement 0 with a
    gap, no sentiment as neutral, no context as empty text.
    """
    absent = {name: F.lit(None).cast(kind) for name, kind in SIGNALS.items() if name not in deals.columns}
    joined = deals.withColumns(absent) if absent else deals
    health = deal_health(
        F.coalesce("engagement_score", F.lit(0.0)),
        F.coalesce("sentiment_score", F.lit(0.0)),
        F.coalesce("activity_gap_flag", F.lit(True)),
        rules,
    )
    scored = (
        joined.withColumn("deal_health_score", health)
        .withColumn("slip_risk_score", slip_risk(F.col("deal_health_score")))
        .withColumn("handoff_triggered", F.col("slip_risk_score") > rules.handoff_trigger)
        .withColumn("deal_intel_ok", F.coalesce("retrieval_ok", F.lit(False)))
    )
    redacted = redact_pii(scored, "context_block", pii_kinds)
    return redacted.withColumnRenamed("sanitized_text", "rag_summary_redacted").drop(
        "context_block", "retrieval_ok", "pii_types", "redacted"
    )


def assemble_deals(
    deals: DataFrame,
    activity: DataFrame | None,
    sentiment: DataFrame | None,
    context: DataFrame | None,
    rules: HealthRules,
    pii_kinds: tuple[str, ...] = PII_KINDS,
) -> DataFrame:
    """Signal tables that were computed apart, joined to their deals and scored.

    A missing table, or a deal missing from one, leaves its signals null.
    """
    joined = deals
    for signals in (activity, sentiment, context):
        if signals is not None:
            joined = joined.join(signals, "deal_id", "left")
    return score_health(joined, rules, pii_kinds)


def handoffs(scored: DataFrame, rules: HealthRules) -> DataFrame:
    """Deals strictly above the trigger."""
    return scored.filter(F.col("slip_risk_score") > rules.handoff_trigger)


def batch_counts(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("scored"), F.count_if("handoff_triggered").alias("handed_off"))


def forecast_prompts(scored: DataFrame, rules: HealthRules) -> DataFrame:
    """One prompt per handed-off deal, for a later batch step outside Spark."""
    return prompt_rows(handoffs(scored, rules), rules)


def prompt_rows(due: DataFrame, rules: HealthRules) -> DataFrame:
    """The prompts of deals that were picked before; no score is looked at again."""
    values = {
        name: F.col(name)
        for name in (
            "deal_id",
            "slip_risk_score",
            "account_name",
            "stage",
            "close_date",
            "arr",
            "rep_name",
            "engagement_score",
            "sentiment_score",
            "tone_trajectory",
        )
    }
    values |= {name: report.yes_no(F.col(name)) for name in ("activity_gap_flag", "sentiment_decline_flag")}
    values |= {"handoff_trigger": F.lit(rules.handoff_trigger), "rag_summary": F.col("rag_summary_redacted")}
    return due.select("deal_id", "slip_risk_score", report.fill_lines(report.FORECAST_PROMPT, values).alias("prompt"))


def adjustment_sections(scored: DataFrame, answers: DataFrame) -> DataFrame:
    """Report section of each written answer; ``answers`` has (deal_id, markdown)."""
    title = {"deal_id": F.col("deal_id"), "account": F.coalesce(F.nullif("account_name", F.lit("")), "deal_id")}
    section = F.concat(report.fill(report.ADJUSTMENT_TITLE, title), F.lit("\n\n"), F.col("markdown"))
    written = answers.filter(F.coalesce("markdown", F.lit("")) != "")
    return (
        scored.select("deal_id", "account_name")
        .join(written, "deal_id")
        .select("deal_id", section.alias("forecast_adjustment_md"))
    )


def report_rows(scored: DataFrame) -> DataFrame:
    """One table line per deal, with its place in deal order."""
    cells = [
        F.col("deal_id"),
        F.coalesce("account_name", F.lit("")),
        F.coalesce("stage", F.lit("")),
        report.two_decimals("deal_health_score"),
        report.two_decimals("slip_risk_score"),
        report.yes_no(F.col("activity_gap_flag")),
        report.yes_no(F.col("sentiment_decline_flag")),
        report.yes_no(F.col("handoff_triggered")),
    ]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    return scored.select("first_seen", line.alias("value"))


def report_lines(scored: DataFrame, query: str, generated: str, adjustments: DataFrame | None = None) -> DataFrame:
    """The whole report as ordered lines (part, place, value).

    ``adjustments`` has (deal_id, forecast_adjustment_md); deals without text are
    left out, and a note stands in when none has any.
    """
    spark = scored.sparkSession

    def fixed(part: int, lines: list[str]) -> DataFrame:
        rows = [(part, i, line) for i, line in enumerate(lines)]
        return spark.createDataFrame(rows, "part int, place long, value string")

    top = [
        report.REPORT_TITLE,
        "",
        f"Generated: {generated}",
        f"Query: {query}",
        "",
        report.REPORT_SUMMARY,
        "",
        report.REPORT_HEADER,
        report.REPORT_RULE,
    ]
    body = report_rows(scored).select(F.lit(1).alias("part"), F.col("first_seen").cast("long").alias("place"), "value")
    lines = fixed(0, top).unionByName(body).unionByName(fixed(2, ["", report.REPORT_ADJUSTMENTS, ""]))
    note = fixed(3, [report.REPORT_NO_HANDOFFS])
    if adjustments is not None:
        written = adjustments.filter(F.trim(F.coalesce("forecast_adjustment_md", F.lit(""))) != "")
        order = scored.select("deal_id", F.col("first_seen").cast("long").alias("place"))
        texts = written.join(order, "deal_id").select(F.lit(3).alias("part"), "place", "forecast_adjustment_md")
        first = texts.agg(F.min("place")).scalar()
        joiner = F.when(F.col("place") == first, F.lit("")).otherwise(F.lit(report.SECTION_BREAK[1:]))
        lines = lines.unionByName(
            texts.select("part", "place", F.concat(joiner, F.col("forecast_adjustment_md")).alias("value"))
        )
        note = note.filter(~written.exists())
    return lines.unionByName(note)
