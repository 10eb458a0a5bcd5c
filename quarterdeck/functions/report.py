"""Text pieces of reports and prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lines of the deal health report.
REPORT_TITLE = "# Deal health report"
REPORT_SUMMARY = "## Pipeline health summary"
REPORT_HEADER = "| deal_id | account | stage | health | slip | activity_gap | sentiment_decline | handoff |"
REPORT_RULE = "| --- | --- | --- | ---: | ---: | --- | --- | --- |"
REPORT_ADJUSTMENTS = "## Forecast adjustments"
REPORT_NO_HANDOFFS = "_No handoffs — slip risk at or below threshold._"
ADJUSTMENT_TITLE = "## Forecast adjustment — {deal_id} ({account})"
SECTION_BREAK = "\n\n---\n\n"

# Layout of the prompts; each {name} is a column or parameter.
FORECAST_PROMPT = (
    "deal_id: {deal_id}",
    "slip_risk_score: {slip_risk_score} (handoff threshold: {handoff_trigger})",
    "account: {account_name} | stage: {stage}",
    "close_date: {close_date} | arr: {arr} | rep: {rep_name}",
    "engagement_score: {engagement_score} | activity_gap_flag: {activity_gap_flag}",
    "sentiment_score: {sentiment_score} | tone_trajectory: {tone_trajectory}",
    "sentiment_decline_flag: {sentiment_decline_flag}",
    "rag_summary:",
    "{rag_summary}",
    "Write: ### Signals summary, ### Evidence, ### Recommendation, ### Next steps",
)
BENCHMARK_FOCUS = "{segment} SaaS ARR growth rate benchmark {year}"
BENCHMARK_PROMPT = (
    "{prompt}",
    "",
    "Segment: {segment}",
    "Year: {year}",
    "Preferred sources: {sources}",
    "Query focus: " + BENCHMARK_FOCUS,
)
COMPETITOR_QUERY = "{name} G2 reviews pricing product launch SaaS"
SNIPPET_BLOCK = ("Title: {title}", "URL: {url}", "Snippet: {snippet}")


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template as one string column; null values become empty text."""
    parts: list[Column] = []
    rest = template
    while rest:
        before, brace, tail = rest.partition("{")
        if before:
            parts.append(F.lit(before))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(F.coalesce(values[name].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def fill_lines(template: tuple[str, ...], values: dict[str, Column]) -> Column:
    return F.concat_ws("\n", *(fill(line, values) for line in template))


def yes_no(flag: Column) -> Column:
    """Booleans written ``True`` and ``False``, null as empty text."""
    return F.when(flag, F.lit("True")).when(~flag, F.lit("False")).otherwise(F.lit(""))


SPLITTER = 134217729.0  # 2^27 + 1: parts a double into two halves whose products with small numbers are exact


def two_decimals(score: str) -> Column:
    """The binary value with two decimals, ties to even (0.175 prints as 0.17, 0.125 as 0.12); null prints as nan.

    Spark rounds the shortest decimal text of a double.  That text and the value lie on
    different sides of a tie only where the text is the tie, three decimals of which the last is
    a 5; there the value itself is held against it, times 1000 in two exact halves.  From 1e12
    on, where doubles are too far apart for that, Spark's own format is taken.
    """
    x = F.col(score)
    size = F.abs(x)
    near = F.when(size < 1e12, size)
    text = near.cast("decimal(38,20)")
    thousandths = F.floor(text * 1000).cast("long")
    tie = (text * 1000 == thousandths) & (thousandths % 10 == 5)
    high = near * SPLITTER - (near * SPLITTER - near)
    beyond = (high * 1000.0 - thousandths.cast("double")) + (near - high) * 1000.0
    tens = F.floor(thousandths / 10).cast("long")
    up = F.when(beyond == 0, tens % 2 == 1).otherwise(beyond > 0)
    cents = F.when(tie, tens + up.cast("long")).otherwise((F.round(text, 2) * 100).cast("long"))
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    shown = F.concat(sign, F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    wide = F.concat(sign, F.when(size == float("inf"), F.lit("inf")).otherwise(F.format_string("%.2f", size)))
    return F.when(x.isNull() | F.isnan(x), F.lit("nan")).when(size < 1e12, shown).otherwise(wide)
