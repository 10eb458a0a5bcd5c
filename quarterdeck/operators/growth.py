"""Segment growth, benchmark gaps and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import report
from quarterdeck.functions.numbers import growth_pct, money_sum
from quarterdeck.operators.contracts import ContractError
from quarterdeck.params import ReviewRules

# Stage names of closed opportunities.
CLOSED_WON = "Closed Won"
CLOSED_LOST = "Closed Lost"


def quarterly_arr(bookings: DataFrame) -> DataFrame:
    """Booked value by segment and quarter, rounded to cents; growth builds on the rounded sums.

    Rows without segment or quarter are left out; a group without any amount books 0.
    """
    booked = F.coalesce(money_sum(F.col("booked_arr")), F.lit(0.0))
    keyed = bookings.filter(F.col("segment").isNotNull() & F.col("quarter").isNotNull())
    return keyed.groupBy("segment", "quarter").agg(F.round(booked, 2).alias("booked_arr"))


def quarter_maps(quarterly: DataFrame) -> DataFrame:
    """One map per segment, quarter to value, quarters ascending; four entries a year."""
    entries = F.sort_array(F.collect_list(F.struct("quarter", "booked_arr")))
    return quarterly.groupBy("segment").agg(F.map_from_entries(entries).alias("quarterly_arr"))


def segment_growth(quarterly: DataFrame) -> DataFrame:
    """Latest quarter against the one before and against the first; quarters sort as text.

    A segment with a single quarter yields null growth; ``contracts.segment_coverage``
    reports it.
    """
    ordered = Window.partitionBy("segment").orderBy("quarter")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    latest = (
        quarterly.withColumn("prior_quarter", F.lag("quarter").over(ordered))
        .withColumn("prior_quarter_arr", F.lag("booked_arr").over(ordered))
        .withColumn("first_quarter_arr", F.first("booked_arr").over(whole))
        .withColumn("reference_quarter", F.last("quarter").over(whole))
        .filter(F.col("quarter") == F.col("reference_quarter"))
    )
    current = F.col("booked_arr")
    year = F.when(F.col("prior_quarter").isNotNull(), growth_pct(current, F.col("first_quarter_arr")))
    return latest.select(
        "segment",
        "reference_quarter",
        "prior_quarter",
        current.alias("current_arr"),
        "prior_quarter_arr",
        "first_quarter_arr",
        growth_pct(current, F.col("prior_quarter_arr")).alias("qoq_growth_pct"),
        year.alias("yoy_growth_pct"),
    )


def reference_quarters(quarterly: DataFrame, segments: Sequence[str]) -> DataFrame:
    """One row: latest and prior quarter of the first configured segment."""
    of_first = quarterly.filter(F.col("segment") == segments[0])
    top = of_first.orderBy(F.desc("quarter")).limit(2)
    return top.agg(F.max("quarter").alias("reference_quarter"), F.min("quarter").alias("prior_quarter"))


def opportunity_summary(opportunities: DataFrame) -> DataFrame:
    """Count, won, lost and value by segment; rows without a segment are left out."""
    return (
        opportunities.filter(F.col("segment").isNotNull())
        .groupBy("segment")
        .agg(
            F.count("*").alias("count"),
            F.count_if(F.col("stage") == CLOSED_WON).alias("closed_won"),
            F.count_if(F.col("stage") == CLOSED_LOST).alias("closed_lost"),
            F.round(F.coalesce(money_sum(F.col("arr")), F.lit(0.0)), 2).alias("total_pipeline_arr"),
        )
    )


def opportunity_totals(opportunities: DataFrame) -> DataFrame:
    """One row over all opportunities, with or without a segment."""
    return opportunities.agg(F.count("*").alias("total_opportunities"))


def segment_source(growth: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Segments to review: those with growth figures, else the configured list.

    One plan serves both cases; the choice is made while it runs.
    """
    found = growth.select("segment", F.lit("crm_sync").alias("segments_source"))
    listed = growth.sparkSession.createDataFrame([(s,) for s in segments], "segment string")
    fallback = listed.withColumn("segments_source", F.lit("config")).filter(~growth.select("segment").exists())
    return found.unionByName(fallback)


def benchmark_gaps(segments: DataFrame, growth: DataFrame, benchmarks: DataFrame, rules: ReviewRules) -> DataFrame:
    """Growth less benchmark in points, rounded to 2 before the inclusive two-sided flag.

    A segment without growth, or without a benchmark, stays and has no gap; it is not
    flagged.  ``enforce_benchmarks`` stops a run that lacks one.
    """
    joined = segments.join(benchmarks, "segment", "left").join(
        growth.select("segment", F.col("yoy_growth_pct").alias("internal_yoy_growth_pct")), "segment", "left"
    )
    gap = F.round(F.col("internal_yoy_growth_pct") - F.col("benchmark_growth_pct"), 2)
    flagged = F.coalesce(F.abs("gap_pp") >= rules.gap_threshold_pp, F.lit(False))
    return joined.withColumn("gap_pp", gap).withColumn("flagged", flagged)


def enforce_benchmarks(segments: DataFrame, benchmarks: DataFrame) -> None:
    """Stops and names the segments that have no benchmark; segments are few."""
    known = benchmarks.filter(F.col("benchmark_growth_pct").isNotNull())
    missing = sorted(str(r["segment"]) for r in segments.join(known, "segment", "left_anti").collect())
    if missing:
        raise ContractError(f"segments without a benchmark: {', '.join(missing)}")


def _place(segment: Column, segments: Sequence[str]) -> Column:
    place = F.array_position(F.array(*(F.lit(s) for s in segments)), segment)
    return F.when(place > 0, place).otherwise(F.lit(len(segments) + 1))


def flagged_segments(gaps: DataFrame, segments: Sequence[str]) -> DataFrame:
    """One row: flagged segments in configured order, joined by commas."""
    entry = F.when(F.col("flagged"), F.struct(_place(F.col("segment"), segments).alias("place"), "segment"))
    ordered = F.sort_array(F.collect_list(entry))["segment"]
    return gaps.agg(F.array_join(ordered, ",").alias("flagged_segments"))


def benchmark_prompts(segments: DataFrame, prompt: str, rules: ReviewRules) -> DataFrame:
    """Search text and short query by segment."""
    values = {
        "prompt": F.lit(prompt),
        "segment": F.col("segment"),
        "year": F.lit(rules.search_year),
        "sources": F.lit(", ".join(rules.benchmark_sources)),
    }
    return segments.select(
        "segment",
        report.fill_lines(report.BENCHMARK_PROMPT, values).alias("prompt"),
        report.fill(report.BENCHMARK_FOCUS, values).alias("query"),
    )


def segment_context(growth: DataFrame, gaps: DataFrame, summary: DataFrame) -> DataFrame:
    """Growth, benchmark gap and opportunity counts side by side, one row per segment."""
    return (
        growth.select("segment", "current_arr", "qoq_growth_pct", "yoy_growth_pct")
        .join(summary, "segment", "left")
        .join(gaps.select("segment", "benchmark_growth_pct", "gap_pp", "flagged"), "segment", "left")
    )


def synthesis_context(context: DataFrame, reference: DataFrame, competitors: DataFrame, rules: ReviewRules) -> DataFrame:
    """One row: the whole review as JSON for a later writing step.

    It lists the segments, in configured order, and the few top competitors; both lists
    are short by configuration.
    """
    pick = ("name", "lost_arr", "loss_count", "threat_level", "headline", "g2_sentiment", "pricing_signal")
    place = _place(F.col("segment"), rules.segments).alias("place")
    row = F.struct(place, F.col("segment").alias("key"), F.struct(*context.columns).alias("row"))
    marked = F.when(F.col("flagged"), F.struct(place, F.col("segment").alias("key")))
    segments = context.agg(
        F.sort_array(F.collect_list(row))["row"].alias("segments"),
        F.sort_array(F.collect_list(marked))["key"].alias("flagged_segments"),
    )
    threats = competitors.agg(
        F.sort_array(F.collect_list(F.struct("competitor_rank", *(F.col(c) for c in pick if c in competitors.columns))))
    )
    fields = F.struct(
        reference.select("reference_quarter").scalar().alias("reference_quarter"),
        "flagged_segments",
        "segments",
        threats.scalar().alias("competitors"),
        F.lit(rules.action_count).alias("gtm_actions_count"),
        F.lit(rules.narrative_minutes).alias("narrative_max_minutes"),
        F.lit(rules.gap_threshold_pp).alias("gap_threshold_pp"),
    )
    return segments.select("flagged_segments", F.to_json(fields).alias("context_json"))


def run_log_row(
    gaps: DataFrame,
    reference: DataFrame,
    rules: ReviewRules,
    narrative: str | Column = "",
    actions_json: str | Column = "[]",
    run_id: str | Column | None = None,
) -> DataFrame:
    """One row per run, with the gap rows nested; a segment list is short by configuration.

    Without ``run_id`` the run is named by a hash of all it reports, so that the same run
    has the same name when it is computed again.
    """
    narrative, actions_json = (v if isinstance(v, Column) else F.lit(v) for v in (narrative, actions_json))
    optional = {
        name: F.coalesce(F.col(name), F.lit("")) if name in gaps.columns else F.lit("")
        for name in ("source_summary", "confidence")
    }
    entry = F.struct(
        "segment",
        "internal_yoy_growth_pct",
        "benchmark_growth_pct",
        "gap_pp",
        F.coalesce("flagged", F.lit(False)).alias("flagged"),
        optional["source_summary"].alias("source_summary"),
        optional["confidence"].alias("confidence"),
    )
    place = _place(F.col("segment"), rules.segments)
    ordered = F.sort_array(F.collect_list(F.struct(place.alias("place"), F.col("segment").alias("key"), entry.alias("row"))))
    marked = F.sort_array(
        F.collect_list(F.when(F.col("flagged"), F.struct(place.alias("place"), F.col("segment").alias("key"))))
    )
    rows = gaps.agg(ordered["row"].alias("gap_rows"), F.array_join(marked["key"], ",").alias("flagged_segments"))
    told = rows.select(
        reference.select("reference_quarter").scalar().alias("reference_quarter"),
        F.lit(rules.search_year).alias("search_year"),
        narrative.alias("narrative"),
        actions_json.alias("actions_json"),
        "flagged_segments",
        "gap_rows",
    )
    content = F.sha2(F.to_json(F.struct(*told.columns)).cast("binary"), 256)
    name = content if run_id is None else run_id if isinstance(run_id, Column) else F.lit(run_id)
    return told.select(name.alias("run_id"), F.current_timestamp().alias("written_at"), *told.columns)


def allocate_bookings(opportunities: DataFrame, targets: DataFrame, weight: str) -> DataFrame:
    """Each segment's quarter targets shared out by weight, rounded to cents.

    ``targets`` has (segment, quarter, target).  Weights are summed by a combining
    aggregation; the few targets of a segment travel as one array.  The join is a plain
    one: one row per segment is sent to the opportunities, and should it ever be too
    large for that, Spark splits hot segments by their size.
    """
    if weight not in opportunities.columns:
        raise ContractError(f"missing columns: {weight}")
    sums = opportunities.groupBy("segment").agg(money_sum(F.col(weight)).alias("_weights"))
    packed = targets.groupBy("segment").agg(F.sort_array(F.collect_list(F.struct("quarter", "target"))).alias("_plan"))
    shares = sums.join(packed, "segment")
    rows = opportunities.select("opportunity_id", "segment", F.col(weight).cast("double").alias("_weight"))
    planned = rows.join(shares, "segment").withColumn("_goal", F.explode("_plan"))
    share = F.col("_goal.target") * F.col("_weight") / F.col("_weights")
    return planned.select(
        "opportunity_id", "segment", F.col("_goal.quarter").alias("quarter"), F.round(share, 2).alias("booked_arr")
    )


def sampled_rows(rows: DataFrame, sample_ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id was picked, however often an id occurs in ``rows``; one pass over them."""
    return rows.join(sample_ids.select(key), key, "left_semi")
