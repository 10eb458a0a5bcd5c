"""The five end-to-end jobs."""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators import competitors as comp
from quarterdeck.operators import contracts, deals, growth, health, marts, retrieval, sentiment
from quarterdeck.params import ActivityRules, HealthRules, QualityRules, RetrievalRules, ReviewRules, ToneRules
from quarterdeck.sources import corpus, writers


def key_figures(rolled: DataFrame, performance: DataFrame) -> dict[str, DataFrame]:
    """The six KPI frames, from ``marts.roll_ups`` and the stored segment table."""
    return {
        "revenue_totals": marts.totals_of(rolled),
        "segment_performance": performance.orderBy("segment"),
        "top_products": marts.largest_of(rolled, "top_products", ["sales", "profit"], 5),
        "top_regions": marts.largest_of(rolled, "top_regions", ["sales", "profit"], 5),
        "monthly_trend": marts.figure_rows(rolled, "monthly_trend").select("month", "sales", "profit", "orders").orderBy("month"),
        "segment_by_region": marts.largest_of(rolled, "segment_by_region", ["sales", "orders"], 10),
    }


def sales_marts(
    raw: DataFrame, out: str, rules: QualityRules = QualityRules(), date_format: str | None = None
) -> dict[str, DataFrame]:
    """Gate, both marts and the roll-ups as tables under ``out``, and the KPI frames over them.

    The export is read once: its groups carry what the gate checks.  They lie beside ``out``
    until the gate has passed; a refused export leaves nothing, and tables of an earlier run as they are.
    """
    spark, work = raw.sparkSession, f"{out.rstrip('/')}.groups"
    flags = contracts.quality_flags(raw, rules)
    groups = writers.write_table(marts.sales_groups(raw, date_format, flags), work)
    try:
        contracts.enforce_gate(contracts.report_of(marts.group_measures(groups, list(flags)), rules))
        writers.write_table(marts.facts_of(groups), f"{out}/fct_revenue")
        rolled = writers.write_table(marts.roll_ups(groups), f"{out}/key_figures")
    finally:
        writers.remove(spark, work)
    performance = writers.write_table(marts.performance_of(rolled), f"{out}/fct_segment_performance")
    return key_figures(rolled, performance)


@dataclass(frozen=True)
class DealSettings:
    activity: ActivityRules = field(default_factory=ActivityRules)
    tone: ToneRules = field(default_factory=ToneRules)
    health: HealthRules = field(default_factory=HealthRules)
    retrieval: RetrievalRules = field(default_factory=RetrievalRules)


def score_deals(
    raw_deals: DataFrame,
    log: DataFrame,
    transcripts: DataFrame,
    emails: DataFrame,
    chunks: DataFrame,
    queries: DataFrame,
    as_of: dt.date | Column,
    settings: DealSettings = DealSettings(),
    out: str | None = None,
) -> DataFrame:
    """Every deal with its signals, scores and redacted context.

    Signals are added to the deal rows one after the other, all on deal_id.  With ``out`` what is
    used more than once is stored there, so that each input is read once.
    """
    keep = writers.keeper(f"{out}/signals") if out else writers.not_kept
    requested = keep(deals.one_row_per_deal(deals.normalize_deals(raw_deals)), "requested")
    active = deals.activity_signals(requested, log, as_of, settings.activity, keep)
    toned = sentiment.deal_sentiment(active, transcripts, emails, settings.tone, keep)
    told = retrieval.deal_context(toned, chunks, queries, settings.retrieval.top_k)
    return health.score_health(told, settings.health)


def deal_review(scored: DataFrame, out: str, query: str, generated: str, settings: DealSettings = DealSettings()) -> dict[str, DataFrame]:
    """Scores stored once under ``out``; hand-offs, prompts, counts and report read them from there."""
    stored = writers.write_table(scored, f"{out}/deal_scores")
    lines = health.report_lines(stored, query, generated)
    writers.write_report(lines, f"{out}/deal_health_report")
    return {
        "scores": stored,
        "handoffs": health.handoffs(stored, settings.health),
        "prompts": health.forecast_prompts(stored, settings.health),
        "counts": health.batch_counts(stored),
        "report": lines,
    }


def segment_review(
    opportunities: DataFrame,
    bookings: DataFrame,
    benchmarks: DataFrame,
    out: str,
    rules: ReviewRules = ReviewRules(),
    signals: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Growth, gaps, losses and context frames; stops on inconsistent ids, thin segments, missing benchmarks or
    losses that name nobody.

    Bookings and opportunities are aggregated once and stored under ``out``; the
    frames read those small tables.  ``signals`` has what searches say about
    competitors, one row per ``name`` (see ``answers.parse_signals``).
    """
    contracts.enforce_same_ids(opportunities, bookings, "opportunity_id")
    quarterly = writers.write_table(growth.quarterly_arr(bookings), f"{out}/quarterly_arr")
    contracts.enforce_coverage(quarterly, rules.segments)
    reviewed = quarterly.filter(F.col("segment").isin(*rules.segments)).select("segment").distinct()
    growth.enforce_benchmarks(reviewed, benchmarks)
    summary = writers.write_table(growth.opportunity_summary(opportunities), f"{out}/opportunity_summary")
    stats = writers.write_table(comp.competitor_stats(comp.competitor_losses(opportunities)), f"{out}/competitor_stats")
    comp.require_competitors(stats)
    return review_frames(quarterly, summary, stats, benchmarks, rules, signals)


def review_frames(
    quarterly: DataFrame,
    summary: DataFrame,
    stats: DataFrame,
    benchmarks: DataFrame,
    rules: ReviewRules,
    signals: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The review from its small tables, for the configured segments."""
    rates = growth.segment_growth(quarterly.filter(F.col("segment").isin(*rules.segments)))
    asked = growth.segment_source(rates, rules.segments)
    gaps = growth.benchmark_gaps(asked, rates, benchmarks, rules)
    ranked = comp.rank_competitors(stats, rules.top_competitors)
    if signals is not None:
        ranked = comp.competitor_signals(ranked, signals)
    reference = growth.reference_quarters(quarterly, rules.segments)
    context = growth.segment_context(rates, gaps, summary)
    return {
        "growth": rates,
        "gaps": gaps,
        "competitors": ranked,
        "threats": comp.threat_summary(ranked),
        "reference": reference,
        "context": context,
        "synthesis": growth.synthesis_context(context, reference, ranked, rules),
        "run_log": growth.run_log_row(gaps, reference, rules),
    }


def index_corpus(
    transcripts: DataFrame,
    emails: DataFrame,
    path: str | None = None,
    encoder=None,
    dimensions: int = 256,
    encoder_name: str | None = None,
) -> DataFrame:
    """Chunks of both sources with their vectors.

    With ``path`` they are put into the corpus there by chunk id, and the whole corpus is
    returned: chunks that the sources do not have stay, only changed ones are written, and only
    texts are embedded that were never embedded under this encoder's name.  An encoder of
    one's own needs a name there.
    """
    chunks = retrieval.corpus_chunks(transcripts, emails)
    if not path:
        return retrieval.with_embeddings(chunks, "document", encoder, dimensions)
    if encoder is not None and not encoder_name:
        raise contracts.ContractError("an encoder needs a name by which its vectors are kept")

    def embed(texts: DataFrame) -> DataFrame:
        return retrieval.with_embeddings(texts, "document", encoder, dimensions)

    corpus.update_corpus(chunks, path, embed, encoder_name or f"word-counts-{dimensions}")
    found = corpus.read_corpus(transcripts.sparkSession, path)
    if found is None:
        return retrieval.with_embeddings(chunks, "document", encoder, dimensions)
    return found.select("chunk_id", "deal_id", "document", "embedding")


def stored_context(requested: DataFrame, path: str, queries: DataFrame, top_k: int) -> DataFrame:
    """``requested`` with context blocks from the stored corpus, of which only their deals' buckets are opened."""
    found = corpus.read_corpus(requested.sparkSession, path, requested)
    if found is None:
        raise contracts.ContractError(f"no corpus at {path}")
    return retrieval.deal_context(requested, found, queries, top_k)


def contract_audit(opportunities: DataFrame, bookings: DataFrame, rules: ReviewRules = ReviewRules()) -> DataFrame:
    """One row per contract of the two review tables: (contract, passed).

    Each table is read once for its own contracts, and its ids once more to compare them;
    the column sets come from the schemas.  A table without a column its contracts read
    is an error of its own.
    """
    segment, quarter = F.col("segment"), F.col("quarter")
    columns = opportunities.sparkSession.range(1).select(
        F.lit(contracts.exact_columns(opportunities, rules.opportunity_columns)).alias("opportunity_columns"),
        F.lit(contracts.exact_columns(bookings, rules.booking_columns)).alias("booking_columns"),
    )
    opp = opportunities.agg(
        contracts.domain_holds(segment, rules.segments).alias("segment_domain"),
        contracts.bounds_hold(rules.arr_bounds).alias("arr_bounds"),
        (F.count_if(F.col("win_loss_reason").isNull()) == 0).alias("reason_present"),
    )
    book = bookings.agg(contracts.domain_holds(quarter, rules.quarters).alias("quarter_domain"))
    variation = contracts.growth_variation(bookings).select(F.col("passed").alias("growth_variation"))
    same = contracts.id_set_difference(opportunities, bookings, "opportunity_id")
    ids = same.agg((F.count("*") == 0).alias("same_ids"))

    def listed(results: DataFrame) -> DataFrame:
        rows = (F.struct(F.lit(c).alias("contract"), F.coalesce(c, F.lit(False)).alias("passed")) for c in results.columns)
        return results.select(F.inline(F.array(*rows)))

    frames = [listed(frame) for frame in (columns, ids, opp, book, variation)]
    return functools.reduce(DataFrame.unionByName, frames)
