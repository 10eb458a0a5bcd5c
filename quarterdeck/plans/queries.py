"""The registered queries: one callable (spark, table folder) per operator or job."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterdeck.functions.text import redact_email, redact_phone
from quarterdeck.operators import answers, contracts, deals, growth, guardrails, health, marts, ordering, retrieval
from quarterdeck.operators import competitors as comp
from quarterdeck.operators import sentiment as tone
from quarterdeck.params import BOOKING_QUARTERS, ArrBound, ActivityRules, HealthRules, QualityRules
from quarterdeck.plans import bindings as b
from quarterdeck.plans import jobs
from quarterdeck.sources import corpus, readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


QUALITY = QualityRules(allowed_segments=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"))
YEARS = (*(f"{y}-Q{q}" for y in range(1995, 2001) for q in range(1, 5)), "2001-Q1", "2001-Q2", "2001-Q3")
ARRAY_ROWS = 20_000  # rows of a JSON array on average; each file is read by one task
BOUNDS = (
    ArrBound("AUTOMOBILE", minimum=1000),
    ArrBound("BUILDING", minimum=50_000, maximum=200_000),
    ArrBound("MACHINERY", maximum=600_000, maximum_allowed=False),
)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder of the cluster; a local one only on one machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = os.path.join(tempfile.gettempdir(), "quarterdeck")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, sf: str) -> DataFrame:
    return marts.stage_sales(b.raw_sales(spark, sf))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- sources and sinks


@query
def csv_landing(spark, sf):
    path = scratch(spark, "sales")
    b.raw_sales(spark, sf).write.option("header", True).csv(f"{path}/csv")
    return marts.segment_performance(marts.stage_sales(readers.land_csv(spark, f"{path}/csv", f"{path}/raw_sales")))


@query
def crm_csv_read(spark, sf):
    path = scratch(spark, "opportunities")
    b.opportunities(spark, sf).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, "opportunities").select(
        "opportunity_id", "segment", "account_name", "arr", "stage", F.trim("win_loss_reason").alias("win_loss_reason")
    )


@query
def json_array_read(spark, sf):
    """Calls written as JSON arrays, one per file, and read back."""
    path = scratch(spark, "transcripts")
    turns = b.transcripts(spark, sf)
    record = F.to_json(F.struct(*(c for c in turns.columns if c != "ordinal")))
    files = turns.count() // ARRAY_ROWS + 1
    rows = turns.select(F.pmod(F.xxhash64("deal_id", "ordinal"), F.lit(files)).alias("file"), "deal_id", "ordinal", record.alias("record"))
    place = Window.partitionBy("file").orderBy("deal_id", "ordinal")
    first, last = F.lag("record").over(place).isNull(), F.lead("record").over(place).isNull()
    value = F.concat(F.when(first, "[").otherwise(""), "record", F.when(last, "]").otherwise(","))
    rows.select("file", value.alias("value")).write.partitionBy("file").text(path)
    return readers.read_json_array(spark, path).drop("ordinal", "file")


@query
def raw_table_scan(spark, sf):
    return contracts.quality_measures(b.raw_sales(spark, sf), QUALITY)


@query
def mart_tables(spark, sf):
    staged(spark, sf).createOrReplaceTempView("stg_sales")
    return writers.write_table(marts.revenue_facts(spark.table("stg_sales")), scratch(spark, "fct_revenue"))


@query
def chunk_upsert(spark, sf):
    """Every update comes twice, an older text first."""
    chunks = b.vector_chunks(spark, sf)
    changed = chunks.withColumn("document", F.concat(F.lit("new "), "document")).withColumn(
        "chunk_id", F.concat(F.lit("C"), (F.col("ordinal") * 2).cast("string"))
    )
    older = changed.withColumns({"document": F.lit("older"), "ordinal": F.col("ordinal") - 1})
    base = chunks.drop("ordinal")
    return retrieval.upsert_chunks(base, older.unionByName(changed)).select("chunk_id", "deal_id", "document")


@query
def health_report(spark, sf):
    return health.report_lines(deal_scores(spark, sf), "Assess deal health", "2024-01-31 00:00 UTC")


@query
def run_log(spark, sf):
    """Two runs appended, the first of them twice; a dry run between them adds nothing."""
    path, row = scratch(spark, "runs"), _review(spark, sf)["run_log"]
    for narrative, dry_run in (("first", False), ("none", True), ("second", False), ("first", False)):
        named = row.withColumn("narrative", F.lit(narrative)).withColumn("run_id", F.concat(F.lit(narrative), "run_id"))
        writers.append_run(named, path, dry_run)
    points = F.transform("gap_rows.gap_pp", lambda x: F.round(x * 100).cast("long").cast("string"))
    return writers.read_runs(spark, path, row.schema).select(
        "reference_quarter",
        "search_year",
        "narrative",
        "actions_json",
        "flagged_segments",
        F.size("gap_rows").alias("gap_segments"),
        F.array_join("gap_rows.segment", ",").alias("segments"),
        F.array_join(points, ",").alias("gap_points"),
        F.array_join(F.transform("gap_rows.flagged", lambda x: x.cast("string")), ",").alias("flags"),
    )


# ---- contracts


@query
def key_contract(spark, sf):
    rows = contracts.require_columns(b.deal_rows(spark, sf), deals.DEAL_COLUMNS)
    return contracts.key_report(rows, "deal_id")


@query
def quality_checks(spark, sf):
    return contracts.quality_report(b.raw_sales(spark, sf), QUALITY)


@query
def quality_gate(spark, sf):
    return contracts.gate(contracts.quality_report(b.raw_sales(spark, sf), QUALITY))


@query
def id_differences(spark, sf):
    """Orders against the orders that have lines."""
    orders = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    lines = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return contracts.id_set_difference(orders, lines, "id")


@query
def segment_domain(spark, sf):
    return contracts.domain_report(b.opportunities(spark, sf), "segment", (*b.MARKET_SEGMENTS, "SMB"))


@query
def quarter_domain(spark, sf):
    return contracts.domain_report(b.bookings(spark, sf), "quarter", YEARS)


@query
def reason_nulls(spark, sf):
    return contracts.null_report(b.opportunities(spark, sf), "win_loss_reason")


@query
def arr_bounds(spark, sf):
    return contracts.arr_bounds_report(b.opportunities(spark, sf), BOUNDS)


@query
def growth_means(spark, sf):
    return rounded(
        contracts.segment_growth_means(b.bookings(spark, sf)), "benchmark_growth_pct", "actual_growth_pct", "gap", digits=9
    )


@query
def growth_variation(spark, sf):
    return rounded(contracts.growth_variation(b.bookings(spark, sf)), "min_gap", "max_gap", digits=9)


@query
def activity_dates(spark, sf):
    return contracts.timestamp_report(b.activity(spark, sf), "activity_date")


@query
def segment_coverage(spark, sf):
    quarterly = growth.quarterly_arr(b.bookings(spark, sf))
    return contracts.segment_coverage(quarterly, (*b.MARKET_SEGMENTS, "SMB"))


@query
def contract_audit(spark, sf):
    rules = b.ReviewRules(segments=b.MARKET_SEGMENTS, quarters=YEARS, arr_bounds=BOUNDS)
    return jobs.contract_audit(b.opportunities(spark, sf), b.bookings(spark, sf), rules)


# ---- sales marts and key figures


@query
def staged_sales(spark, sf):
    return staged(spark, sf)


@query
def revenue_facts(spark, sf):
    return marts.revenue_facts(staged(spark, sf))


@query
def segment_performance(spark, sf):
    return marts.segment_performance(staged(spark, sf)).orderBy("segment")


@query
def grand_totals(spark, sf):
    totals = marts.grand_totals(marts.revenue_facts(staged(spark, sf)))
    return rounded(totals, "avg_deal_size")


@query
def top_products(spark, sf):
    return marts.top_products(staged(spark, sf))


@query
def top_regions(spark, sf):
    return marts.top_regions(staged(spark, sf))


@query
def monthly_trend(spark, sf):
    return marts.monthly_trend(staged(spark, sf))


@query
def segment_regions(spark, sf):
    return marts.segment_regions(staged(spark, sf))


@query
def sales_key_figures(spark, sf):
    """The whole sales job: gate, marts written, key figures read from the marts, as (figure, key, value)."""
    rules = QualityRules(allowed_segments=b.MARKET_SEGMENTS)
    frames = jobs.sales_marts(b.raw_sales(spark, sf), scratch(spark, "marts"), rules)
    figures = [
        ("revenue_totals", F.lit("all"), "total_sales"),
        ("segment_performance", F.col("segment"), "total_sales"),
        ("top_products", F.col("product"), "sales"),
        ("top_regions", F.col("region"), "sales"),
        ("monthly_trend", F.col("month").cast("string"), "sales"),
        ("segment_by_region", F.concat_ws("/", "segment", "region", "subregion"), "sales"),
    ]
    out = None
    for name, key, value in figures:
        part = frames[name].select(F.lit(name).alias("figure"), key.alias("key"), F.col(value).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- deals and activity


@query
def normalized_deals(spark, sf):
    return deals.normalize_deals(b.deal_rows(spark, sf))


@query
def latest_deals(spark, sf):
    return deals.one_row_per_deal(deals.normalize_deals(b.deal_rows(spark, sf)))


@query
def deal_order(spark, sf):
    return deals.deal_order(deals.normalize_deals(b.deal_rows(spark, sf)))


@query
def requested_keys(spark, sf):
    """Event types as keys, blank for errors."""
    ids = b.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("  ")).otherwise(F.concat("event_type", F.lit("\t"))).alias("deal_id"),
    )
    return deals.requested_keys(ids)


def _requested(spark, sf):
    return deals.one_row_per_deal(deals.normalize_deals(b.deal_rows(spark, sf))).select("deal_id")


@query
def activity_counts(spark, sf):
    return deals.activity_counts(b.activity(spark, sf))


@query
def max_activity(spark, sf):
    return deals.max_activity(_requested(spark, sf), deals.activity_counts(b.activity(spark, sf)))


@query
def activity_signals(spark, sf):
    signals = deals.activity_signals(_requested(spark, sf), b.activity(spark, sf), b.AS_OF, ActivityRules(), writers.keeper(scratch(spark, "activity")))
    return rounded(signals, "engagement_score")


# ---- sentiment


@query
def buyer_turns(spark, sf):
    return tone.buyer_turns(b.transcripts(spark, sf))


@query
def turn_positions(spark, sf):
    return tone.ordered_turns(b.transcripts(spark, sf)).select("deal_id", "call_num", "turn_num", "position")


@query
def call_halves(spark, sf):
    halves = tone.call_halves(b.transcripts(spark, sf))
    return halves.withColumn("halves", F.array_join("halves", ","))


@query
def email_halves(spark, sf):
    split = tone.email_halves(b.emails(spark, sf), b.transcripts(spark, sf))
    return split.select("deal_id", "ordinal", "half")


@query
def tone_scores(spark, sf):
    scored = tone.text_scores(b.table(spark, sf, "documents"), "text", b.TONE)
    return rounded(scored.select("doc_id", "score"), "score")


@query
def signal_span(spark, sf):
    return tone.signal_span(b.transcripts(spark, sf), b.emails(spark, sf))


@query
def deal_sentiment(spark, sf):
    scored = tone.deal_sentiment(_requested(spark, sf), b.transcripts(spark, sf), b.emails(spark, sf), b.TONE, writers.keeper(scratch(spark, "tone")))
    return rounded(scored, "sentiment_score", "tone_trajectory")


# ---- guardrails


@query
def email_redaction(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", redact_email(F.col("text")).alias("text"))


@query
def phone_redaction(spark, sf):
    return b.table(spark, sf, "documents").select("doc_id", redact_phone(F.col("text")).alias("text"))


@query
def pii_redaction(spark, sf):
    redacted = guardrails.redact_pii(b.table(spark, sf, "documents"), "text")
    return redacted.select(
        "doc_id", "sanitized_text", "redacted", F.array_join("pii_types", ",").alias("pii_types")
    )


@query
def topic_screen(spark, sf):
    screened = guardrails.screen_topics(b.table(spark, sf, "documents"), "text")
    return screened.select("doc_id", "matched_topic", "allowed")


# ---- retrieval


@query
def corpus_deals(spark, sf):
    return retrieval.corpus_deals(b.transcripts(spark, sf), b.emails(spark, sf))


@query
def corpus_chunks(spark, sf):
    return retrieval.corpus_chunks(b.transcripts(spark, sf), b.emails(spark, sf))


@query
def corpus_index(spark, sf):
    """The indexing job in three updates and one compaction; vectors are reported by their length.

    Old texts of the calls with all e-mails, then the calls as they are in two halves, the
    buckets compacted in between.
    """
    path, turns, mails = scratch(spark, "corpus"), b.transcripts(spark, sf), b.emails(spark, sf)
    none, half = mails.limit(0), F.pmod(F.xxhash64("deal_id"), F.lit(2)) == 0
    jobs.index_corpus(turns.withColumn("turn_text", F.lit("old")), mails, path)
    jobs.index_corpus(turns.filter(half), none, path)
    corpus.compact(spark, path)
    built = jobs.index_corpus(turns.filter(~half), none, path)
    square = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    return built.select(
        "chunk_id",
        "deal_id",
        F.md5(F.col("document").cast("binary")).alias("document"),
        F.size("embedding").alias("dimensions"),
        F.round(F.sqrt(square), 3).alias("norm"),
    )


@query
def text_retrieval(spark, sf):
    """Context of every deal for the standard questions, over text embedded by a given encoder."""
    built = jobs.index_corpus(b.transcripts(spark, sf), b.emails(spark, sf), encoder=b.letter_encoder)
    questions = retrieval.query_table(spark, jobs.RetrievalRules().queries)
    asked = retrieval.with_embeddings(questions, "query", b.letter_encoder)
    wanted = b.transcripts(spark, sf).select("deal_id").distinct()
    return retrieval.deal_context(wanted, built, asked, jobs.RetrievalRules().top_k)


@query
def stored_retrieval(spark, sf):
    """As ``text_retrieval``, for the five smallest deal ids, from a stored corpus of which only their buckets are read."""
    path, turns = scratch(spark, "corpus"), b.transcripts(spark, sf)
    jobs.index_corpus(turns, b.emails(spark, sf), path, b.letter_encoder, encoder_name="letters")
    questions = retrieval.query_table(spark, jobs.RetrievalRules().queries)
    asked = retrieval.with_embeddings(questions, "query", b.letter_encoder)
    wanted = turns.select("deal_id").distinct().orderBy("deal_id").limit(5)
    return jobs.stored_context(wanted, path, asked, jobs.RetrievalRules().top_k)


def _vectors(spark, sf):
    return b.vector_chunks(spark, sf), b.vector_queries(spark, sf)


@query
def query_distances(spark, sf):
    distances = retrieval.query_distances(*_vectors(spark, sf))
    return rounded(distances, "distance")


@query
def nearest_chunks(spark, sf):
    return rounded(retrieval.nearest_chunks(*_vectors(spark, sf), 5), "distance")


@query
def merged_hits(spark, sf):
    return rounded(retrieval.merge_hits(retrieval.nearest_chunks(*_vectors(spark, sf), 5)), "distance")


@query
def context_blocks(spark, sf):
    return retrieval.context_blocks(retrieval.merge_hits(retrieval.nearest_chunks(*_vectors(spark, sf), 5)))


@query
def retrieval_status(spark, sf):
    ids = b.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", F.lit(" ")).otherwise(F.col("event_type")).alias("deal_id")
    )
    return retrieval.retrieval_status(retrieval.retrieval_outcomes(ids.distinct(), jobs.RetrievalRules().queries))


# ---- health


def deal_scores(spark, sf):
    chunks, asked = _vectors(spark, sf)
    return jobs.score_deals(
        b.deal_rows(spark, sf),
        b.activity(spark, sf),
        b.transcripts(spark, sf),
        b.emails(spark, sf),
        chunks,
        asked,
        b.AS_OF,
        jobs.DealSettings(tone=b.TONE),
        scratch(spark, "deals"),
    )


@query
def deal_health(spark, sf):
    """The whole deal job."""
    scored = deal_scores(spark, sf)
    kept = scored.select(
        "deal_id",
        "first_seen",
        "stage",
        "arr",
        "engagement_score",
        "activity_gap_flag",
        "sentiment_score",
        "tone_trajectory",
        "deal_health_score",
        "slip_risk_score",
        "handoff_triggered",
        "deal_intel_ok",
        F.length("rag_summary_redacted").alias("context_chars"),
    )
    return rounded(
        kept, "engagement_score", "sentiment_score", "tone_trajectory", "deal_health_score", "slip_risk_score"
    )


@query
def deal_assembly(spark, sf):
    """Signal tables built apart from the deals; sentiment and context left out for this run."""
    rows = deals.one_row_per_deal(deals.normalize_deals(b.deal_rows(spark, sf)))
    counted = deals.activity_counts(b.activity(spark, sf)).select("deal_id")
    active = deals.activity_signals(counted, b.activity(spark, sf), b.AS_OF, ActivityRules())
    scored = health.assemble_deals(rows, active, None, None, HealthRules())
    kept = scored.select(
        "deal_id", "engagement_score", "activity_gap_flag", "deal_health_score", "deal_intel_ok", "rag_summary_redacted"
    )
    return rounded(kept, "engagement_score", "deal_health_score")


@query
def handoffs(spark, sf):
    due = health.handoffs(deal_scores(spark, sf), HealthRules())
    return rounded(due.select("deal_id", "slip_risk_score"), "slip_risk_score")


@query
def batch_counts(spark, sf):
    return health.batch_counts(deal_scores(spark, sf))


@query
def forecast_prompts(spark, sf):
    """Deals above the unrounded trigger; the scores are rounded for display only."""
    due = health.handoffs(deal_scores(spark, sf), HealthRules())
    shown = rounded(due, "slip_risk_score", "engagement_score", "sentiment_score", "tone_trajectory", digits=2)
    return health.prompt_rows(shown, HealthRules()).select("deal_id", "prompt")


# ---- growth


def _quarterly(spark, sf):
    return growth.quarterly_arr(b.bookings(spark, sf))


def _review(spark, sf):
    """The review job: its aggregates are stored, so that frames which use them twice read them twice."""
    return jobs.segment_review(
        b.opportunities(spark, sf),
        b.bookings(spark, sf),
        b.benchmarks(spark, sf),
        scratch(spark, "review"),
        b.REVIEW,
        _signal_rows(spark, sf),
    )


@query
def quarterly_arr(spark, sf):
    return _quarterly(spark, sf)


@query
def quarter_maps(spark, sf):
    pairs = F.transform(
        F.map_entries("quarterly_arr"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("decimal(18,2)").cast("string")),
    )
    return growth.quarter_maps(_quarterly(spark, sf)).select("segment", F.array_join(pairs, ",").alias("quarterly_arr"))


@query
def segment_growth(spark, sf):
    return growth.segment_growth(_quarterly(spark, sf))


@query
def reference_quarters(spark, sf):
    return growth.reference_quarters(_quarterly(spark, sf), b.REVIEW.segments)


@query
def opportunity_summary(spark, sf):
    return growth.opportunity_summary(b.opportunities(spark, sf))


@query
def opportunity_totals(spark, sf):
    return growth.opportunity_totals(b.opportunities(spark, sf))


@query
def segment_source(spark, sf):
    """Growth segments as found, and the fallback list when no booking has a segment."""
    rates = growth.segment_growth(_quarterly(spark, sf))
    found = growth.segment_source(rates, b.REVIEW.segments).withColumn("case", F.lit("found"))
    none = growth.segment_growth(growth.quarterly_arr(b.bookings(spark, sf).filter("segment = 'none'")))
    listed = growth.segment_source(none, b.REVIEW.segments).withColumn("case", F.lit("none"))
    return found.unionByName(listed)


def _gaps(spark, sf):
    rates = growth.segment_growth(_quarterly(spark, sf))
    asked = growth.segment_source(rates, b.REVIEW.segments)
    return growth.benchmark_gaps(asked, rates, b.benchmarks(spark, sf), b.REVIEW)


@query
def benchmark_gaps(spark, sf):
    return _gaps(spark, sf)


@query
def flagged_segments(spark, sf):
    return growth.flagged_segments(_gaps(spark, sf), b.REVIEW.segments)


@query
def benchmark_prompts(spark, sf):
    segments = _quarterly(spark, sf).select("segment").distinct()
    return growth.benchmark_prompts(segments, "Find the benchmark.", b.REVIEW)


@query
def synthesis_context(spark, sf):
    """Facts picked out of the review's JSON."""
    made = _review(spark, sf)["synthesis"]
    paths = {
        "reference_quarter": "$.reference_quarter",
        "gtm_actions_count": "$.gtm_actions_count",
        "first_segment": "$.segments[0].segment",
        "first_count": "$.segments[0].count",
        "last_segment": "$.segments[4].segment",
        "top_competitor": "$.competitors[0].name",
        "third_losses": "$.competitors[2].loss_count",
        "top_threat_level": "$.competitors[0].threat_level",
        "second_headline": "$.competitors[1].headline",
    }
    picked = [F.get_json_object("context_json", path).alias(name) for name, path in paths.items()]
    return made.select(F.array_join("flagged_segments", ",").alias("flagged_segments"), *picked)


@query
def booking_allocation(spark, sf):
    """Each segment's quarterly bookings shared out over its opportunities by value."""
    targets = _quarterly(spark, sf).withColumnRenamed("booked_arr", "target")
    return growth.allocate_bookings(b.opportunities(spark, sf), targets, "arr")


@query
def segment_head(spark, sf):
    first = ordering.head_per_group(b.opportunities(spark, sf), ["segment"], ["opportunity_id"], 5)
    return first.select("segment", "opportunity_id")


@query
def sampled_bookings(spark, sf):
    """Order lines of the sampled orders."""
    ids = segment_head(spark, sf).select(F.col("opportunity_id").alias("l_orderkey"))
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return growth.sampled_rows(lines, ids, "l_orderkey")


# ---- competitors


def _stats(spark, sf):
    return comp.competitor_stats(comp.competitor_losses(b.opportunities(spark, sf)))


@query
def competitor_losses(spark, sf):
    return comp.competitor_losses(b.opportunities(spark, sf)).select("opportunity_id", "name", "theme")


@query
def competitor_stats(spark, sf):
    return _stats(spark, sf).withColumn("loss_themes", F.array_join("loss_themes", ","))


@query
def competitor_ranking(spark, sf):
    ranked = comp.rank_competitors(_stats(spark, sf), b.REVIEW.top_competitors)
    return ranked.withColumn("loss_themes", F.array_join("loss_themes", ","))


@query
def competitor_queries(spark, sf):
    return comp.search_queries(comp.rank_competitors(_stats(spark, sf), b.REVIEW.top_competitors))


def _snippets(spark, sf):
    return comp.search_snippets(b.search_hits(spark, sf), b.AS_OF, b.REVIEW.days_back, b.REVIEW.max_results)


@query
def search_snippets(spark, sf):
    return _snippets(spark, sf)


@query
def snippet_blobs(spark, sf):
    return comp.snippet_blobs(_snippets(spark, sf)).withColumn("sources", F.array_join("sources", ","))


def _signal_rows(spark, sf):
    """One signal row per competitor: the answer numbered by its place among all competitors."""
    parsed = answers.parse_signals(b.signal_answers(spark, sf), "answer").filter("ok")
    firsts = parsed.withColumn("name", F.get(F.array(*(F.lit(r) for r in b.RIVALS)), F.col("doc_id") % 4))
    last = firsts.groupBy("name").agg(
        F.max_by(F.struct("threat_level", "headline", "g2_sentiment", "pricing_signal"), "doc_id").alias("s")
    )
    return last.select("name", "s.*")


def _signals(spark, sf):
    ranked = comp.rank_competitors(_stats(spark, sf), b.REVIEW.top_competitors)
    return comp.competitor_signals(ranked, _signal_rows(spark, sf))


@query
def competitor_signals(spark, sf):
    return _signals(spark, sf).withColumn("loss_themes", F.array_join("loss_themes", ","))


@query
def threat_summary(spark, sf):
    summary = _review(spark, sf)["threats"]
    return summary.withColumns(
        {c: F.array_join(c, ",") for c in ("top_threats", "recommended_watchlist")}
    )


# ---- model answers


@query
def benchmark_answers(spark, sf):
    return answers.parse_benchmarks(b.benchmark_answers(spark, sf), "answer").drop("answer")


@query
def action_answers(spark, sf):
    return answers.parse_actions(b.action_answers(spark, sf), "answer", 3).drop("answer")


@query
def signal_answers(spark, sf):
    parsed = answers.parse_signals(b.signal_answers(spark, sf), "answer")
    return parsed.drop("answer").withColumn("recent_launches", F.array_join("recent_launches", ","))


# ---- the review job


@query
def segment_review(spark, sf):
    """Growth, benchmark gap and opportunity counts of every segment."""
    return _review(spark, sf)["context"]
