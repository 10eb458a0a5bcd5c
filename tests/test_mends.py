"""Sums, days, keys and lists at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.dates import written_day
from quarterdeck.functions.numbers import money_avg, money_sum
from quarterdeck.operators import answers, competitors, deals, growth, health, retrieval
from quarterdeck.operators.contracts import ContractError
from quarterdeck.params import HealthRules, ReviewRules


def test_money_neither_overflows_nor_rounds_away(spark):
    large = spark.createDataFrame([(6e14,), (6e14,)], "v double")
    assert large.agg(money_sum(F.col("v"))).first()[0] == 1.2e15
    small = spark.createDataFrame([(0.00004,)] * 100, "v double")
    assert small.agg(money_sum(F.col("v")), money_avg(F.col("v"))).first()[:] == (0.004, 0.00004)


@pytest.mark.parametrize(
    "text",
    [
        "2024-01-05", "2024-1-5", "2024-01-05 23:30:00", "2024-01-05T23:30:00-05:00", "2024-01-05T23:30:00.123Z", "1/5/2024",
        "1/5/2024 9:05", "1/5/2024 9:05:00 PM", "Jan 5, 2024", "January 5, 2024", "5 Jan 2024", "Fri, 05 Jan 2024 09:00:00 +0000",
        "Fri, 5 Jan 2024 23:59:59 -0800 (PST)", " 2024-01-05 ", "20240105",
    ],
)
def test_days_as_written(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(written_day(F.col("t"))).first()[0] == dt.date(2024, 1, 5)


def test_no_day(spark):
    rows = spark.createDataFrame([("soon",), ("",), (None,), ("2024-13-05",)], "t string").select(written_day(F.col("t"))).collect()
    assert {r[0] for r in rows} == {None}


def test_value_beyond_32_bits(spark):
    row = (" D", "s", "d", 3e9, "r", "a", 1)
    raw = spark.createDataFrame([row], "deal_id string, stage string, close_date string, arr double, rep_name string, account_name string, ordinal long")
    assert deals.normalize_deals(raw).first()["arr"] == 3_000_000_000


def test_chunks_without_a_deal_stay(spark):
    turns = spark.createDataFrame([("a", "x", 1), (None, "y", 2), (None, "z", 3)], "deal_id string, turn_text string, ordinal long")
    mails = spark.createDataFrame([], "deal_id string, body string, ordinal long")
    found = sorted(tuple(r) for r in retrieval.corpus_chunks(turns, mails).select("chunk_id", "document").collect())
    assert found == [(":transcript:0", "y"), (":transcript:1", "z"), ("a:transcript:0", "x")]


def test_a_segment_without_benchmark_stays(spark):
    segments = spark.createDataFrame([("A", "config"), ("B", "config")], "segment string, segments_source string")
    rates = spark.createDataFrame([("A", 9.0), ("B", 9.0)], "segment string, yoy_growth_pct double")
    known = spark.createDataFrame([("A", 1.0)], "segment string, benchmark_growth_pct double")
    found = {r["segment"]: (r["gap_pp"], r["flagged"]) for r in growth.benchmark_gaps(segments, rates, known, ReviewRules()).collect()}
    assert found == {"A": (8.0, True), "B": (None, False)}
    with pytest.raises(ContractError, match="without a benchmark: B"):
        growth.enforce_benchmarks(segments, known)


def test_context_keeps_the_configured_order(spark):
    rows = [("A", 1.0, 1.0, True), ("B", 1.0, 1.0, True)]
    context = spark.createDataFrame(rows, "segment string, benchmark_growth_pct double, gap_pp double, flagged boolean")
    reference = spark.createDataFrame([("Q", "P")], "reference_quarter string, prior_quarter string")
    ranked = spark.createDataFrame([], "competitor_rank int, name string, loss_count long, lost_arr double")
    made = growth.synthesis_context(context, reference, ranked, ReviewRules(segments=("B", "A"))).first()
    assert made["flagged_segments"] == ["B", "A"]
    assert made["context_json"].index('"segment":"B"') < made["context_json"].index('"segment":"A"')


@pytest.mark.parametrize("answer", ["5", "[1,2]", '[{"headline":"x"}]', '"text"', "null"])
def test_only_objects_are_signals(spark, answer):
    found = answers.parse_signals(spark.createDataFrame([(answer,)], "answer string"), "answer").first()
    assert not found["ok"] and found["g2_sentiment"] == "mixed"


def test_no_competitor_stops(spark):
    none = spark.createDataFrame([], "competitor_rank int, name string, headline string")
    assert competitors.threat_summary(none).count() == 0
    with pytest.raises(ContractError):
        competitors.require_competitors(none)


def test_prompts_follow_the_unrounded_score(spark):
    schema = "deal_id string, slip_risk_score double, account_name string, stage string, close_date string, arr long, rep_name string, " \
        "engagement_score double, sentiment_score double, tone_trajectory double, activity_gap_flag boolean, " \
        "sentiment_decline_flag boolean, rag_summary_redacted string"  # fmt: skip
    rows = [(d, s, "a", "s", "c", 1, "r", 0.0, 0.0, 0.0, True, False, "") for d, s in (("x", 0.6501), ("y", 0.65))]
    scored = spark.createDataFrame(rows, schema)
    due = health.handoffs(scored, HealthRules())
    assert [r["deal_id"] for r in due.collect()] == ["x"]
    assert [r["deal_id"] for r in health.prompt_rows(due.withColumn("slip_risk_score", F.round("slip_risk_score", 2)), HealthRules()).collect()] == ["x"]


def test_a_blank_deal_is_not_asked(spark):
    wanted = spark.createDataFrame([("a",), (" ",)], "deal_id string")
    chunks = spark.createDataFrame([("a:0", "a", "text", [1.0, 0.0])], "chunk_id string, deal_id string, document string, embedding array<float>")
    asked = spark.createDataFrame([(0, "q", [1.0, 0.0])], "query_no int, query string, embedding array<float>")
    found = {r["deal_id"]: (r["retrieval_ok"], r["context_block"]) for r in retrieval.deal_context(wanted, chunks, asked, 5).collect()}
    assert found == {"a": (True, "text"), " ": (False, "")}
    blank = asked.withColumn("query", F.lit(" "))
    assert not retrieval.deal_context(wanted, chunks, blank, 5).filter("deal_id = 'a'").first()["retrieval_ok"]
