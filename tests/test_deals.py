import datetime as dt

import pytest

from quarterdeck.functions import report
from quarterdeck.operators import deals, health, retrieval
from quarterdeck.params import ActivityRules, HealthRules
from quarterdeck.plans import jobs

DEALS = "deal_id string, stage string, close_date string, arr double, rep_name string, account_name string, ordinal long"
LOG = "deal_id string, activity_type string, activity_date string, contact_role string"
TODAY = dt.date(2026, 5, 21)


@pytest.fixture
def five(spark):
    data = [(f"DEAL-100{i}", "Proposal", "2026-06-01", 1000.0 * i, "Rep", f"Account {i}", i) for i in range(5)]
    return deals.one_row_per_deal(deals.normalize_deals(spark.createDataFrame(data, DEALS)))


@pytest.fixture
def log(spark):
    data = [
        ("DEAL-1000", "Call", "2026-04-28", None),
        ("DEAL-1000", "Email", "2026-05-05", "x"),
        (" DEAL-1000 ", "Call", "2026-05-05", "x"),
        ("DEAL-1001", "Meeting", "2026-05-04", "x"),
        ("DEAL-1001", "Email", "2026-05-01", "x"),
        *[("DEAL-9", "Call", "2026-05-20", "x")] * 9,
    ]
    return spark.createDataFrame(data, LOG)


def signals(five, log, **rules):
    out = deals.activity_signals(five, log, TODAY, ActivityRules(**rules))
    return {r["deal_id"]: r for r in out.collect()}


def test_activity_golden(five, log):
    got = signals(five, log)
    assert got["DEAL-1000"]["days_since_last"] == 16 and got["DEAL-1000"]["activity_gap_flag"]
    assert round(got["DEAL-1000"]["engagement_score"], 6) == 0.714286  # the busier DEAL-9 was not asked for
    assert round(got["DEAL-1001"]["engagement_score"], 6) == 0.529762
    assert (got["DEAL-1002"]["engagement_score"], got["DEAL-1002"]["activity_gap_flag"]) == (0.0, True)
    assert (got["DEAL-1002"]["activity_count"], got["DEAL-1002"]["last_activity_date"]) == (0, None)


def test_gap_is_strict_and_future_dates_count(spark, five, log):
    assert not signals(five, log, gap_days=16)["DEAL-1000"]["activity_gap_flag"]
    assert signals(five, log, gap_days=15)["DEAL-1000"]["activity_gap_flag"]
    future = spark.createDataFrame([("DEAL-1000", "Call", "2026-06-30", None)], LOG)
    got = signals(five, future, recency_weight=0.2)["DEAL-1000"]
    assert got["days_since_last"] == -40 and got["engagement_score"] == pytest.approx(0.2 * (1 + 40 / 28) + 0.5)
    assert signals(five, future)["DEAL-1000"]["engagement_score"] == 1.0
    none = spark.createDataFrame([], LOG)
    assert signals(five, none)["DEAL-1000"]["engagement_score"] == 0.0


def test_health_golden(five, log):
    active = deals.activity_signals(five, log, TODAY, ActivityRules())
    got = {r["deal_id"]: r for r in health.score_health(active, HealthRules()).collect()}
    assert round(got["DEAL-1001"]["deal_health_score"], 6) == 0.386905 and not got["DEAL-1001"]["handoff_triggered"]
    for deal in ("DEAL-1002", "DEAL-1003", "DEAL-1004"):
        assert (got[deal]["deal_health_score"], got[deal]["handoff_triggered"]) == (pytest.approx(0.175), True)
    for row in got.values():
        assert 0 <= row["deal_health_score"] <= 1 and row["slip_risk_score"] == 1 - row["deal_health_score"]


def test_trigger_is_strict(five):
    exact = health.score_health(five, HealthRules(handoff_trigger=0.825))
    assert health.handoffs(exact, HealthRules(handoff_trigger=0.825)).isEmpty()
    assert tuple(health.batch_counts(exact).first()) == (5, 0)


def test_assembly_without_signals(five, log):
    some = deals.activity_signals(five.select("deal_id").limit(1), log, TODAY, ActivityRules())
    scored = health.assemble_deals(five, some, None, None, HealthRules()).collect()
    assert len(scored) == 5 and sum(r["engagement_score"] is None for r in scored) == 4
    assert {r["rag_summary_redacted"] for r in scored} == {""}


def test_last_row_wins_first_row_orders(spark, rows):
    data = [
        ("B ", " Old ", "d", 1.9, "r", "a", 5),
        (" A", "Only", "d", 2.0, "r", "a", 7),
        ("B", "New\t", "d", 3.0, "r", "a", 9),
    ]
    normal = deals.normalize_deals(spark.createDataFrame(data, DEALS))
    assert rows(deals.one_row_per_deal(normal), "deal_id", "first_seen", "stage", "arr") == [("A", 7, "Only", 2), ("B", 5, "New", 3)]
    assert [r["deal_id"] for r in deals.deal_order(normal).collect()] == ["B", "A"]
    bad = spark.createDataFrame([(" ", "s", "d", 1.0, "r", "a", 1)], DEALS)
    with pytest.raises(Exception, match="empty deal_id"):
        deals.normalize_deals(bad).collect()
    keys = spark.createDataFrame([(" x ",), (" ",), (None,)], "deal_id string")
    assert rows(deals.requested_keys(keys)) == [("x",)]


def test_report(five, log, spark, tmp_path):
    active = deals.activity_signals(five, log, TODAY, ActivityRules())
    scored = health.score_health(active, HealthRules())
    frames = jobs.deal_review(scored, str(tmp_path), "Assess", "2026-05-21 05:48 UTC")
    files = sorted((tmp_path / "deal_health_report").glob("part-*.txt"))
    lines = "".join(f.read_text() for f in files).splitlines()
    assert lines[:4] == ["# Deal health report", "", "Generated: 2026-05-21 05:48 UTC", "Query: Assess"]
    assert lines[9] == "| DEAL-1000 | Account 0 | Proposal | 0.46 | 0.54 | True |  | False |"
    # 0.175 and 0.825 are just below their decimal text in binary.
    assert lines[11] == "| DEAL-1002 | Account 2 | Proposal | 0.17 | 0.82 | True |  | True |"
    assert lines[-1] == report.REPORT_NO_HANDOFFS
    prompts = {r["deal_id"]: r["prompt"] for r in frames["prompts"].collect()}
    assert sorted(prompts) == ["DEAL-1002", "DEAL-1003", "DEAL-1004"]
    assert "close_date: 2026-06-01 | arr: 2000 | rep: Rep" in prompts["DEAL-1002"].splitlines()


def test_report_with_adjustments(five, spark):
    scored = health.score_health(five, HealthRules())
    answers = spark.createDataFrame([("DEAL-1004", "late"), ("DEAL-1001", "push"), ("DEAL-1002", "")], "deal_id string, markdown string")
    sections = health.adjustment_sections(scored, answers)
    lines = health.report_lines(scored, "q", "now", sections).orderBy("part", "place")
    text = "\n".join(r["value"] for r in lines.collect())
    tail = text.split("## Forecast adjustments\n\n")[1]
    first, second = tail.split("\n\n---\n\n")
    assert first == "## Forecast adjustment — DEAL-1001 (Account 1)\n\npush"
    assert second == "## Forecast adjustment — DEAL-1004 (Account 4)\n\nlate"


def test_whole_deal_job(spark, log):
    raw = spark.createDataFrame([("DEAL-1000", "Proposal", "2026-06-01", 1.0, "Rep", "Acc", 0), ("X", "s", "d", 1.0, "r", "a", 1)], DEALS)
    turns = spark.createDataFrame(
        [("DEAL-1000", "2026-05-01", 1, 1, "Buyer", "great, mail me at a@b.co", 0)],
        "deal_id string, call_date string, call_num int, turn_num int, speaker string, turn_text string, ordinal long",
    )
    mails = spark.createDataFrame([], "deal_id string, body string, timestamp string, ordinal long")
    chunks = jobs.index_corpus(turns, mails)
    asked = retrieval.with_embeddings(retrieval.query_table(spark, ["mail"]), "query")
    scored = {r["deal_id"]: r for r in jobs.score_deals(raw, log, turns, mails, chunks, asked, TODAY).collect()}
    assert scored["DEAL-1000"]["rag_summary_redacted"] == "great, mail me at [REDACTED_EMAIL]"
    assert scored["DEAL-1000"]["sentiment_score"] == 1.0 and scored["DEAL-1000"]["deal_intel_ok"]
    assert (scored["X"]["rag_summary_redacted"], scored["X"]["sentiment_score"]) == ("", 0.0)
