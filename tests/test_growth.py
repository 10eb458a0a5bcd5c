import json

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import competitors as comp
from quarterdeck.operators import growth
from quarterdeck.operators.ordering import head_per_group
from quarterdeck.params import ReviewRules
from quarterdeck.plans import jobs

RULES = ReviewRules()
QUARTERS = "segment string, quarter string, booked_arr double"
# Quarter totals of the sample bookings.
SAMPLE = [
    ("Enterprise", "2025-Q1", 1996381.40),
    ("Enterprise", "2025-Q3", 2196019.54),
    ("Enterprise", "2025-Q4", 2295838.61),
    ("Mid-Market", "2025-Q1", 947465.28),
    ("Mid-Market", "2025-Q3", 979047.47),
    ("Mid-Market", "2025-Q4", 994838.54),
    ("SMB", "2025-Q1", 470661.17),
    ("SMB", "2025-Q3", 498900.85),
    ("SMB", "2025-Q4", 513020.68),
]
BENCHMARKS = [("Enterprise", 12.0), ("Mid-Market", 10.0), ("SMB", 8.0)]
OPPS = "opportunity_id string, segment string, account_name string, arr double, stage string, win_loss_reason string"


@pytest.fixture
def quarterly(spark):
    return spark.createDataFrame(SAMPLE, QUARTERS)


def test_growth_and_gaps_golden(spark, quarterly, rows):
    rates = growth.segment_growth(quarterly)
    assert rows(rates, "segment", "qoq_growth_pct", "yoy_growth_pct") == [
        ("Enterprise", 4.55, 15.0),
        ("Mid-Market", 1.61, 5.0),
        ("SMB", 2.83, 9.0),
    ]
    benchmarks = spark.createDataFrame(BENCHMARKS, "segment string, benchmark_growth_pct double")
    gaps = growth.benchmark_gaps(growth.segment_source(rates, RULES.segments), rates, benchmarks, RULES)
    # Mid-Market grows 4.9999996 %: flagged only because growth is rounded before the gap.
    assert rows(gaps, "segment", "gap_pp", "flagged") == [
        ("Enterprise", 3.0, False),
        ("Mid-Market", -5.0, True),
        ("SMB", 1.0, False),
    ]
    assert growth.flagged_segments(gaps, RULES.segments).first()[0] == "Mid-Market"
    row = growth.run_log_row(gaps, growth.reference_quarters(quarterly, RULES.segments), RULES, "told", "[1]").first()
    assert (row["reference_quarter"], row["flagged_segments"], row["narrative"]) == ("2025-Q4", "Mid-Market", "told")
    assert [g["segment"] for g in row["gap_rows"]] == list(RULES.segments) and len(row["run_id"]) == 64
    again = growth.run_log_row(gaps, growth.reference_quarters(quarterly, RULES.segments), RULES, "told", "[1]").first()
    other = growth.run_log_row(gaps, growth.reference_quarters(quarterly, RULES.segments), RULES, "else", "[1]").first()
    assert again["run_id"] == row["run_id"] != other["run_id"]
    assert row["gap_rows"][0].asDict() == {
        "segment": "Enterprise",
        "internal_yoy_growth_pct": 15.0,
        "benchmark_growth_pct": 12.0,
        "gap_pp": 3.0,
        "flagged": False,
        "source_summary": "",
        "confidence": "",
    }


def test_one_quarter_and_zero_base(spark):
    one = growth.segment_growth(spark.createDataFrame([("A", "q1", 5.0)], QUARTERS)).first()
    assert one["qoq_growth_pct"] is None and one["yoy_growth_pct"] is None
    zero = spark.createDataFrame([("A", "q1", 0.0), ("A", "q2", 5.0)], QUARTERS)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        growth.segment_growth(zero).collect()


def test_quarters(spark, quarterly, rows):
    assert tuple(growth.reference_quarters(quarterly, ["SMB"]).first()) == ("2025-Q4", "2025-Q3")
    maps = {r["segment"]: r["quarterly_arr"] for r in growth.quarter_maps(quarterly).collect()}
    assert maps["SMB"] == {"2025-Q1": 470661.17, "2025-Q3": 498900.85, "2025-Q4": 513020.68}
    keys = growth.quarter_maps(quarterly).select(F.map_keys("quarterly_arr")).first()[0]
    assert keys == ["2025-Q1", "2025-Q3", "2025-Q4"]
    raw = [("A", "q", 0.1), ("A", "q", 0.2), ("A", "q", 0.004), ("B", "q", None), (None, "q", 1.0), ("A", None, 1.0)]
    assert rows(growth.quarterly_arr(spark.createDataFrame(raw, QUARTERS))) == [("A", "q", 0.3), ("B", "q", 0.0)]


def test_segment_source(spark, quarterly, rows):
    rates = growth.segment_growth(quarterly)
    assert {r[1] for r in rows(growth.segment_source(rates, ["X"]))} == {"crm_sync"}
    assert rows(growth.segment_source(rates.limit(0), ["X", "Y"])) == [("X", "config"), ("Y", "config")]
    assert "Query focus: SMB SaaS ARR growth rate benchmark 2026" in growth.benchmark_prompts(
        spark.createDataFrame([("SMB",)], "segment string"), "p", RULES
    ).first()["prompt"]


def opportunities(spark):
    data = [
        ("1", "Enterprise", "a", 343406.0, "Closed Lost", "Lost to Acme on product fit"),
        ("2", "Mid-Market", "b", 122529.0, "Closed Lost", " Lost to North Co on pricing "),
        ("3", "Mid-Market", "c", 10.0, "Closed Lost", "Lost due to missing feature"),
        ("4", "SMB", "d", 5.0, "Closed Won", "Lost to Acme on pricing"),
        ("5", "SMB", "e", 1.0, "Closed Lost", "Lost to Acme on on on time"),
        ("6", None, "f", 1.0, "Closed Lost", None),
    ]
    return spark.createDataFrame(data, OPPS)


def test_summary(spark, rows):
    opps = opportunities(spark)
    assert rows(growth.opportunity_summary(opps)) == [
        ("Enterprise", 1, 0, 1, 343406.0),
        ("Mid-Market", 2, 0, 2, 122539.0),
        ("SMB", 2, 1, 1, 6.0),
    ]
    assert growth.opportunity_totals(opps).first()[0] == 6


def test_competitors(spark, rows):
    losses = comp.competitor_losses(opportunities(spark))
    assert rows(losses, "name", "theme") == [("Acme", "on on time"), ("Acme", "product fit"), ("North Co", "pricing")]
    stats = comp.competitor_stats(losses)
    ranked = comp.rank_competitors(stats, 3)
    assert rows(ranked, "competitor_rank", "name", "loss_count", "lost_arr", "loss_themes") == [
        (1, "Acme", 2, 343407.0, ["on on time", "product fit"]),
        (2, "North Co", 1, 122529.0, ["pricing"]),
    ]
    tied = spark.createDataFrame([("b", 1, 5.0), ("a", 1, 5.0), ("c", 2, 5.0), ("d", 9, 4.0)], "name string, loss_count long, lost_arr double")
    order = comp.rank_competitors(tied.withColumn("loss_themes", F.array(F.lit("t"))), 3)
    assert [r["name"] for r in order.orderBy("competitor_rank").collect()] == ["c", "a", "b"]
    assert comp.search_queries(ranked).first()["query"] == "Acme G2 reviews pricing product launch SaaS"
    plain = ranked.withColumn("headline", F.lit(""))
    got = comp.threat_summary(plain).first()
    assert (got["top_threats"], got["headline"], got["recommended_watchlist"]) == (["Acme", "North Co"], "Top threat: Acme", ["Acme", "North Co"])
    assert comp.threat_summary(ranked.withColumn("headline", F.concat(F.lit("h "), "name"))).first()["headline"] == "h Acme"


def test_snippets(spark, rows):
    hits = spark.createDataFrame(
        [
            ("q", 3, "T3", None, "2026-01-10", ["x", "y"], "text"),
            ("q", 1, None, "u1", "2026-01-09", [], "whole text"),
            ("q", 2, "T2", "u2", "2025-01-01", None, "old"),
            ("q", 4, "T4", "u4", "2026-01-10", None, None),
            ("q", 5, "T5", "u5", "2026-01-10", None, "beyond"),
        ],
        "query string, ordinal long, title string, url string, published string, highlights array<string>, text string",
    ).withColumn("published", F.col("published").cast("date"))
    got = comp.search_snippets(hits, F.lit("2026-01-12").cast("date"), 3, 3)
    assert rows(got) == [("q", 1, "", "u1", "whole text"), ("q", 3, "T3", "", "x y"), ("q", 4, "T4", "u4", "")]
    blob = comp.snippet_blobs(got).first()
    assert blob["blob"].startswith("Title: \nURL: u1\nSnippet: whole text\n\nTitle: T3") and blob["sources"] == ["u1", "u4"]


def test_allocation_adds_up(spark, rows):
    opps = spark.range(1, 1001).selectExpr(
        "cast(id as string) opportunity_id", "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END segment", "id * 1.0D as arr"
    )
    targets = spark.createDataFrame([("A", "q1", 1000.0), ("A", "q2", 1234.56), ("B", "q1", 99.0)], "segment string, quarter string, target double")
    shared = growth.allocate_bookings(opps, targets, "arr")
    sums = {(r[0], r[1]): r[2] for r in shared.groupBy("segment", "quarter").agg(F.sum("booked_arr")).collect()}
    assert set(sums) == {("A", "q1"), ("A", "q2"), ("B", "q1")}
    assert sums["A", "q2"] == pytest.approx(1234.56, abs=0.005 * 333)
    three = shared.filter("opportunity_id = '3' AND quarter = 'q1'").first()["booked_arr"]
    assert three == round(1000.0 * 3 / sum(range(3, 1001, 3)), 2)


def test_sampling(spark, rows):
    opps = opportunities(spark).filter("segment is not null")
    picked = head_per_group(opps, ["segment"], ["opportunity_id"], 1).select("opportunity_id")
    lines = spark.createDataFrame([("1", 1), ("1", 2), ("3", 3), ("4", 4)], "opportunity_id string, n int")
    assert rows(growth.sampled_rows(lines, picked, "opportunity_id")) == [("1", 1), ("1", 2), ("4", 4)]


def test_review_job(spark, quarterly, rows, tmp_path):
    opps = opportunities(spark).filter("segment is not null")
    books = quarterly.withColumn("opportunity_id", F.lit("1"))
    one = opps.limit(1)
    benchmarks = spark.createDataFrame(BENCHMARKS, "segment string, benchmark_growth_pct double")
    frames = jobs.segment_review(one, books, benchmarks, str(tmp_path))
    context = {r["segment"]: r for r in frames["context"].collect()}
    assert context["Enterprise"]["closed_lost"] == 1 and context["SMB"]["count"] is None
    made = json.loads(frames["synthesis"].first()["context_json"])
    assert made["reference_quarter"] == "2025-Q4" and made["flagged_segments"] == ["Mid-Market"]
    assert [c["name"] for c in made["competitors"]] == ["Acme"] and made["gtm_actions_count"] == 3
    assert frames["threats"].first()["headline"] == "Top threat: Acme"
    signals = spark.createDataFrame([("Acme", "high", "Cuts prices"), ("Else", "low", "x")], "name string, threat_level string, headline string")
    told = jobs.segment_review(one, books, benchmarks, str(tmp_path), signals=signals)
    assert json.loads(told["synthesis"].first()["context_json"])["competitors"][0]["threat_level"] == "high"
    assert rows(told["threats"]) == [(["Acme"], "Cuts prices", ["Acme"])]
    with pytest.raises(ValueError, match="no competitor"):
        jobs.segment_review(one.withColumn("stage", F.lit("Closed Won")), books, benchmarks, str(tmp_path))
    with pytest.raises(ValueError, match="not consistent"):
        jobs.segment_review(opps, books, benchmarks, str(tmp_path))
    with pytest.raises(ValueError, match=r"SMB \(0\)"):
        jobs.segment_review(one, books.filter("segment <> 'SMB'"), benchmarks, str(tmp_path))
