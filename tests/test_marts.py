import datetime as dt

import pytest

from quarterdeck.operators import contracts, marts
from quarterdeck.params import QualityRules
from quarterdeck.plans import jobs
from quarterdeck.sources import readers

RAW = "`Order Date` string, Segment string, Product string, Region string, Subregion string, Sales double, Profit double, Quantity int"


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            ("2024-01-05", "SMB", "P1", "EMEA", "UK", 10.0, 1.0, 1),
            ("2024-01-05", "SMB", "P1", "EMEA", "UK", 30.0, 3.0, 2),
            ("2024-02-01", "SMB", "P2", "AMER", "US", 100.0, -5.0, 1),
            ("2024-02-02", "Strategic", "P2", "AMER", "US", None, 0.5, 1),
        ],
        RAW,
    )


def test_facts_and_totals(spark, raw, rows):
    facts = marts.revenue_facts(marts.stage_sales(raw))
    assert rows(facts, "order_date", "total_sales", "total_profit", "order_count", "avg_deal_size") == [
        (dt.date(2024, 1, 5), 40.0, 4.0, 2, 20.0),
        (dt.date(2024, 2, 1), 100.0, -5.0, 1, 100.0),
        (dt.date(2024, 2, 2), None, 0.5, 1, None),
    ]
    total = marts.grand_totals(facts).first()
    assert (total["total_sales"], total["total_orders"]) == (140.0, 4)
    # Mean of the two group means, and the mean per order.
    assert (total["avg_deal_size"], total["weighted_deal_size"]) == (60.0, 35.0)


def test_segments_and_zero_sales(spark, raw, rows):
    got = rows(marts.segment_performance(marts.stage_sales(raw)), "segment", "total_orders", "total_sales", "profit_margin")
    assert got == [("SMB", 3, 140.0, -1.0 / 140.0), ("Strategic", 1, None, None)]
    zero = raw.limit(1).selectExpr("* except (Sales)", "0D as Sales")
    assert marts.segment_performance(marts.stage_sales(zero)).first()["profit_margin"] is None


def test_figures_agree_from_rows_and_facts(spark, raw, rows):
    staged = marts.stage_sales(raw)
    facts = marts.revenue_facts(staged)
    for figure in (marts.top_products, marts.top_regions, marts.monthly_trend, marts.segment_regions):
        assert rows(figure(staged)) == rows(figure(facts))
    assert [r["month"] for r in marts.monthly_trend(staged).collect()] == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_top_ties_go_by_key(spark, raw):
    tied = raw.selectExpr("* except (Sales)", "5D as Sales").selectExpr("* except (Product)", "Subregion as Product")
    staged = marts.stage_sales(tied)
    assert [r["product"] for r in marts.top_products(staged).collect()] == ["UK", "US"]


def test_date_format(spark, raw):
    text = raw.limit(1).selectExpr("* except (`Order Date`)", "'3/7/2024' as `Order Date`")
    assert marts.stage_sales(text, "M/d/yyyy").first()["order_date"] == dt.date(2024, 3, 7)


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9, 0.7] * 50
    totals = set()
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(7)
        totals.add(df.agg(marts.money_sum(df["v"])).first()[0])
    assert totals == {65.0}


def test_sales_job(spark, raw, rows, tmp_path):
    raw.write.option("header", True).csv(str(tmp_path / "csv"))
    landed = readers.land_csv(spark, str(tmp_path / "csv"), str(tmp_path / "raw"))
    rules = QualityRules(min_rows=4, max_null_rate=0.5, allowed_segments=("SMB", "Strategic"))
    frames = jobs.sales_marts(landed, str(tmp_path / "marts"), rules)
    assert rows(frames["top_regions"]) == [("AMER", 100.0, -4.5), ("EMEA", 40.0, 4.0)]
    assert [r["segment"] for r in frames["segment_performance"].collect()] == ["SMB", "Strategic"]
    assert sorted(frames) == sorted(
        ["revenue_totals", "segment_performance", "top_products", "top_regions", "monthly_trend", "segment_by_region"]
    )
    with pytest.raises(ValueError, match="row_count_minimum"):
        jobs.sales_marts(landed, str(tmp_path / "none"))
    assert [f.name for f in tmp_path.iterdir() if f.name.startswith(("none", "marts"))] == ["marts"]
    # A refused export leaves the tables of the run before.
    with pytest.raises(ValueError, match="segment_allowed_nonnull"):
        jobs.sales_marts(landed, str(tmp_path / "marts"), QualityRules(min_rows=4, max_null_rate=0.5, allowed_segments=("SMB",)))
    assert rows(spark.read.parquet(str(tmp_path / "marts/fct_revenue"))) == rows(marts.revenue_facts(marts.stage_sales(landed)))


def test_gate_from_groups(spark, raw):
    odd = raw.unionByName(raw.selectExpr("* except (Sales, Segment)", "-1D as Sales", "cast(null as string) as Segment"))
    for data in (raw, odd, raw.limit(0)):
        rules = QualityRules(min_rows=4, allowed_segments=("SMB",))
        flags = contracts.quality_flags(data, rules)
        measured = marts.group_measures(marts.sales_groups(data, flags=flags), list(flags))
        assert measured.first() == contracts.quality_measures(data, rules).first()
        assert contracts.report_of(measured, rules).collect() == contracts.quality_report(data, rules).collect()


def test_roll_ups_equal_the_single_figures(spark, raw, rows):
    more = raw.unionByName(raw.selectExpr("* except (Product, Segment)", "cast(null as string) as Product", "'Mid' as Segment"))
    for data in (more, raw.limit(0)):
        staged = marts.stage_sales(data)
        groups = marts.sales_groups(data)
        rolled = marts.roll_ups(groups)
        frames = jobs.key_figures(rolled, marts.performance_of(rolled))
        facts = marts.revenue_facts(staged)
        assert rows(marts.facts_of(groups).select(facts.columns)) == rows(facts)
        wanted = {
            "revenue_totals": marts.grand_totals(facts),
            "segment_performance": marts.segment_performance(staged),
            "top_products": marts.top_products(facts),
            "top_regions": marts.top_regions(facts),
            "monthly_trend": marts.monthly_trend(facts),
            "segment_by_region": marts.segment_regions(facts),
        }
        for name, frame in wanted.items():
            assert rows(frames[name].select(frame.columns)) == rows(frame), name


def test_one_scan_for_all_figures(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    groups = marts.sales_groups(spark.read.parquet(str(tmp_path / "raw")))
    plan = marts.roll_ups(groups)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
