import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import contracts, deals
from quarterdeck.params import ARR_BOUNDS, QualityRules, ReviewRules
from quarterdeck.plans import jobs

SALES = "Sales double, Segment string"
RULES = QualityRules(min_rows=4, max_null_rate=0.25)


def report(spark, data, rules=RULES):
    return {r["name"]: (r["passed"], r["detail"]) for r in contracts.quality_report(spark.createDataFrame(data, SALES), rules).collect()}


def test_quality_all_good(spark):
    data = [(1.0, "SMB"), (2.0, "Enterprise"), (3.0, "Strategic"), (4.0, "SMB")]
    assert all(passed for passed, _ in report(spark, data).values())
    contracts.enforce_gate(contracts.quality_report(spark.createDataFrame(data, SALES), RULES))


def test_quality_edges(spark):
    got = report(spark, [(None, "SMB"), (0.0, None), (3.0, "Other")])
    assert got["row_count_minimum"] == (False, "count=3, min=4")
    assert got["sales_column_exists"] == (True, "'Sales' present=True")
    assert got["sales_null_rate"] == (False, "rate=0.33333, max=0.25")
    assert got["sales_positive_nonnull"] == (False, "nonpositive_nonnull=1")
    assert got["segment_allowed_nonnull"] == (False, "invalid_or_null=2")
    at_limit = report(spark, [(None, "SMB"), (1.0, "SMB"), (1.0, "SMB"), (1.0, "SMB")])
    assert at_limit["sales_null_rate"][0] is False


def test_quality_of_an_empty_table_and_a_missing_column(spark):
    got = report(spark, [])
    assert got["sales_null_rate"] == (False, "rate=nan, max=0.25") and got["sales_positive_nonnull"][0]
    with pytest.raises(contracts.ContractError, match="missing columns: Sales"):
        contracts.quality_report(spark.createDataFrame([("SMB",)], "Segment string"), RULES)
    with pytest.raises(contracts.ContractError, match="row_count_minimum, sales_null_rate"):
        contracts.enforce_gate(contracts.quality_report(spark.createDataFrame([], SALES), RULES))


def test_keys(spark):
    df = spark.createDataFrame([("a",), (" ",), (None,)], "k string")
    assert tuple(contracts.key_report(df, "k").first()) == (3, 1, 1, False)
    with pytest.raises(Exception, match="empty k"):
        df.select(contracts.key_or_fail("k")).collect()
    assert [r[0] for r in df.limit(1).select(contracts.key_or_fail("k")).collect()] == ["a"]


def test_one_bad_date_fails_the_batch(spark):
    log = spark.createDataFrame(
        [("D", "Call", "2026-01-01", None), ("D", "Call", "soon", None)],
        "deal_id string, activity_type string, activity_date string, contact_role string",
    )
    assert tuple(contracts.timestamp_report(log, "activity_date").first()) == (2, 1, False)
    with pytest.raises(Exception, match="invalid or missing activity_date"):
        deals.activity_counts(log).collect()


def test_id_sets(spark, rows):
    left = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    right = spark.createDataFrame([(2,), (3,)], "id int")
    assert rows(contracts.id_set_difference(left, right, "id")) == [(1, True, False), (3, False, True)]
    contracts.enforce_same_ids(left, left.distinct(), "id")
    with pytest.raises(contracts.ContractError):
        contracts.enforce_same_ids(left, right, "id")


def test_domain(spark):
    df = spark.createDataFrame([("a",), ("x",), (None,)], "s string")
    assert tuple(contracts.domain_report(df, "s", ["a", "b"]).first()) == (2, "b", False)
    assert tuple(contracts.domain_report(df.limit(1), "s", ["a"]).first()) == (0, "", True)


def test_coverage(spark, rows):
    quarterly = spark.createDataFrame([("A", "q1"), ("A", "q2"), ("B", "q1")], "segment string, quarter string")
    got = contracts.segment_coverage(quarterly, ["A", "B", "C"])
    assert rows(got, "segment", "quarters", "passed") == [("A", 2, True), ("B", 1, False), ("C", 0, False)]
    with pytest.raises(contracts.ContractError, match=r"B \(1\), C \(0\)"):
        contracts.enforce_coverage(quarterly, ["A", "B", "C"])


def audit_tables(spark):
    opp = spark.createDataFrame(
        [(1, "Enterprise", 200000, "r"), (2, "Mid-Market", 50000, "r"), (3, "Mid-Market", 200000, "r"), (4, "SMB", 49999, "r")],
        "opportunity_id int, segment string, arr int, win_loss_reason string",
    ).withColumns({"account_name": F.lit("a"), "stage": F.lit("s")})
    quarters = F.explode(F.array(*(F.lit(f"2025-Q{i}") for i in range(1, 5)))).alias("quarter")
    book = opp.select(
        "opportunity_id",
        "segment",
        quarters,
        F.lit(1.0).alias("booked_arr"),
        F.lit(10.0).alias("benchmark_growth_pct"),
        F.when(F.col("segment") == "SMB", 15.0).otherwise(5.0).alias("actual_growth_pct"),
    )
    return opp, book


def test_audit_passes_on_bounds(spark, rows):
    opp, book = audit_tables(spark)
    audit = jobs.contract_audit(opp, book, ReviewRules())
    assert all(passed for _, passed in rows(audit)) and audit.count() == 8


@pytest.mark.parametrize(
    ("contract", "change"),
    [
        ("same_ids", lambda o, b: (o, b.filter("opportunity_id <> 2"))),
        ("opportunity_columns", lambda o, b: (o.withColumn("more", F.lit(1)), b)),
        ("booking_columns", lambda o, b: (o, b.drop("booked_arr"))),
        ("segment_domain", lambda o, b: (o.withColumn("segment", F.when(F.col("opportunity_id") > 1, F.col("segment"))), b)),
        ("arr_bounds", lambda o, b: (o.withColumn("arr", F.when(F.col("segment") == "SMB", 50000).otherwise(F.col("arr"))), b)),
        ("reason_present", lambda o, b: (o.withColumn("win_loss_reason", F.nullif(F.lit("r"), F.col("win_loss_reason"))), b)),
        ("quarter_domain", lambda o, b: (o, b.withColumn("quarter", F.replace("quarter", F.lit("Q4"), F.lit("Q3"))))),
        ("growth_variation", lambda o, b: (o, b.withColumn("actual_growth_pct", F.lit(10.0)))),
    ],
)
def test_audit_finds(spark, contract, change):
    found = {r["contract"]: r["passed"] for r in jobs.contract_audit(*change(*audit_tables(spark)), ReviewRules()).collect()}
    assert found[contract] is False


def test_bounds_report(spark, rows):
    opp, _ = audit_tables(spark)
    assert rows(contracts.arr_bounds_report(opp, ARR_BOUNDS), "segment", "passed") == [
        ("Enterprise", True),
        ("Mid-Market", True),
        ("SMB", True),
    ]
    low = opp.withColumn("arr", F.col("arr") - 1)
    assert rows(contracts.arr_bounds_report(low, ARR_BOUNDS), "segment", "passed") == [
        ("Enterprise", False),
        ("Mid-Market", False),
        ("SMB", True),
    ]


def test_exact_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    contracts.require_exact_columns(df, ["b", "a"])
    with pytest.raises(contracts.ContractError):
        contracts.require_exact_columns(df, ["a"])
