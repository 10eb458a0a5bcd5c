"""Data contracts and quality gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.dates import written_day
from quarterdeck.functions.text import strip
from quarterdeck.params import ArrBound, QualityRules


class ContractError(ValueError):
    """Input breaks its contract; the load stops."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Names not in the schema; runs no job."""
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df


def exact_columns(df: DataFrame, expected: Sequence[str]) -> bool:
    """Whether the columns are these and no others, apart from the ``ordinal`` that readers add."""
    return set(df.columns) - {"ordinal"} == set(expected) - {"ordinal"}


def require_exact_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    if not exact_columns(df, expected):
        raise ContractError(f"columns {sorted(df.columns)} are not {sorted(expected)}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Stops on an empty input; reads one row."""
    if df.isEmpty():
        raise ContractError("no data rows")
    return df


def key_or_fail(key: str | Column) -> Column:
    """The trimmed key; the reading job fails on the first null or blank one.

    Checking inside the read costs no extra pass over the table.
    """
    name = key if isinstance(key, str) else "key"
    trimmed = strip((F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.raise_error(F.lit(f"empty {name}"))).otherwise(trimmed)


def day_or_fail(text: str) -> Column:
    """The day as written; the reading job fails on the first value that names none."""
    parsed = written_day(F.col(text))
    return F.when(parsed.isNull(), F.raise_error(F.lit(f"invalid or missing {text}"))).otherwise(parsed)


def key_report(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, null keys, blank keys, passed."""
    value = F.col(key).cast("string")
    counted = df.agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNull()).alias("null_keys"),
        F.count_if(strip(value) == "").alias("blank_keys"),
    )
    return counted.withColumn("passed", (F.col("null_keys") == 0) & (F.col("blank_keys") == 0))


def timestamp_report(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, values that name no day, passed."""
    bad = written_day(F.col(column)).isNull()
    counted = df.agg(F.count("*").alias("rows"), F.count_if(bad).alias("invalid_dates"))
    return counted.withColumn("passed", F.col("invalid_dates") == 0)


def quality_flags(raw: DataFrame, rules: QualityRules) -> dict[str, Column]:
    """What counts against a row, by the name of its measure."""
    require_columns(raw, [rules.sales_column, rules.segment_column])
    sales = F.col(f"`{rules.sales_column}`")
    segment = F.col(f"`{rules.segment_column}`")
    allowed = F.coalesce(segment.isin(*rules.allowed_segments), F.lit(False))
    return {"null_sales": sales.isNull(), "nonpositive": sales <= 0, "invalid_segment": ~allowed}


def quality_measures(raw: DataFrame, rules: QualityRules) -> DataFrame:
    """All numbers the five checks need, from one pass over two columns."""
    flags = quality_flags(raw, rules)
    return raw.agg(F.count("*").alias("rows"), *(F.count_if(flag).alias(name) for name, flag in flags.items()))


def quality_report(raw: DataFrame, rules: QualityRules) -> DataFrame:
    """Five rows (position, name, passed, detail).  An empty table has no null rate and fails that check."""
    return report_of(quality_measures(raw, rules), rules)


def report_of(measures: DataFrame, rules: QualityRules) -> DataFrame:
    """The report from one row of measures."""
    rate = F.try_divide(F.col("null_sales"), F.col("rows"))
    shown_rate = F.when(F.col("rows") == 0, F.lit("nan")).otherwise(F.format_string("%.5f", rate))

    def check(position: int, name: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("name"),
            passed.alias("passed"),
            detail.alias("detail"),
        )

    # Check names and detail formats.
    checks = F.array(
        check(
            1,
            "row_count_minimum",
            F.col("rows") >= rules.min_rows,
            F.concat(F.lit("count="), F.col("rows"), F.lit(f", min={rules.min_rows}")),
        ),
        check(2, "sales_column_exists", F.lit(True), F.lit(f"'{rules.sales_column}' present=True")),
        check(
            3,
            "sales_null_rate",
            F.when(F.col("rows") == 0, F.lit(False)).otherwise(rate < rules.max_null_rate),
            F.concat(F.lit("rate="), shown_rate, F.lit(f", max={rules.max_null_rate}")),
        ),
        check(
            4,
            "sales_positive_nonnull",
            F.col("nonpositive") == 0,
            F.concat(F.lit("nonpositive_nonnull="), F.col("nonpositive")),
        ),
        check(
            5,
            "segment_allowed_nonnull",
            F.col("invalid_segment") == 0,
            F.concat(F.lit("invalid_or_null="), F.col("invalid_segment")),
        ),
    )
    return measures.select(F.inline(checks))


def gate(report: DataFrame) -> DataFrame:
    """One row: passed, and the failed checks in report order."""
    failed = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.struct("position", "name"))))
    return report.agg(
        F.bool_and("passed").alias("passed"),
        F.array_join(failed["name"], ", ").alias("failed_checks"),
    )


def enforce_gate(report: DataFrame) -> None:
    """Runs the report and stops the job on a failed check."""
    outcome = gate(report).first()
    if not outcome["passed"]:
        raise ContractError(f"quality checks failed: {outcome['failed_checks']}")


def id_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Ids found on one side only.

    Both sides are cut to distinct ids before the shuffle, so an id that fills a
    third of a table costs one row per map task.
    """
    sides = left.select(F.col(key), F.lit(True).alias("in_left"), F.lit(False).alias("in_right")).unionByName(
        right.select(F.col(key), F.lit(False).alias("in_left"), F.lit(True).alias("in_right"))
    )
    merged = sides.groupBy(key).agg(F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right"))
    return merged.filter(~(F.col("in_left") & F.col("in_right")))


def enforce_same_ids(left: DataFrame, right: DataFrame, key: str) -> None:
    if not id_set_difference(left, right, key).isEmpty():
        raise ContractError(f"{key} not consistent across tables")


def _outside(value: Column, expected: Sequence[str]) -> Column:
    return ~F.coalesce(value.isin(*expected), F.lit(False))


def _seen(value: Column, expected: str) -> Column:
    return F.coalesce(F.bool_or(value == expected), F.lit(False))


def domain_holds(value: Column, expected: Sequence[str]) -> Column:
    """Aggregate: only expected values occur, and all of them do."""
    holds = F.count_if(_outside(value, expected)) == 0
    for each in expected:
        holds = holds & _seen(value, each)
    return holds


def _fits(bound: ArrBound, smallest: Column, largest: Column) -> Column:
    fits = F.lit(True)
    if bound.minimum is not None:
        fits = fits & (smallest >= bound.minimum)
    if bound.maximum is not None:
        fits = fits & ((largest <= bound.maximum) if bound.maximum_allowed else (largest < bound.maximum))
    return fits


def bounds_hold(bounds: Sequence[ArrBound]) -> Column:
    """Aggregate: every bounded segment occurs and stays in its range."""
    holds = F.lit(True)
    for bound in bounds:
        value = F.when(F.col("segment") == bound.segment, F.col("arr"))
        holds = holds & F.coalesce(_fits(bound, F.min(value), F.max(value)), F.lit(False))
    return holds


def domain_report(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """One row: rows outside the expected values, expected values never seen, passed."""
    value = F.col(column)
    unseen = F.array_compact(F.array(*(F.when(~_seen(value, v), F.lit(v)) for v in expected)))
    counted = df.agg(
        F.count_if(_outside(value, expected)).alias("unexpected_rows"),
        F.array_join(unseen, ",").alias("unseen_values"),
    )
    return counted.withColumn("passed", (F.col("unexpected_rows") == 0) & (F.col("unseen_values") == ""))


def null_report(df: DataFrame, column: str) -> DataFrame:
    counted = df.agg(F.count_if(F.col(column).isNull()).alias("null_rows"))
    return counted.withColumn("passed", F.col("null_rows") == 0)


def arr_bounds_report(opportunities: DataFrame, bounds: Sequence[ArrBound]) -> DataFrame:
    """Smallest and largest value by segment, and whether both are in range."""
    within = F.lit(None).cast("boolean")
    for bound in bounds:
        fits = _fits(bound, F.col("min_arr"), F.col("max_arr"))
        within = F.when(F.col("segment") == bound.segment, fits).otherwise(within)
    spans = opportunities.groupBy("segment").agg(F.min("arr").alias("min_arr"), F.max("arr").alias("max_arr"))
    return spans.withColumn("passed", within).filter(F.col("passed").isNotNull())


def segment_growth_means(bookings: DataFrame) -> DataFrame:
    """Mean benchmark and actual growth by segment, and their gap."""
    means = bookings.filter(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.avg("benchmark_growth_pct").alias("benchmark_growth_pct"),
        F.avg("actual_growth_pct").alias("actual_growth_pct"),
    )
    return means.withColumn("gap", F.col("actual_growth_pct") - F.col("benchmark_growth_pct"))


def growth_variation(bookings: DataFrame) -> DataFrame:
    """One row: smallest gap, largest gap, and whether both signs occur."""
    spread = segment_growth_means(bookings).agg(F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"))
    return spread.withColumn("passed", (F.col("min_gap") < 0) & (F.col("max_gap") > 0))


def segment_coverage(quarterly: DataFrame, segments: Sequence[str]) -> DataFrame:
    """Every configured segment with its number of quarters; two are needed."""
    asked = quarterly.sparkSession.createDataFrame(list(enumerate(segments)), "position int, segment string")
    counted = quarterly.groupBy("segment").agg(F.count("*").alias("quarters"))
    return (
        asked.join(counted, "segment", "left")
        .withColumn("quarters", F.coalesce("quarters", F.lit(0).cast("long")))
        .withColumn("passed", F.col("quarters") >= 2)
    )


def enforce_coverage(quarterly: DataFrame, segments: Sequence[str]) -> None:
    poor = segment_coverage(quarterly, segments).filter(~F.col("passed")).orderBy("position").collect()
    if poor:
        listed = ", ".join(f"{r['segment']} ({r['quarters']})" for r in poor)
        raise ContractError(f"segments with fewer than 2 quarters of bookings: {listed}")
