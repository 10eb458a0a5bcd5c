"""Sales staging, marts and key figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.numbers import MONEY, money_avg, money_sum, safe_ratio

# Headers of the sales export.
RAW_COLUMNS = ("Order Date", "Segment", "Product", "Region", "Subregion", "Sales", "Profit", "Quantity")
MART_KEYS = ("order_date", "segment", "product", "region", "subregion")


def stage_sales(raw: DataFrame, date_format: str | None = None, *more: str) -> DataFrame:
    """Rename and type the export; ``date_format`` is for dates that are not ISO text, columns ``more`` stay as they are."""
    day = F.col("Order Date")
    return raw.select(
        (F.to_date(day, date_format) if date_format else day.cast("date")).alias("order_date"),
        F.col("Segment").alias("segment"),
        F.col("Product").alias("product"),
        F.col("Region").alias("region"),
        F.col("Subregion").alias("subregion"),
        F.col("Sales").cast("double").alias("sales"),
        F.col("Profit").cast("double").alias("profit"),
        F.col("Quantity").cast("int").alias("quantity"),
        *more,
    )


def revenue_facts(staged: DataFrame) -> DataFrame:
    """Sales by day, segment, product, region and subregion."""
    return staged.groupBy(*MART_KEYS).agg(
        money_sum(F.col("sales")).alias("total_sales"),
        money_sum(F.col("profit")).alias("total_profit"),
        F.count("*").alias("order_count"),
        money_avg(F.col("sales")).alias("avg_deal_size"),
    )


def segment_performance(staged: DataFrame) -> DataFrame:
    totals = staged.groupBy("segment").agg(
        F.count("*").alias("total_orders"),
        money_sum(F.col("sales")).alias("total_sales"),
        money_sum(F.col("profit")).alias("total_profit"),
        money_avg(F.col("sales")).alias("avg_deal_size"),
    )
    return totals.withColumn("profit_margin", safe_ratio(F.col("total_profit"), F.col("total_sales")))


def grand_totals(facts: DataFrame) -> DataFrame:
    """One row of totals over the revenue facts.

    ``avg_deal_size`` is the plain mean of the group means; the mean per order
    stands beside it as ``weighted_deal_size``.
    """
    totals = facts.agg(
        money_sum(F.col("total_sales")).alias("total_sales"),
        money_sum(F.col("total_profit")).alias("total_profit"),
        F.sum("order_count").alias("total_orders"),
        F.avg("avg_deal_size").alias("avg_deal_size"),
    )
    return totals.withColumn("weighted_deal_size", F.try_divide("total_sales", "total_orders"))


def _measures(rows: DataFrame) -> tuple[Column, Column, Column]:
    """Sales, profit and order sums; totals add up alike from staged rows and from the facts."""
    if "order_count" in rows.columns:
        return money_sum(F.col("total_sales")), money_sum(F.col("total_profit")), F.sum("order_count")
    return money_sum(F.col("sales")), money_sum(F.col("profit")), F.count("*")


def _top(rows: DataFrame, key: str, k: int) -> DataFrame:
    sales, profit, _ = _measures(rows)
    return _largest(rows.groupBy(key).agg(sales.alias("sales"), profit.alias("profit")), [key], k)


def _largest(totals: DataFrame, keys: list[str], k: int) -> DataFrame:
    return totals.orderBy(F.desc("sales"), *keys).limit(k)


def top_products(rows: DataFrame, k: int = 5) -> DataFrame:
    return _top(rows, "product", k)


def top_regions(rows: DataFrame, k: int = 5) -> DataFrame:
    return _top(rows, "region", k)


def monthly_trend(rows: DataFrame) -> DataFrame:
    sales, profit, orders = _measures(rows)
    return (
        rows.groupBy(F.trunc("order_date", "MM").alias("month"))
        .agg(sales.alias("sales"), profit.alias("profit"), orders.alias("orders"))
        .orderBy("month")
    )


def segment_regions(rows: DataFrame, k: int = 10) -> DataFrame:
    """Largest segment, region and subregion combinations."""
    sales, _, orders = _measures(rows)
    keys = ["segment", "region", "subregion"]
    return _largest(rows.groupBy(*keys).agg(sales.alias("sales"), orders.alias("orders")), keys, k)


# ---- all of it from one pass over the export

# Keys of each key figure; together they are the grouping sets of one aggregation.
FIGURE_KEYS: dict[str, tuple[str, ...]] = {
    "revenue_totals": (),
    "segment_performance": ("segment",),
    "top_products": ("product",),
    "top_regions": ("region",),
    "monthly_trend": ("month",),
    "segment_by_region": ("segment", "region", "subregion"),
}
ROLLED_KEYS = ("segment", "product", "region", "subregion", "month")


def sales_groups(raw: DataFrame, date_format: str | None = None, flags: dict[str, Column] | None = None) -> DataFrame:
    """Exact sums and counts by the keys of the facts; marts and key figures add up from them.

    ``flags`` are conditions on a row of ``raw``; how many rows meet each is counted beside
    the sums, so a check of the export needs no pass of its own and counts no row twice when
    a task is run again.
    """
    flags = flags or {}
    held = F.struct(*(F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items())) if flags else F.lit(None)
    staged = stage_sales(raw.withColumn("_flags", held), date_format, "_flags")
    return staged.groupBy(*MART_KEYS).agg(
        F.sum(F.col("sales").cast(MONEY)).alias("sales"),
        F.sum(F.col("profit").cast(MONEY)).alias("profit"),
        F.count("*").alias("orders"),
        F.count("sales").alias("sold"),
        *(F.count_if(F.col("_flags")[name]).alias(name) for name in flags),
    )


def group_measures(groups: DataFrame, names: list[str]) -> DataFrame:
    """One row: ``rows`` of the export, and how many of them met each of the flags ``names``."""
    counts = [F.col("orders").alias("rows"), *map(F.col, names)]
    listed = groups.select(*counts)
    return listed.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("rows", *names)))


def _mean() -> Column:
    return F.try_divide(F.col("sales").cast("double"), F.col("sold"))


def facts_of(groups: DataFrame) -> DataFrame:
    """The table of ``revenue_facts``."""
    return groups.select(
        *MART_KEYS,
        F.col("sales").cast("double").alias("total_sales"),
        F.col("profit").cast("double").alias("total_profit"),
        F.col("orders").alias("order_count"),
        _mean().alias("avg_deal_size"),
    )


def roll_ups(groups: DataFrame) -> DataFrame:
    """All key figures in one scan and one shuffle, ``figure`` naming the one a row belongs to."""
    level = F.grouping_id()
    figure = F.lit(None)
    for name, keys in FIGURE_KEYS.items():
        # A bit is set for every key that is summed over, the first key's the highest.
        bits = "".join("0" if key in keys else "1" for key in ROLLED_KEYS)
        figure = F.when(level == int(bits, 2), F.lit(name)).otherwise(figure)
    rows = groups.withColumns({"month": F.trunc("order_date", "MM"), "mean": _mean()})
    sets = [[F.col(key) for key in keys] for keys in FIGURE_KEYS.values()]
    return rows.groupingSets(sets, *ROLLED_KEYS).agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.sum("orders").alias("orders"),
        F.sum("sold").alias("sold"),
        F.avg("mean").alias("mean_of_means"),
        figure.alias("figure"),
    )


def figure_rows(rolled: DataFrame, figure: str) -> DataFrame:
    """The rows of one key figure: its keys, sales, profit, orders and what means are made of."""
    sums = [F.col(name).cast("double").alias(name) for name in ("sales", "profit")]
    return rolled.filter(F.col("figure") == figure).select(*FIGURE_KEYS[figure], *sums, "orders", "sold", "mean_of_means")


def totals_of(rolled: DataFrame) -> DataFrame:
    """``grand_totals`` from the roll-ups; one row, of nulls where there are no sales."""
    only = figure_rows(rolled, "revenue_totals").agg(*(F.max(n).alias(n) for n in ("sales", "profit", "orders", "mean_of_means")))
    return only.select(
        F.col("sales").alias("total_sales"),
        F.col("profit").alias("total_profit"),
        F.col("orders").alias("total_orders"),
        F.col("mean_of_means").alias("avg_deal_size"),
        F.try_divide("sales", "orders").alias("weighted_deal_size"),
    )


def performance_of(rolled: DataFrame) -> DataFrame:
    """``segment_performance`` from the roll-ups."""
    return figure_rows(rolled, "segment_performance").select(
        "segment",
        F.col("orders").alias("total_orders"),
        F.col("sales").alias("total_sales"),
        F.col("profit").alias("total_profit"),
        F.try_divide("sales", "sold").alias("avg_deal_size"),
        safe_ratio(F.col("profit"), F.col("sales")).alias("profit_margin"),
    )


def largest_of(rolled: DataFrame, figure: str, columns: list[str], k: int) -> DataFrame:
    """The ``k`` rows of a key figure with the highest sales."""
    keys = list(FIGURE_KEYS[figure])
    return _largest(figure_rows(rolled, figure).select(*keys, *columns), keys, k)
