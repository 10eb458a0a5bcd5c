"""Competitors named in lost opportunities, and what a search says about them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import report
from quarterdeck.functions.numbers import money_sum
from quarterdeck.functions.text import strip
from quarterdeck.operators.contracts import ContractError
from quarterdeck.operators.growth import CLOSED_LOST
from quarterdeck.operators.ordering import head_per_group

# Fixed value: how a loss names its competitor and theme; the name is the shortest fit.
LOSS_PATTERN = r"^Lost to (.+?) on (.+)$"


def competitor_losses(opportunities: DataFrame) -> DataFrame:
    """Lost opportunities with competitor and theme; losses that name nobody are left out."""
    reason = strip(F.col("win_loss_reason"))
    lost = opportunities.filter(F.col("stage") == CLOSED_LOST).withColumn("_reason", reason)
    named = lost.filter(F.rlike("_reason", F.lit(LOSS_PATTERN)))
    return (
        named.withColumn("name", strip(F.regexp_extract("_reason", LOSS_PATTERN, 1)))
        .withColumn("theme", strip(F.regexp_extract("_reason", LOSS_PATTERN, 2)))
        .drop("_reason")
    )


def competitor_stats(losses: DataFrame) -> DataFrame:
    """Losses, lost value and themes by competitor.

    Rows shrink to competitor and theme before the shuffle, so a competitor named
    in every loss costs no more than its themes.
    """
    by_theme = losses.groupBy("name", "theme").agg(
        F.count("*").alias("loss_count"), money_sum(F.col("arr")).alias("lost_arr")
    )
    return by_theme.groupBy("name").agg(
        F.sum("loss_count").alias("loss_count"),
        money_sum(F.col("lost_arr")).alias("lost_arr"),
        F.sort_array(F.collect_list("theme")).alias("loss_themes"),
    )


def rank_competitors(stats: DataFrame, top: int) -> DataFrame:
    """The ``top`` competitors by unrounded value, then losses, then name, with ``competitor_rank``."""
    first = stats.orderBy(F.desc("lost_arr"), F.desc("loss_count"), "name").limit(top)
    # At most ``top`` rows are left, so one ordered list of them gives the ranks.
    entry = F.struct((-F.col("lost_arr")).alias("v"), (-F.col("loss_count")).alias("c"), "name", "loss_themes")
    listed = first.agg(F.sort_array(F.collect_list(entry)).alias("listed"))
    return listed.select(F.posexplode("listed").alias("place", "item")).select(
        (F.col("place") + 1).alias("competitor_rank"),
        F.col("item.name").alias("name"),
        (-F.col("item.c")).alias("loss_count"),
        F.round(-F.col("item.v"), 2).alias("lost_arr"),
        F.col("item.loss_themes").alias("loss_themes"),
    )


def search_queries(competitors: DataFrame) -> DataFrame:
    return competitors.select("name", report.fill(report.COMPETITOR_QUERY, {"name": F.col("name")}).alias("query"))


def search_snippets(hits: DataFrame, as_of: dt.date | Column, days_back: int, max_results: int) -> DataFrame:
    """The first ``max_results`` recent hits of each query, shaped for a prompt.

    ``hits`` has (query, ordinal, title, url, published, highlights, text); the
    snippet is the highlights joined by blanks, or the text without any.
    """
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    recent = hits.filter(F.col("published") >= F.date_sub(today, days_back))
    shaped = recent.select(
        "query",
        "ordinal",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.when(F.size("highlights") > 0, F.array_join("highlights", " "))
        .otherwise(F.coalesce("text", F.lit("")))
        .alias("snippet"),
    )
    return head_per_group(shaped, ["query"], ["ordinal"], max_results)


def snippet_blobs(snippets: DataFrame) -> DataFrame:
    """One text per query of its few snippets, and their non-empty addresses."""
    block = report.fill_lines(report.SNIPPET_BLOCK, {c: F.col(c) for c in ("title", "url", "snippet")})
    ordered = F.sort_array(F.collect_list(F.struct("ordinal", block.alias("block"), "url")))
    listed = snippets.groupBy("query").agg(ordered.alias("_hits"))
    return listed.select(
        "query",
        F.array_join("_hits.block", "\n\n").alias("blob"),
        F.filter("_hits.url", lambda u: u != "").alias("sources"),
    )


def competitor_signals(ranked: DataFrame, signals: DataFrame) -> DataFrame:
    """Ranked competitors with their parsed signals by name."""
    return ranked.join(signals, "name", "left")


def require_competitors(ranked: DataFrame) -> DataFrame:
    """Stops a run whose losses name no competitor."""
    if ranked.isEmpty():
        raise ContractError("no competitor named in lost opportunities")
    return ranked


def threat_summary(competitors: DataFrame) -> DataFrame:
    """One row: ranked names, the headline on the first, and the watch list (the same names).

    ``competitors`` holds the top few only; without any there is no row.  Without
    signals the headline names the first.
    """
    told = F.col("headline") if "headline" in competitors.columns else F.lit(None).cast("string")
    first = F.min_by(F.struct("name", told.alias("headline")), "competitor_rank")
    names = F.sort_array(F.collect_list(F.struct("competitor_rank", "name")))["name"]
    summary = competitors.agg(first.alias("_first"), names.alias("top_threats"))
    headline = F.coalesce(
        F.nullif(F.col("_first.headline"), F.lit("")), F.concat(F.lit("Top threat: "), F.col("_first.name"))
    )
    found = summary.filter(F.size("top_threats") > 0)
    return found.select("top_threats", headline.alias("headline"), F.col("top_threats").alias("recommended_watchlist"))

