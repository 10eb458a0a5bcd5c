"""Deal scores as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions.numbers import clamp01
from quarterdeck.params import ActivityRules, HealthRules


def engagement(days_since: Column, count: Column, max_count: Column, rules: ActivityRules) -> Column:
    """Recency fades to 0 at twice the gap; volume is the share of the busiest deal.

    A date in the future lifts recency above 1; only the sum is clamped.
    """
    span = 2.0 * max(rules.gap_days, 1)
    recency = F.greatest(F.lit(0.0), F.lit(1.0) - days_since / F.lit(span))
    volume = F.when(max_count > 0, count / max_count).otherwise(F.lit(0.0))
    return clamp01(F.lit(rules.recency_weight) * recency + F.lit(rules.volume_weight) * volume)


def deal_health(engagement_score: Column, sentiment: Column, gap: Column, rules: HealthRules) -> Column:
    """Sentiment enters on a 0..1 scale; a gap costs the whole recency share."""
    fresh = F.when(gap, F.lit(0.0)).otherwise(F.lit(1.0))
    return clamp01(
        F.lit(rules.engagement) * engagement_score
        + F.lit(rules.sentiment) * ((sentiment + F.lit(1.0)) / F.lit(2.0))
        + F.lit(rules.recency) * fresh
    )


def slip_risk(health: Column) -> Column:
    return clamp01(F.lit(1.0) - health)
