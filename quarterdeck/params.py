"""Job parameters, one frozen object per job part."""

from __future__ import annotations

from dataclasses import dataclass

# Column and segment names of the sales export, its quality limits.
SALES_COLUMN = "Sales"
SEGMENT_COLUMN = "Segment"
SALES_SEGMENTS = ("Enterprise", "SMB", "Strategic")
MIN_ROW_COUNT = 1000
MAX_NULL_RATE = 0.05

# Deal scoring limits and weights.
ACTIVITY_GAP_DAYS = 14
RECENCY_WEIGHT = 0.5
VOLUME_WEIGHT = 0.5
DECLINE_THRESHOLD = -0.3
ENGAGEMENT_SHARE = 0.40
SENTIMENT_SHARE = 0.35
RECENCY_SHARE = 0.25
HANDOFF_TRIGGER = 0.65

# Tone words, matched as substrings of lower-cased text.
POSITIVE_WORDS = (
    "happy",
    "fine",
    "great",
    "aligned",
    "progress",
    "help",
    "excited",
    "genuinely",
)
NEGATIVE_WORDS = (
    "concern",
    "worried",
    "delay",
    "risk",
    "pause",
    "left",
    "up in the air",
    "honestly",
)

# Retrieval depth and the questions asked of every deal.
RETRIEVAL_TOP_K = 5
RETRIEVAL_QUERIES = (
    "Who is involved, what are they trying to achieve, and what are the next steps discussed?",
    "What objections, delays, budget concerns, or technical risks were mentioned?",
    "What was said about timeline, procurement, legal, or the customer's decision process?",
)

# Guardrail lists.
BLOCKED_TOPICS = ("HR", "payroll", "finance", "personal", "general chat")
PII_KINDS = ("email", "phone")

# Segment review settings.
GROWTH_SEGMENTS = ("Enterprise", "Mid-Market", "SMB")
BOOKING_QUARTERS = ("2025-Q1", "2025-Q2", "2025-Q3", "2025-Q4")
OPPORTUNITY_COLUMNS = ("opportunity_id", "account_name", "segment", "arr", "stage", "win_loss_reason")
BOOKING_COLUMNS = (
    "opportunity_id",
    "segment",
    "quarter",
    "booked_arr",
    "benchmark_growth_pct",
    "actual_growth_pct",
)
GAP_THRESHOLD_PP = 5.0
TOP_COMPETITORS = 3
SEARCH_YEAR = 2026
SEARCH_MAX_RESULTS = 8
SEARCH_DAYS_BACK = 180
ACTION_COUNT = 3
NARRATIVE_MINUTES = 5
BENCHMARK_SOURCES = (
    "SEC filings",
    "Earnings call transcripts",
    "Industry analyst reports",
)


@dataclass(frozen=True)
class QualityRules:
    sales_column: str = SALES_COLUMN
    segment_column: str = SEGMENT_COLUMN
    allowed_segments: tuple[str, ...] = SALES_SEGMENTS
    min_rows: int = MIN_ROW_COUNT
    max_null_rate: float = MAX_NULL_RATE


@dataclass(frozen=True)
class ActivityRules:
    gap_days: int = ACTIVITY_GAP_DAYS
    recency_weight: float = RECENCY_WEIGHT
    volume_weight: float = VOLUME_WEIGHT


@dataclass(frozen=True)
class ToneRules:
    positive: tuple[str, ...] = POSITIVE_WORDS
    negative: tuple[str, ...] = NEGATIVE_WORDS
    decline_threshold: float = DECLINE_THRESHOLD


@dataclass(frozen=True)
class HealthRules:
    engagement: float = ENGAGEMENT_SHARE
    sentiment: float = SENTIMENT_SHARE
    recency: float = RECENCY_SHARE
    handoff_trigger: float = HANDOFF_TRIGGER


@dataclass(frozen=True)
class RetrievalRules:
    top_k: int = RETRIEVAL_TOP_K
    queries: tuple[str, ...] = RETRIEVAL_QUERIES


@dataclass(frozen=True)
class ArrBound:
    """Allowed yearly value of one segment; ``None`` leaves that side open."""

    segment: str
    minimum: float | None = None
    maximum: float | None = None
    maximum_allowed: bool = True


# Yearly value ranges by segment.
ARR_BOUNDS = (
    ArrBound("Enterprise", minimum=200_000),
    ArrBound("Mid-Market", minimum=50_000, maximum=200_000),
    ArrBound("SMB", maximum=50_000, maximum_allowed=False),
)


@dataclass(frozen=True)
class ReviewRules:
    segments: tuple[str, ...] = GROWTH_SEGMENTS
    quarters: tuple[str, ...] = BOOKING_QUARTERS
    gap_threshold_pp: float = GAP_THRESHOLD_PP
    top_competitors: int = TOP_COMPETITORS
    search_year: int = SEARCH_YEAR
    max_results: int = SEARCH_MAX_RESULTS
    days_back: int = SEARCH_DAYS_BACK
    action_count: int = ACTION_COUNT
    narrative_minutes: int = NARRATIVE_MINUTES
    benchmark_sources: tuple[str, ...] = BENCHMARK_SOURCES
    arr_bounds: tuple[ArrBound, ...] = ARR_BOUNDS
    opportunity_columns: tuple[str, ...] = OPPORTUNITY_COLUMNS
    booking_columns: tuple[str, ...] = BOOKING_COLUMNS
