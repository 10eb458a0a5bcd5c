"""Text columns: trimming, counting, redaction, topic match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode calls white space, plus the four ASCII separators.
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# What counts as an e-mail address and as a phone number, and the marks put in their place.
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE_PATTERN = r"\b(?:\+?1[\s.-]?)?(?:\(\d{3}\)|\d{3})[\s.-]\d{3}[\s.-]\d{4}\b"
EMAIL_MARK = "[REDACTED_EMAIL]"
PHONE_MARK = "[REDACTED_PHONE]"

# Java's classes are ASCII unless this flag is set; the patterns are meant Unicode-wide.
_UNICODE = "(?U)"


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.trim(text, F.lit(WHITESPACE))


def redact_email(text: Column) -> Column:
    """Texts without an at sign skip the pattern."""
    masked = F.regexp_replace(text, _UNICODE + EMAIL_PATTERN, EMAIL_MARK)
    return F.when(F.contains(text, F.lit("@")), masked).otherwise(text)


def redact_phone(text: Column) -> Column:
    return F.regexp_replace(text, _UNICODE + PHONE_PATTERN, PHONE_MARK)


def first_topic(lowered: Column, topics: Sequence[str]) -> Column:
    """First topic of the list found in the lower-cased text, as written in the list."""
    hits = [
        F.when(F.contains(lowered, F.lit(topic.lower().strip())), F.lit(topic))
        for topic in topics
        if topic.strip()
    ]
    return F.coalesce(*hits) if hits else F.lit(None).cast("string")
