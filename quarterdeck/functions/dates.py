"""Days out of date texts as exports write them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions.text import strip

# How the day may be written, tried in this order; a weekday before it and
# a time, zone or offset after it are taken off first.
DAY_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "yyyyMMdd",
    "M/d/yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "MMM d yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "d-MMM-yyyy",
)
_WEEKDAY = r"^[A-Za-z]{3,9},\s*"
_TIME = r"[T\s]+\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*([AaPp][Mm])?\s*(Z|[A-Z]{2,4}|[+-]\d{2}:?\d{2})?(\s*\([A-Za-z ]+\))?$"


def written_day(text: Column, formats: Sequence[str] = DAY_FORMATS) -> Column:
    """The day a text names, as it is written and not shifted to another zone; null when none of the formats fits."""
    plain = strip(text.cast("string"))
    day = F.regexp_replace(F.regexp_replace(plain, _WEEKDAY, ""), _TIME, "")
    return F.coalesce(*(F.try_to_timestamp(day, F.lit(form)).cast("date") for form in formats))
