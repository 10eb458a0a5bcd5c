"""JSON answers of a language model, read from text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions.text import strip

# Where JSON is looked for when the text is not JSON as a whole.
OBJECT_PATTERN = r"(?s)\{.*\}"
FENCE_PATTERN = r"(?s)```(?:json)?\s*(.*?)\s*```"


# Spark's parser stops after the first value and ignores what follows.  Inside a
# list that ends with this mark, a text with anything after its value is refused.
_END = "\x1e end"


def whole_json(text: Column) -> Column:
    """The text as one JSON value; null when it is anything else."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"\\u001e end"]')))
    alone = F.try_variant_get(listed, "$[1]", "string") == F.lit(_END)
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def _braced(text: Column) -> Column:
    return whole_json(F.regexp_extract(text, OBJECT_PATTERN, 0))


def answer_json(text: Column) -> Column:
    """The text as JSON, else its widest braced part; null when neither parses."""
    cleaned = strip(text)
    return F.coalesce(whole_json(cleaned), _braced(cleaned))


def fenced_json(text: Column) -> Column:
    """As ``answer_json``, but a code fence is opened before braces are looked for."""
    cleaned = strip(text)
    inside = strip(F.regexp_extract(cleaned, FENCE_PATTERN, 1))
    has_fence = F.rlike(cleaned, F.lit(FENCE_PATTERN))
    return F.coalesce(
        whole_json(cleaned),
        F.when(has_fence, whole_json(inside)),
        _braced(F.when(has_fence, inside).otherwise(cleaned)),
    )


def object_only(payload: Column) -> Column:
    """The payload when it is a JSON object, else null: a number, a text or a list answers nothing."""
    return F.when(F.startswith(F.schema_of_variant(payload), F.lit("OBJECT")), payload)


def text_field(payload: Column, name: str, default: str) -> Column:
    """A field as text, the default when missing or null."""
    return F.coalesce(F.try_variant_get(payload, f"$.{name}", "string"), F.lit(default))
