import math
import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import report
from quarterdeck.functions.text import strip
from quarterdeck.operators import guardrails


def one(spark, text):
    return spark.createDataFrame([(text,)], "text string")


@pytest.mark.parametrize(
    ("text", "clean", "types"),
    [
        ("write to ann@example.com now", "write to [REDACTED_EMAIL] now", ["email"]),
        ("call +1 555-123-4567 today", "call +[REDACTED_PHONE] today", ["phone"]),
        ("555.123.4567", "[REDACTED_PHONE]", ["phone"]),
        ("order 5551234567 and DEAL-1000", "order 5551234567 and DEAL-1000", []),
        ("(555) 123-4567", "(555) 123-4567", []),
        ("tel(555) 123-4567", "tel[REDACTED_PHONE]", ["phone"]),
        ("a@b.co, 555 123 4567", "[REDACTED_EMAIL], [REDACTED_PHONE]", ["email", "phone"]),
        # Word edges are Unicode-wide: no edge between a letter with an accent and a digit.
        ("é555-123-4567", "é555-123-4567", []),
        ("éann@example.com", "éann@example.com", []),
        ("", "", []),
        (None, "", []),
    ],
)
def test_redaction(spark, text, clean, types):
    row = guardrails.redact_pii(one(spark, text), "text").first()
    assert (row["sanitized_text"], row["pii_types"], row["redacted"]) == (clean, types, bool(types))


def test_redaction_kinds_and_repeat(spark):
    text = one(spark, "a@b.co 555 123 4567")
    only = guardrails.redact_pii(text, "text", ["phone", "contact_name"]).first()
    assert only["sanitized_text"] == "a@b.co [REDACTED_PHONE]"
    once = guardrails.redact_pii(text, "text").select(F.col("sanitized_text").alias("text"))
    again = guardrails.redact_pii(once, "text").first()
    assert again["sanitized_text"] == "[REDACTED_EMAIL] [REDACTED_PHONE]" and not again["redacted"]


@pytest.mark.parametrize(
    ("text", "topic"),
    [("three deals", "HR"), ("Payroll and finance", "payroll"), ("deal health", None), ("", None), (None, None)],
)
def test_topics(spark, text, topic):
    row = guardrails.screen_topics(one(spark, text), "text").first()
    assert row["matched_topic"] == topic and row["allowed"] == (topic is None)


def test_strip_takes_all_white_space(spark):
    text = "　\t x y \x1f\n "
    assert one(spark, text).select(strip(F.col("text"))).first()[0] == text.strip() == "x y"


def test_two_decimals_are_those_of_the_binary_value(spark):
    draw = random.Random(5)
    values = [0.175, 0.125, 0.375, 2.675, 1.005, 0.0, -0.0, -0.001, 0.995, 1e-30, 123456.785, 1e15, float("inf"), float("-inf"), float("nan")]
    values += [k / 1000 for k in range(0, 20_000, 5)]
    values += [math.nextafter(k / 1000, k % 3 - 1) for k in range(5, 20_000, 10)]
    values += [draw.uniform(-2, 2) for _ in range(40_000)]
    values += [draw.randrange(10**14) / 1000 for _ in range(20_000)]
    values += [-draw.randrange(2**40) / 2 ** draw.randrange(40) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").select("v", report.two_decimals("v").alias("t"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    wrong = [(v, t) for v, t in df.collect() if t != ("nan" if v is None else f"{v:.2f}")]
    assert not wrong, wrong[:5]
