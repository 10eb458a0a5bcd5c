import json

import pytest

from quarterdeck.operators import answers


def table(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


@pytest.mark.parametrize(
    ("text", "growth", "summary", "confidence", "error"),
    [
        (' {"benchmark_growth_pct": 12, "source_summary": "s", "confidence": "high"}\n', 12.0, "s", "high", ""),
        ('So:\n{"benchmark_growth_pct": "9.5",\n "x": {"y": 1}}\nDone', 9.5, "", "low", ""),
        ('{"confidence": "high"}', None, "", "high", "benchmark_growth_pct missing"),
        ('{"benchmark_growth_pct": "many"}', None, "", "low", "benchmark_growth_pct missing"),
        ("[1, 2]", None, "", "low", "benchmark_growth_pct missing"),
        ('{"a": 1} and {"b": 2}', None, "", "low", "no JSON object found"),
        ('{"benchmark_growth_pct": 1}] {', 1.0, "", "low", ""),
        ('{"benchmark_growth_pct": 1}, {"b": 2}', None, "", "low", "no JSON object found"),
        ('{"benchmark_growth_pct": 1} // so', 1.0, "", "low", ""),
        ("", None, "", "low", "no JSON object found"),
        ("none", None, "", "low", "no JSON object found"),
        (None, None, "", "low", "no JSON object found"),
    ],
)
def test_benchmarks(spark, text, growth, summary, confidence, error):
    row = answers.parse_benchmarks(table(spark, text), "t").first()
    assert (row["benchmark_growth_pct"], row["source_summary"], row["confidence"]) == (growth, summary, confidence)
    assert (row["error"], row["ok"]) == (error, not error)


ACTIONS = '"actions": [{"rank": 1}, {"rank": 2}]'


@pytest.mark.parametrize(
    ("text", "error"),
    [
        ("{" + ACTIONS + ', "narrative": "n"}', ""),
        ("Sure\n```json\n{" + ACTIONS + ', "narrative": "n"}\n```\nbye', ""),
        ("```\n{" + ACTIONS + ', "narrative": "n"}\n```', ""),
        ("```\nhere {" + ACTIONS + ', "narrative": "n"} there\n```', ""),
        ("see {" + ACTIONS + ', "narrative": "n"} ok', ""),
        ("{" + ACTIONS + "}", "narrative missing or empty"),
        ("{" + ACTIONS + ', "narrative": "  "}', "narrative missing or empty"),
        ("{" + ACTIONS + ', "narrative": 3}', "narrative missing or empty"),
        ('{"actions": [1], "narrative": "n"}', "expected 2 actions, got 1"),
        ('{"actions": "two", "narrative": "n"}', "expected 2 actions, got 0"),
        ("```json\nnothing\n```", "no JSON object found"),
        (None, "no JSON object found"),
    ],
)
def test_actions(spark, text, error):
    row = answers.parse_actions(table(spark, text), "t", 2).first()
    assert (row["error"], row["ok"]) == (error, not error)
    if not error:
        assert json.loads(row["actions_json"]) == [{"rank": 1}, {"rank": 2}] and row["narrative"] == "n"
    else:
        assert row["actions_json"] is None and row["narrative"] is None


def test_signals(spark):
    parsed = answers.parse_signals(
        table(spark, '{"threat_level": "high", "recent_launches": ["a", 2], "g2_summary": 7}', "{}", "bad"), "t"
    )
    first, empty, bad = parsed.orderBy("id").collect()
    assert (first["threat_level"], first["recent_launches"], first["g2_summary"]) == ("high", ["a", "2"], "7")
    assert (empty["g2_sentiment"], empty["threat_level"], empty["headline"], empty["recent_launches"]) == ("mixed", "medium", "", [])
    assert empty["ok"] and not bad["ok"]
