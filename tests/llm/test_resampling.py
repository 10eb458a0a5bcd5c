"""Importance resampling against a plain rendering of its definition."""

import hashlib
import math
import random
import re
import zlib

import pytest

from quarterdeck.llm import resampling

SCHEMA = "doc_id long, text string, weight string, row int, bucket int"


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_features(text, longest):
    words = plain_words(text)
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return [zlib.crc32(run.encode()) % 10_000 for run in runs]


def plain_result(docs, targets, longest=1, percent=10):
    s, t = [0] * 10_000, [0] * 10_000
    for counts, texts in ((s, [d[1] for d in docs]), (t, targets)):
        for text in texts:
            for b in plain_features(text, longest):
                counts[b] += 1
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for doc_id, text in docs:
        found = plain_features(text, longest)
        key = f"2024:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, len(plain_words(text)) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = {id(r): place for place, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*r[:4], drawn.get(id(r))) for r in rows), key=repr)


def documents():
    draw = random.Random(13)
    words = ["The", "of", "Naïve", "x1", "don't", "日本 語", "A-B", "zebra", "Q_q", "\x7f", "é"]
    docs = [(i, " ".join(draw.choice(words) for _ in range(draw.randint(0, 60)))) for i in range(300)]
    same = "equal text of many words " * 6
    docs += [(1000, None), (1001, ""), (1002, " \t!"), (None, same), (None, None), (1003, same), (1003, same), (1003, "zebra " * 30)]
    return [*docs, (1004, "Very long, " * 100_000)]


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (3, 55), (2, 100)])
def test_result_equals_definition(spark, rows, longest, percent):
    docs = documents()
    targets = ["zebra of the naïve x1", "A b", None, "zebra zebra"]
    df = spark.createDataFrame([(*d, "clash", 1, 1) for d in docs], SCHEMA).repartition(4)
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    found = resampling.importance_resample(df, target, longest=longest, percent=percent)
    assert rows(found) == plain_result(docs, targets, longest, percent)


def test_ties_by_id(spark, monkeypatch):
    """Equal scores: with one constant noise the smaller ids are drawn, rows without an id last."""
    monkeypatch.setattr(resampling, "seeded", lambda *_: resampling.F.lit(7))
    ids = [None, *range(59, 0, -1)]
    df = spark.createDataFrame([(i, "same words " * 20) for i in ids], "doc_id long, text string").repartition(5)
    found = resampling.importance_resample(df, df.limit(1), percent=50)
    assert {r.doc_id: r.rank for r in found.collect()} == {None: None} | {i: i if i <= 30 else None for i in range(1, 60)}


def test_empty_tables(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    docs = documents()[:30]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert resampling.importance_resample(empty, df).collect() == []
    assert rows(resampling.importance_resample(df, empty)) == plain_result(docs, [])
