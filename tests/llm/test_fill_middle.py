"""Fill-in-the-middle against a plain rendering of its definition."""

import hashlib
import random
import re

import numpy as np
import pytest

from quarterdeck.llm import fill_middle

SCHEMA = "doc_id long, text string, n int, output string, first string"


def plain_form(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(p) for p in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


PIECES = ["word", "Étude", " ", "  ", "\n", "4", "½", "😀", "é", "<", ">", "P>", "<S", "a<P", "\x00", "K", "long" * 9]


def texts():
    draw = random.Random(12)
    table = [(None, "no id"), (3, None), (4, ""), (5, "has <M> inside"), (6, "x<P>"), (7, "a"), (7, "a"), (7, "other text")]
    for i in range(250):
        table.append((100 + i, "".join(draw.choice(PIECES) for _ in range(draw.choice([1, 2, 5, 40, 400])))))
    return [*table, (9, "word, " * 300_000), (10, "z" * 200_000)]


def test_output_and_restored_text(spark):
    table = texts()
    df = spark.createDataFrame([(i, t, 1, "clash", "clash") for i, t in table], SCHEMA).repartition(3)
    found = fill_middle.with_restored(fill_middle.fill_in_middle(df)).collect()
    got = sorted((tuple(r)[:6] for r in found), key=repr)
    assert got == sorted((plain_form(*row) for row in table), key=repr)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert sorted(r.restored for r in found) == sorted(t or "" for _, t in table)


def test_rates(spark):
    df = spark.createDataFrame([(i, "some text to cut") for i in range(300)], "doc_id long, text string")
    assert {r.form for r in fill_middle.fill_in_middle(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_middle.fill_in_middle(df, rate=100, suffix_first_rate=100).collect()} == {"spm"}
    assert fill_middle.fill_in_middle(df.limit(0)).collect() == []


@pytest.mark.parametrize("count", [0, 1, 15, 17, 1000, 40_000])
def test_skip_list_reaches_every_rank(count):
    widths = np.random.default_rng(count).integers(1, 30, count)
    units = fill_middle.SkipList(widths)
    before = np.concatenate([[0], np.cumsum(widths)])
    ranks = range(count + 1) if count <= 1000 else [0, 1, count // 3, count - 1, count]
    assert [units.points_before(r) for r in ranks] == [before[r] for r in ranks]
    assert len(units) == count and all(u.sum() == count and p.sum() == before[-1] for u, p, _ in units.lanes)


def test_units_across_slices(monkeypatch):
    text = "".join(random.Random(2).choice(PIECES) for _ in range(500))
    monkeypatch.setattr(fill_middle, "SLICE_CHARS", 7)
    assert fill_middle.unit_widths(text).tolist() == [len(u) for u in re.findall(r"[A-Za-z]+|[^A-Za-z]", text)]
