"""Exact and line-wise de-duplication against plain Python."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from quarterdeck.llm import exact, lines

SCHEMA = "doc_id long, text string, kept string, size int"


def texts(draw, count):
    rows = [(i, draw.choice(["same length!", "same lengtH!", "x" * 300 + "a", "x" * 300 + "b", None, "", "other"]), "k", 1) for i in range(count)]
    return [*rows, (3, "other", "k", 2), (3, "other", "k", 2), (None, "other", None, None), (count + 5, "only here", "k", 3)]


def test_exact(spark):
    rows = texts(random.Random(1), 60)
    found = exact.exact_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    digests = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(found) == len(rows)
    kept = defaultdict(int)
    for row in found:
        members = groups[digests[row.text_sha256]]
        largest = max((m for m in members if m is not None), default=None)
        assert (row.keep_id, row.group_size) == (largest, len(members))
        assert not row.kept or row.doc_id == largest
        kept[row.text_sha256] += row.kept
    assert set(kept.values()) == {1} and set(kept) == set(digests)


def test_exact_rows_stay_whole(spark):
    rows = texts(random.Random(2), 40)
    left = exact.drop_exact_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert left.columns == ["doc_id", "text", "kept", "size"]
    found = left.collect()
    assert len(found) == len({t or "" for _, t, *_ in rows})
    largest = {}
    for doc_id, text, *_ in rows:
        largest[text or ""] = max(largest.get(text or "", -1), -1 if doc_id is None else doc_id)
    assert {r.text or "": r.doc_id for r in found} == largest


def test_exact_keeps_columns_of_any_name(spark):
    named = "doc_id long, text string, digest string, stay_id long, stay_digest string, Size int"
    rows = [(1, "a", "d", 9, "s", 3), (2, "a", "e", 8, "t", 3), (3, None, "f", 7, "u", 3)]
    left = exact.drop_exact_duplicates(spark.createDataFrame(rows, named))
    assert sorted(tuple(r) for r in left.collect()) == rows[1:]


def test_exact_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.exact_duplicates(empty).count() == 0 and exact.drop_exact_duplicates(empty).count() == 0


# ---- lines


def test_a_long_text_of_repeated_chunks(spark):
    """Umlauts and characters beyond 16 bits keep their places; the whole passage goes."""
    block = "".join(f"zeile {i} mit ü und 😀\n" for i in range(20_000))
    rows = [(1, block), (2, "davor\n" + block + "danach"), (3, None)]
    found = {r.doc_id: r for r in lines.remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].clean_text == block and found[1].removed_chunks == 0
    assert found[2].clean_text == "davor\ndanach" and found[2].removed_lines == 20_000
    assert [tuple(s) for s in found[2].removed_spans] == [(6, 6 + len(block))]
    assert found[3].clean_text == "" and found[3].removed_lines == 0


def test_rolling_depends_on_the_last_lines_only():
    draw = np.random.default_rng(3)
    a, b = draw.integers(0, 2**63, 50, np.uint64), draw.integers(0, 2**63, 30, np.uint64)
    tail = draw.integers(0, 2**63, 20, np.uint64)
    left, right = lines.rolling(np.append(a, tail), 4), lines.rolling(np.append(b, tail), 4)
    assert (left[-17:] == right[-17:]).all() and left[-18] != right[-18]


def chunks(text, mean=lines.CHUNK_PAIRS):
    """(first line, last line) of every chunk."""
    pairs = lines.rolling(lines.line_hashes(text), lines.PAIR_LINES)[lines.PAIR_LINES - 1 :]
    bounds = lines.boundaries(pairs, mean).tolist()
    return list(zip(bounds, bounds[1:]))


def test_every_pair_is_in_one_chunk_and_cuts_resist_shifts():
    draw = random.Random(5)
    passage = [f"line {draw.random()}" for _ in range(40)]
    one = "\n".join(passage)
    two = "\n".join([*(f"other {draw.random()}" for _ in range(7)), *passage])
    for text in (one, two, "", "\n", "a\n\n\nb", "no end"):
        pairs = [i for first, last in chunks(text) for i in range(first, last)]
        assert pairs == list(range(len(lines.line_spans(text)) - 1))
    shifted = {(first - 7, last - 7) for first, last in chunks(two)}
    assert len(chunks(one)) > 5 and len(set(chunks(one)) - shifted) <= 1


def test_most_of_a_passage_goes_by_whole_chunks():
    """The share of a shared passage's pairs of lines that whole chunks hold, by its length."""
    draw, share = random.Random(8), {}
    for length in (5, 10, 20, 60):
        held = 0
        for k in range(200):
            text = "\n".join([*(f"own {k} {draw.random()}" for _ in range(5)), *(f"{k} {length} {i}" for i in range(length)), *(f"end {k} {draw.random()}" for _ in range(5))])
            held += sum(last - first for first, last in chunks(text) if first >= 5 and last < 5 + length)
        share[length] = held / 200 / (length - 1)
    assert share[60] > 0.9 and share[20] > 0.7 and share[5] < share[10] < share[20]


@pytest.fixture
def passages():
    draw = random.Random(6)
    shared = ["\n".join(f"shared {k} {i} é" for i in range(12)) for k in range(4)]
    rows = []
    for i in range(40):
        own = [f"own {i} {j} {draw.random()}" for j in range(draw.randint(0, 9))]
        rows.append((i, "\n".join([*own, draw.choice(shared), *own[:2], "end"]), "c", 1))
    return [*rows, (100, None, "c", 1), (101, "", "c", 1), (None, shared[0], "c", 1), (5, rows[5][1], "c", 1)]


def test_line_removal(spark, passages):
    """Columns of clashing names do no harm, and whatever chunks are cut, the same lines go."""
    schema = "doc_id long, text string, clean_text string, row int"
    docs = spark.createDataFrame(passages, schema).repartition(3)
    results = []
    for mean in (1, 3, 1 << 40):
        found = lines.remove_repeated_passages(docs, mean=mean).collect()
        results.append(sorted((repr(r.doc_id), r.clean_text, r.removed_lines) for r in found))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(passages)
    assert sum(n for _, _, n in results[0]) > 30 * 12


def test_lines_of_nothing(spark):
    assert lines.remove_repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0
