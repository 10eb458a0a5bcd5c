"""MinHash near-duplicates against all pairs of full sets."""

import random

import numpy as np
import pytest

from quarterdeck.llm import minhash

SCHEMA = "doc_id long, text string, node int, key string"


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if len(words) < 4:
        return frozenset([" ".join(words)] if words else [])
    return frozenset(" ".join(words[i : i + 4]) for i in range(len(words) - 3))


def plain_result(rows):
    """(id, set size, component, kept) of every row, by comparing all rows."""
    sets = [plain_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and None not in (rows[i][0], rows[j][0]) and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(row[0], least.get(find(i), row[0]))
    out = []
    for i, row in enumerate(rows):
        component = None if row[0] is None else least[find(i)]
        out.append((row[0], len(sets[i]), component, row[0] is None or row[0] == component))
    return sorted(out, key=repr)


def chains():
    """Texts that drift apart word by word, so that links chain; sizes from one shingle up."""
    draw = random.Random(11)
    rows = []
    for base in range(25):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([4, 8, 9, 30, 60, 300]))]
        for _ in range(draw.randint(1, 9)):
            rows.append((10_000 - len(rows) * 3, " ".join(words), base, "k"))
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(4000)}"
            if draw.random() < 0.3:
                words.append("more")
    return rows


def test_result_equals_all_pairs(spark, rows):
    table = chains()
    table += [(5, table[0][1], 1, "again"), (5, table[40][1], 1, "same id, other text"), (7, table[0][1], 0, None)]
    table += [(7, table[0][1], 0, None), (None, table[0][1], 0, None), (20, None, 0, None), (21, "", 0, None), (22, " \n", 0, None)]
    table += [(30, "One two", 0, None), (31, "ONE\ttwo", 0, None), (32, "one two three", 0, None), (33, "É é\xa0x", 0, None)]
    df = spark.createDataFrame(table, SCHEMA).repartition(4)
    assert rows(minhash.near_duplicates(df)) == plain_result(table)


@pytest.mark.parametrize("block", [4, 1024])
def test_one_key_for_all(spark, rows, monkeypatch, block):
    """A large group of near copies and many texts that share half of it: few blocks or many give the same."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(minhash, "BLOCK_NODES", block)
    draw = random.Random(3)
    core = [f"c{i}" for i in range(80)]
    table = []
    for i in range(120):
        words = list(core)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(80)] = f"n{draw.randrange(9)}"
        if i % 3 == 0:
            words[draw.randint(30, 55) :] = [f"own{i}_{j}" for j in range(30)]
        table.append((1000 - i, " ".join(words), 0, ""))
    df = spark.createDataFrame(table, SCHEMA).repartition(3)
    assert rows(minhash.near_duplicates(df)) == plain_result(table)


def test_pigeonhole_loses_no_pair():
    """Two signatures that differ in at most 23 positions share a key, wherever they differ."""
    draw = np.random.default_rng(1)
    for _ in range(300):
        one = draw.integers(0, 1 << 16, minhash.POSITIONS).astype("<u2")
        other = one.copy()
        places = draw.permutation(minhash.POSITIONS)[: minhash.MAX_DIFFER]
        other[places] ^= 1
        keys = minhash.chunk_keys(np.stack([one, other]))
        assert set(keys[0].tolist()) & set(keys[1].tolist())
        assert len(set(keys[0].tolist())) == minhash.POSITIONS
    # Two errors in every chunk are the first that can hide a pair.
    other = one.copy()
    other.reshape(-1, minhash.CHUNK)[:, :2] ^= 1
    keys = minhash.chunk_keys(np.stack([one, other]))
    assert not set(keys[0].tolist()) & set(keys[1].tolist())


def test_signatures_estimate_similarity():
    draw = random.Random(5)
    for _ in range(20):
        both = [draw.getrandbits(64) for _ in range(800)]
        sets = [np.unique(np.array(both + [draw.getrandbits(64) for _ in range(100)], np.uint64)) for _ in range(2)]
        differ = int((minhash.signature(sets[0]) != minhash.signature(sets[1])).sum())
        assert differ <= minhash.MAX_DIFFER
    long_text = " ".join(f"w{i}" for i in range(60_000))
    assert len(minhash.shingle_set(long_text)) == 59_997


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
