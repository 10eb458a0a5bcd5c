"""SimHash near-duplicates against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from quarterdeck.llm import simhash

SCHEMA = "doc_id long, text string, fingerprint string, node int"


def plain_fingerprint(text):
    """Bit by bit, as the definition has it."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, word = [], ""
    for char in lowered + " ":
        if char in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += char
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, reach):
    """(id -> smallest id reached) by comparing every pair."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for place, a in enumerate(ids):
        for b in ids[place + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= reach:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", "  \n", "One", "one TWO", "One two  three", "a b\tc d\x0be", "É é a\xa0b c", "x " * 20_000, "\x1cq r s t"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def clustered(draw, count, centers, spread):
    bases = [draw.getrandbits(64) for _ in range(centers)]
    points = set()
    while len(points) < count:
        point = draw.choice(bases)
        for _ in range(draw.randint(0, spread)):
            point ^= 1 << draw.randrange(64)
        points.add(point)
    return np.array(sorted(points), np.uint64)


@pytest.mark.parametrize(("centers", "spread"), [(1500, 1), (40, 4), (1, 6)])
def test_shards_lose_no_link(monkeypatch, centers, spread):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 16)
    points = clustered(random.Random(centers), 1200, centers, spread)
    wanted = plain_components({i: int(p) for i, p in enumerate(points)}, 2)
    roots = simhash.Roots(len(points))
    simhash.link_shard(points, 2, roots)
    assert {i: roots.find(i) for i in range(len(points))} == wanted
    tree, leaves = simhash.build_tree(points[::4], 12, 2)
    across = simhash.Roots(len(points))
    seen = set()
    for leaf, places in simhash.route(tree, points, 2):
        seen |= set(places.tolist())
        local = simhash.Roots(len(places))
        simhash.link_shard(points[places], 2, local)
        for i in range(len(places)):
            across.join(int(places[i]), int(places[local.find(i)]))
        assert leaf < leaves
    assert seen == set(range(len(points)))
    assert {i: across.find(i) for i in range(len(points))} == wanted


def rows_of_texts():
    draw = random.Random(4)
    rows = []
    for i in range(60):
        words = [f"w{draw.randrange(500)}" for _ in range(300)]
        for copy in range(draw.randint(1, 3)):
            changed = list(words)
            if copy:
                changed[draw.randrange(300)] = "changed"
            rows.append((1000 - 3 * i - copy, " ".join(changed), "x", 1))
    return [*rows, (5000, None, None, None), (2, "", "y", 2), (5001, " \n", "y", 2), (7, rows[0][1], "z", 1), (7, rows[0][1], "z", 1)]


@pytest.mark.parametrize("shard_rows", [20, 4096])
def test_near_duplicates(spark, shard_rows):
    rows = rows_of_texts()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = simhash.near_duplicates(df, shard_rows=shard_rows).collect()
    prints = {r[0]: plain_fingerprint(r[1] or "") for r in rows}
    wanted = plain_components(prints, 2)
    assert len(found) == len(rows)
    for row in found:
        assert int(row.fingerprint, 16) == prints[row.doc_id] and len(row.fingerprint) == 16
        assert row.component_id == wanted[row.doc_id]
    kept = [r.doc_id for r in simhash.keep_one_of_each(df, shard_rows=shard_rows).collect()]
    assert sorted(kept) == sorted(set(wanted.values()))


def test_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(300, b) for b in range(301, 420)]
    links = spark.createDataFrame([(b, a) for a, b in chain + star], "node long, root long")
    found = {r.node: r.root for r in simhash.components(links).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {i: 300 for i in range(301, 420)}


def test_rows_that_share_an_id(spark):
    near = "alpha beta gamma delta " * 30
    rows = [(1, "sole text with nothing in common", "", 0), (1, "completely other words here", "", 0), (1, near, "", 0)]
    rows += [(0, "completely other words here", "", 0), (7, near, "", 1), (7, "sole text with nothing in common", "", 2), (7, near, "", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(df).collect()}
    mark = lambda text: f"{plain_fingerprint(text):016x}"
    assert found[1, mark(rows[0][1])] == 1 == found[7, mark(rows[0][1])] and found[1, mark(rows[1][1])] == 0
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(df).collect())
    assert kept == sorted([(1, rows[0][1]), (0, rows[1][1]), (1, near)])


def test_edge_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one_of_each(empty).count() == 0
    unnamed = spark.createDataFrame([(None, "a b c d", "x", 1), (1, "a b c d", "x", 1)], SCHEMA)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(unnamed).collect()}
    assert found == {None: None, 1: 1}
    assert simhash.keep_one_of_each(unnamed).count() == 2
