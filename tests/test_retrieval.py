import random

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import retrieval
from quarterdeck.plans import jobs

TURN = "deal_id string, turn_text string, ordinal long"
MAIL = "deal_id string, body string, ordinal long"
CHUNK = "chunk_id string, deal_id string, document string, embedding array<float>"


def test_chunks_and_deals(spark, rows):
    turns = spark.createDataFrame([("B", "b0", 4), ("A ", "a1", 9), ("A", "a0", 2)], TURN)
    mails = spark.createDataFrame([("A", None, 5), ("C", "c0", 6)], MAIL)
    assert rows(retrieval.corpus_chunks(turns, mails)) == [
        ("A:email:0", "A", ""),
        ("A:transcript:0", "A", "a0"),
        ("A:transcript:1", "A", "a1"),
        ("B:transcript:0", "B", "b0"),
        ("C:email:0", "C", "c0"),
    ]
    assert [r[0] for r in retrieval.corpus_deals(turns, mails).collect()] == ["A", "B", "C"]


def brute(chunks, queries, k):
    """All distances in memory: (deal, query) -> nearest ids, and the merged order."""
    hits, merged = {}, {}
    for deal in {c[1] for c in chunks}:
        best = {}
        for number, vector in queries:
            near = sorted(
                (sum((x - y) ** 2 for x, y in zip(c[3], vector, strict=True)), c[0]) for c in chunks if c[1] == deal
            )[:k]
            hits[deal, number] = [c for _, c in near]
            for place, (d, c) in enumerate(near):
                met = best.get(c, (None, (number, place)))[1]
                best[c] = (min(d, best[c][0]) if c in best else d, met)
        merged[deal] = [c for c, _ in sorted(best.items(), key=lambda item: item[1])]
    return hits, merged


def test_nearest_against_brute_force(spark):
    rng = random.Random(3)
    chunks = [
        (f"c{i:03d}", "hot" if i % 3 else f"d{i % 5}", f"text {i}", [float(rng.randint(-2, 2)) for _ in range(3)])
        for i in range(150)
    ]
    queries = [(n, [float(rng.randint(-2, 2)) for _ in range(3)]) for n in range(3)]
    stored = spark.createDataFrame(chunks, CHUNK)
    asked = spark.createDataFrame(queries, "query_no int, embedding array<float>")
    hits, merged = brute(chunks, queries, 4)
    each = asked.join(F.broadcast(stored.select("deal_id").distinct()))
    for form in (asked, each):
        near = retrieval.nearest_chunks(stored, form, 4)
        got = {}
        for r in near.orderBy("hit_rank").collect():
            got.setdefault((r["deal_id"], r["query_no"]), []).append(r["chunk_id"])
        assert got == hits
        order = {}
        for r in retrieval.merge_hits(near).orderBy("context_rank").collect():
            order.setdefault(r["deal_id"], []).append(r["chunk_id"])
        assert order == merged


def test_missing_vectors_rank_last(spark, rows):
    chunks = spark.createDataFrame([("a", "D", "x", None), ("b", "D", "y", [1.0, 0.0]), ("c", "D", "z", [0.0, 1.0])], CHUNK)
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_no int, embedding array<float>")
    near = retrieval.nearest_chunks(chunks, asked, 3)
    assert rows(near, "hit_rank", "chunk_id", "distance") == [(1, "b", 0.0), (2, "c", 2.0), (3, "a", None)]
    assert rows(retrieval.nearest_chunks(chunks, asked, 0), "chunk_id") == [("b",)]
    other = spark.createDataFrame([(0, [1.0])], "query_no int, embedding array<float>")
    with pytest.raises(Exception, match="broadcast|length|shape"):
        retrieval.nearest_chunks(chunks.filter("chunk_id <> 'a'"), spark.createDataFrame([(0, [1.0] * 3)], other.schema), 3).collect()


def test_merge_ties_and_blocks(spark, rows):
    hits = spark.createDataFrame(
        [
            ("D", 0, "a", " A ", 0.5, 1),
            ("D", 0, "b", "B", 0.7, 2),
            ("D", 1, "c", "C", 0.5, 1),
            ("D", 1, "b", "B", 0.1, 2),
            ("D", 2, "n", "N", None, 1),
            ("D", 2, "e", "", 0.2, 2),
            ("D", 2, "w", " ", 0.3, 3),
            ("D", 1, "n", "N", 0.9, 3),
        ],
        "deal_id string, query_no int, chunk_id string, document string, distance double, hit_rank int",
    )
    merged = retrieval.merge_hits(hits)
    assert [r["chunk_id"] for r in merged.orderBy("context_rank").collect()] == ["b", "e", "w", "a", "c", "n"]
    assert retrieval.context_blocks(merged).first()["context_block"] == "B\n\n\n\nA\n\nC\n\nN"


def test_encoder_runs_in_batches(spark):
    def build():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([("abc",), (None,)], "t string")
    assert [r["embedding"] for r in retrieval.with_embeddings(df, "t", build).orderBy(F.desc("t")).collect()] == [[3.0, 1.0], [0.0, 1.0]]


def test_default_vectors_are_unit_length(spark):
    df = spark.createDataFrame([("The deal is late, very LATE",), ("the deal, is LATE very late",), ("",)], "t string")
    got = [r["embedding"] for r in retrieval.with_embeddings(df, "t", dimensions=64).collect()]
    assert got[0] == got[1] and sum(x * x for x in got[0]) == pytest.approx(1) and set(got[2]) == {0.0}


def test_upsert(spark, rows):
    base = spark.createDataFrame([("1", "D", "old"), ("2", "D", "kept")], "chunk_id string, deal_id string, document string")
    new = spark.createDataFrame(
        [("1", "D", "first", 1), ("1", "D", "last", 2), ("3", "E", "added", 1)],
        "chunk_id string, deal_id string, document string, ordinal long",
    )
    assert rows(retrieval.upsert_chunks(base, new)) == [("1", "D", "last"), ("2", "D", "kept"), ("3", "E", "added")]
    with pytest.raises(ValueError, match="deal_id"):
        retrieval.upsert_chunks(base, new.drop("deal_id"))


def test_status_and_blank_questions(spark, rows):
    deals = spark.createDataFrame([("D",), (" ",)], "deal_id string")
    status = retrieval.retrieval_status(retrieval.retrieval_outcomes(deals, ["q", "r"]))
    assert rows(status) == [(" ", False, 2), ("D", True, 2)]
    assert not retrieval.retrieval_status(retrieval.retrieval_outcomes(deals, ["q", " "])).filter("retrieval_ok").count()
    with pytest.raises(ValueError, match="query is required"):
        retrieval.query_table(spark, ["ok", " "])


def test_context_of_requested_deals(spark, rows):
    turns = spark.createDataFrame([("D", "budget is late", 0), ("D", "budget", 1), ("E", "x", 0)], TURN)
    built = jobs.index_corpus(turns, spark.createDataFrame([], MAIL))
    asked = retrieval.with_embeddings(retrieval.query_table(spark, ["budget"]), "query")
    wanted = spark.createDataFrame([("D",), ("none",)], "deal_id string")
    assert rows(retrieval.deal_context(wanted, built, asked, 1)) == [("D", "budget", True), ("none", "", True)]
