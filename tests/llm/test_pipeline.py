"""The pipeline's stages against their operators run one by one on plain rows."""

import pathlib
import sys

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[2])]

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from quarterdeck.llm import language, quality, simhash  # noqa: E402
from quarterdeck.llm.shared import scratch  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SMALL = "/root/testdata/sf0.001"


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "exact_dedup", "simhash_near_dedup", "packing"]
    registered = entry.queries()
    assert "pipeline" in registered
    numbers = [int(n[2:].split("_")[0]) for n in registered if n.startswith("op") and n[2].isdigit()]
    assert sorted(numbers) == list(range(1, 14))


def test_every_stage_against_brute_force(spark):
    """Each stage's rows from the rows of the one before, by plain Python where the decision is a rule."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder = scratch(spark, "test-pipeline")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.toPandas().to_dict("records")}
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        out = spark.read.parquet(f"{folder}/{name}")
        rows = out.toPandas().to_dict("records")
        if name != "packing":
            assert out.columns == COLUMNS
            assert all(before[r["doc_id"]] == r for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
        found = {r["doc_id"] for r in rows}
        if name == "language_id":
            scorer = language.Scorer(language.learn(docs))
            told = {i: scorer.predict(r["text"]) for i, r in before.items()}
            assert found == {i for i, (lang, score) in told.items() if lang != "und" and score >= 0.5}
        elif name == "quality":
            model = quality.learn(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
            texts = quality.text_features([r["text"] for r in before.values()])
            meta = quality.meta_features(*([r[c] for r in before.values()] for c in ("source", "lang", "n_chars")))
            assert found == {i for i, s in zip(before, model.score(texts, meta)) if s >= 0.5}
        elif name == "exact_dedup":
            largest = {}
            for i, r in before.items():
                largest[r["text"]] = max(i, largest.get(r["text"], i))
            assert found == set(largest.values())
        elif name == "simhash_near_dedup":
            prints = {i: simhash.fingerprint(r["text"]) for i, r in before.items()}
            reach = {i: i for i in sorted(prints)}
            changed = True
            while changed:
                changed = False
                for a in prints:
                    for b in prints:
                        if reach[b] < reach[a] and (prints[a] ^ prints[b]).bit_count() <= 2:
                            reach[a], changed = reach[b], True
            assert found == {i for i in prints if reach[i] == i}
        else:
            assert found == set(before)
            spans = {}
            for r in rows:
                spans.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
            for pieces in spans.values():
                pieces.sort()
                assert pieces[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
                assert pieces[-1][0] + pieces[-1][1] == pieces[0][2]
        kept[name] = len(found)
        docs = out
    assert kept["packing"] == kept["simhash_near_dedup"] > 0


def test_odd_rows_and_extra_columns(spark):
    folder = scratch(spark, "test-pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, shard int"
    rows = [
        (1, None, None, None, None, 0.5, "x", 1), (2, "", "en", "s", 0, None, None, None), (3, "123 456", "en", "s", 7, 0.1, "y", 2),
        *((10 + i, f"the quick brown fox number {chr(97 + i)} jumps over lazy dogs again", "en", "s", 40, 0.2, "z", 3) for i in range(8)),
        *((30 + i, f"der schnelle braune fuchs {chr(97 + i)} springt immer noch gern", "de", "s", 40, 0.2, "z", 3) for i in range(8)),
        (10, "the quick brown fox number a jumps over lazy dogs again", "en", "s", 40, 0.2, "z", 3), (40, "long " * 60_000, "en", "s", 1, 0.0, "", 0),
    ]
    spark.createDataFrame([(10, 1), (30, 1), (3, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    ids = {r["doc_id"] for r in docs.collect()}
    assert ids and not ids & {1, 2, 3}


def test_empty_tables(spark):
    folder = scratch(spark, "test-pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
