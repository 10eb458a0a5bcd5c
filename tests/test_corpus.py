"""The stored corpus: updates write what changed, reads open what they need."""

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import retrieval
from quarterdeck.plans import jobs
from quarterdeck.sources import corpus, writers
from quarterdeck.sources.writers import bucket_of

TURN = "deal_id string, turn_text string, ordinal long"
MAIL = "deal_id string, body string, ordinal long"
CHUNK = "chunk_id string, deal_id string, document string"


@pytest.fixture
def no_mail(spark):
    return spark.createDataFrame([], MAIL)


@pytest.fixture
def path(tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "CORPUS_BUCKETS", 16)
    return str(tmp_path / "corpus")


def counting(spark):
    """An embedding step that counts the texts it is given."""
    seen = spark.sparkContext.accumulator(0)

    def build():
        def encode(texts):
            seen.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]

        return encode

    return seen, lambda texts: retrieval.with_embeddings(texts, "document", build)


def test_takes_updates_and_keeps_the_rest(spark, rows, no_mail, path):
    assert corpus.read_corpus(spark, path) is None
    jobs.index_corpus(spark.createDataFrame([("D", "old", 0), ("D", "stays", 1), ("E", "other", 0)], TURN), no_mail, path)
    update = spark.createDataFrame([("D", "new", 0), ("F", "added", 0), (" ", "blank", 1), (None, "null", 2)], TURN)
    built = jobs.index_corpus(update, no_mail, path)
    wanted = [
        (":transcript:0", "blank"), (":transcript:1", "null"), ("D:transcript:0", "new"),
        ("D:transcript:1", "stays"), ("E:transcript:0", "other"), ("F:transcript:0", "added"),
    ]
    assert rows(built, "chunk_id", "document") == wanted
    assert rows(corpus.read_corpus(spark, path), "chunk_id", "document") == wanted
    # The same update again changes nothing and writes nothing.
    jobs.index_corpus(update, no_mail, path)
    assert corpus.manifests(spark, path) == [1, 2]
    assert rows(jobs.index_corpus(spark.createDataFrame([], TURN), no_mail, path), "chunk_id", "document") == wanted


def test_small_update_writes_little_and_embeds_nothing_twice(spark, path):
    seen, embed = counting(spark)
    chunks = spark.createDataFrame([(f"D{i}:t:0", f"D{i}", f"text {i % 700}") for i in range(1000)], CHUNK)
    assert corpus.update_corpus(chunks, path, embed, "e") == (1000, 700)
    assert seen.value == 700
    assert corpus.update_corpus(chunks, path, embed, "e") == (0, 0)
    some = F.col("deal_id").isin(*(f"D{i}" for i in range(10)))
    update = chunks.withColumn("document", F.when(some, F.concat(F.lit("new "), "document")).otherwise(F.col("document")))
    assert corpus.update_corpus(update, path, embed, "e") == (10, 10)
    assert spark.read.parquet(f"{path}/data/version=2").count() == 10
    # Texts that were stored once are not embedded again, also where they have left the corpus.
    assert corpus.update_corpus(chunks, path, embed, "e") == (10, 0)
    assert seen.value == 710
    # Another encoder makes every vector anew.
    assert corpus.update_corpus(chunks, path, embed, "f") == (1000, 700)


def test_compaction_and_expiry_change_no_row(spark, rows, path):
    _, embed = counting(spark)
    everyone = spark.createDataFrame([(f"c{i}", f"D{i % 40}", f"text {i}") for i in range(200)], CHUNK)
    corpus.update_corpus(everyone, path, embed, "e")
    for turn in range(3):
        change = everyone.filter(f"deal_id IN ('D{turn}', 'D7')").withColumn("document", F.lit(f"turn {turn}"))
        corpus.update_corpus(change, path, embed, "e")
    before = rows(corpus.read_corpus(spark, path))
    touched = {r[0] for r in spark.createDataFrame([("D0",), ("D1",), ("D2",), ("D7",)], "d string").select(bucket_of("d")).collect()}
    assert corpus.compact(spark, path) == len(touched)
    assert rows(corpus.read_corpus(spark, path)) == before
    assert all(len(v) == 1 for v in corpus.layout(spark, path).values())
    # Only buckets with several versions were written anew.
    written = spark.read.parquet(f"{path}/data/version=5").select("deal_bucket").distinct().collect()
    assert {r[0] for r in written} == touched
    assert corpus.compact(spark, path) == 0
    assert corpus.expire(spark, path) >= len(touched) and corpus.expire(spark, path) == 0
    assert corpus.manifests(spark, path) == [5] and rows(corpus.read_corpus(spark, path)) == before


def test_chunk_that_moves_to_another_deal(spark, rows, path):
    _, embed = counting(spark)
    corpus.update_corpus(spark.createDataFrame([("c", "D", "x"), ("d", "D", "y"), ("n", None, "z")], CHUNK), path, embed, "e")
    moved = spark.createDataFrame([("c", "other", "x"), ("n", "D", "z")], CHUNK)
    assert corpus.update_corpus(moved, path, embed, "e") == (2, 0)
    wanted = [("c", "other"), ("d", "D"), ("n", "D")]
    assert rows(corpus.read_corpus(spark, path), "chunk_id", "deal_id") == wanted
    asked = spark.createDataFrame([("D",)], "deal_id string")
    assert rows(corpus.read_corpus(spark, path, asked), "chunk_id") == [("d",), ("n",)]
    corpus.compact(spark, path)
    assert rows(corpus.read_corpus(spark, path), "chunk_id", "deal_id") == wanted
    corpus.update_corpus(spark.createDataFrame([("c", "D", "x")], CHUNK), path, embed, "e")
    assert rows(corpus.read_corpus(spark, path, asked), "chunk_id") == [("c",), ("d",), ("n",)]


def test_failed_update_leaves_the_corpus_and_can_be_repeated(spark, rows, path):
    seen, embed = counting(spark)
    corpus.update_corpus(spark.createDataFrame([("c", "D", "x")], CHUNK), path, embed, "e")
    update = spark.createDataFrame([("c", "D", "new"), ("d", "E", "y")], CHUNK)

    def failing(texts):
        stop = F.raise_error(F.lit("encoder lost")).cast("array<float>")
        return texts.withColumn("embedding", F.when(F.col("document") == "y", stop))

    with pytest.raises(Exception, match="encoder lost"):
        corpus.update_corpus(update, path, failing, "e")
    assert rows(corpus.read_corpus(spark, path), "chunk_id", "document") == [("c", "x")]
    # Data of a version that no manifest names is not read and is written over.
    stray = corpus.read_corpus(spark, path).withColumn("chunk_id", F.lit("stray")).withColumn("deleted", F.lit(False))
    stray.write.partitionBy("deal_bucket").parquet(f"{path}/data/version=2")
    assert corpus.read_corpus(spark, path).count() == 1
    assert corpus.update_corpus(update, path, embed, "e") == (2, 2)
    assert rows(corpus.read_corpus(spark, path), "chunk_id", "document") == [("c", "new"), ("d", "y")]


def test_retrieval_opens_only_the_asked_deals(spark, rows, no_mail, path):
    turns = spark.createDataFrame([(f"D{i}", f"budget {i}", i) for i in range(300)], TURN)
    jobs.index_corpus(turns, no_mail, path)
    jobs.index_corpus(turns.filter("deal_id = 'D7'").withColumn("turn_text", F.lit("late budget")), no_mail, path)
    wanted = spark.createDataFrame([("D7",), ("D9",), ("D11",), ("none",), (None,)], "deal_id string")
    found = corpus.read_corpus(spark, path, wanted)
    buckets = {r[0] for r in wanted.select(bucket_of("deal_id")).collect()}
    opened = {f.rsplit("/", 2)[1] for f in found.inputFiles()}
    assert opened <= {f"deal_bucket={b}" for b in buckets} and len(buckets) <= 5 < len(corpus.layout(spark, path))
    plan = found._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "PushedFilters" in line and "embedding" in line)
    assert "In(deal_id, [" in scan.split("PushedFilters")[1]
    assert rows(found, "deal_id", "document") == [("D11", "budget 11"), ("D7", "late budget"), ("D9", "budget 9")]
    asked = retrieval.with_embeddings(retrieval.query_table(spark, ["budget"]), "query")
    context = jobs.stored_context(wanted, path, asked, 1)
    assert rows(context, "deal_id", "context_block", "retrieval_ok") == [
        ("D11", "budget 11", True), ("D7", "late budget", True), ("D9", "budget 9", True), ("none", "", True), (None, "", False),
    ]
    assert corpus.read_corpus(spark, path, wanted.filter("deal_id = 'none'")).count() == 0
    with pytest.raises(ValueError, match="no corpus"):
        jobs.stored_context(wanted, path + "-other", asked, 1)


def test_many_wanted_values_go_through_a_join(spark, rows, monkeypatch):
    monkeypatch.setattr(corpus, "LISTED_VALUES", 2)
    some = spark.createDataFrame([(f"D{i}", i) for i in range(9)], "deal_id string, n int")
    wanted = spark.createDataFrame([("D1",), ("D3",), ("D3",), ("D8",), (None,), ("x",)], "deal_id string")
    assert rows(corpus.with_values(some, "deal_id", wanted), "n") == [(1,), (3,), (8,)]
    assert rows(corpus.with_values(some, "deal_id", wanted.filter("deal_id <= 'D3'")), "n") == [(1,), (3,)]


def test_own_encoder_needs_a_name(spark, no_mail, path):
    turns = spark.createDataFrame([("D", "x", 0)], TURN)
    with pytest.raises(ValueError, match="needs a name"):
        jobs.index_corpus(turns, no_mail, path, encoder=lambda: lambda texts: [[1.0] for _ in texts])


def test_rows_that_no_later_version_names_are_not_moved(spark, path):
    _, embed = counting(spark)
    first = spark.createDataFrame([(f"c{i}", f"D{i % 3}", f"text {i}") for i in range(300)], CHUNK)
    corpus.update_corpus(first, path, embed, "e")
    corpus.update_corpus(spark.createDataFrame([("c7", "D1", "new"), ("c8", "D2", None)], CHUNK), path, embed, "e")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = corpus.read_corpus(spark, path)
        texts = {r.chunk_id: r.document for r in found.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert texts == {f"c{i}": f"text {i}" for i in range(300)} | {"c7": "new", "c8": None}
    # The join is asked for flagged rows alone, all others are read beside it.
    assert plan.count("Join LeftAnti") == 1 and "Union" in plan and "bitmap_construct_agg" in plan
