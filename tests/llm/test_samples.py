"""Samples that models and dictionaries are fitted on stay bounded when ids repeat."""

from pyspark.sql import functions as F

from quarterdeck.llm import id_files, language, quality, shared


def test_one_row_for_each_id(spark):
    rows = spark.range(6_000).selectExpr("id % 3 AS doc_id", "concat('text ', id % 50) AS text", "id AS _row")
    found = shared.one_row_each(rows.repartition(7), "doc_id", "text").collect()
    again = shared.one_row_each(rows.repartition(2), "doc_id", "text").collect()
    assert len(found) == 3 and sorted(found) == sorted(again)
    assert shared.one_row_each(rows.limit(0), "doc_id", "text").count() == 0


def test_one_id_in_all_rows_gives_a_bounded_language_sample(spark):
    rules = language.LanguageRules(docs_per_language=200)
    docs = spark.range(8_000).selectExpr("1L AS doc_id", "concat('word', id) AS text", "if(id % 2 = 0, 'a', 'b') AS lang")
    counts = {r["lang"]: r["count"] for r in language.training_sample(docs, rules, "doc_id", "text", "lang").groupBy("lang").count().collect()}
    assert set(counts) == {"a", "b"} and all(120 < n < 300 for n in counts.values())


def test_one_id_in_many_rows_counts_once_for_the_quality_model(spark, monkeypatch):
    many = spark.range(3_000).selectExpr("1L AS doc_id", "concat('same id ', id) AS text")
    others = spark.range(2, 42).selectExpr("id AS doc_id", "concat('good words or bad ', id % 2) AS text")
    docs = many.unionByName(others).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text")})
    labels = spark.range(1, 30).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    seen = []
    real = quality.co_train

    def watched(text, meta, y, held, free_text, free_meta, rules):
        seen.append((len(text), len(free_text)))
        return real(text, meta, y, held, free_text, free_meta, rules)

    monkeypatch.setattr(quality, "co_train", watched)
    quality.learn(docs, labels)
    assert seen == [(29, 12)]


def test_one_id_in_many_rows_counts_once_for_the_dictionary(spark, monkeypatch):
    from quarterdeck.llm.queries import END_ID, WORD_FILE

    seen = []
    monkeypatch.setattr(id_files, "train_dictionary", lambda samples: seen.append(len(samples)) or b"")
    docs = spark.range(3_000).selectExpr("if(id < 2900, 7, id) AS doc_id", "concat('text ', id) AS text")
    id_files.sample_dictionary(docs, WORD_FILE, END_ID, rows=100)
    assert seen == [101]
