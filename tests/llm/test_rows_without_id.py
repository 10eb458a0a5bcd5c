"""Rows without an id go through archives and id files like others."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarterdeck.llm import id_files, queries, warc
from quarterdeck.llm.shared import scratch

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("chunk", [3, 1000])
def test_pages_without_id(spark, chunk):
    rows = [(1, "u", "shared text"), (None, "v", "shared text"), (None, "w", "mine alone"), (None, "w", "mine alone"), (None, None, None), (2, "x", "other")]
    out = scratch(spark, "test-nameless")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), out, chunk_bytes=chunk, nameless=True)
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_records(spark, out).collect())
    assert found == Counter({
        (1, 11, "response", None): 1, (None, 11, "revisit", 1): 1, (None, 10, "response", None): 2,
        (None, 0, "response", None): 1, (2, 5, "response", None): 1,
    })


ROWS = [(None, "one two"), (-5, "three"), (None, None), (0, "zero"), *((i, f"text {i}") for i in range(1, 60)), *((None, f"lost {i}") for i in range(30))]


@pytest.mark.parametrize("rows", [ROWS, [r for r in ROWS if r[0] is None]])
def test_documents_without_id(spark, rows):
    reference = Tokenizer.from_file(PATH)
    out = scratch(spark, "test-nameless")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    id_files.write_documents(df, out, PATH, 2, docs_per_shard=20, segment_limit=200, nameless=True)
    found = id_files.with_starts(id_files.read_segments(spark, out), spark, out).collect()
    wanted = Counter((r[0], tuple([*reference.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.token_ids, "<u4").tolist())) for r in found) == wanted
    at, ids = 0, []
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
        ids.append(row.doc_id)
    nameless = sum(r[0] is None for r in rows)
    assert ids == [None] * nameless + sorted(r[0] for r in rows if r[0] is not None)
    assert id_files.read_document(spark, out, 0).count() == sum(r[0] == 0 for r in rows)


def test_queries_take_rows_without_id(spark, tmp_path):
    spark.createDataFrame([(None, "a b"), (1, "c")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "u", "a"), (1, "u", "b")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.doc_id for r in queries.QUERIES["op7_id_files"](spark, str(tmp_path)).collect()} == {None, 1}
    assert {r.page_id for r in queries.QUERIES["op3_warc"](spark, str(tmp_path)).collect()} == {None, 1}
