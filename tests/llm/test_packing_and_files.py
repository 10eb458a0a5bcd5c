"""Word ids, packing and id files against the tokenizers library."""

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarterdeck.llm import id_files, packing
from quarterdeck.llm.shared import scratch
from quarterdeck.llm.words import WordTokenizer, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aZé1９ \n\t 　'srtdmvel!.$日\U0001f600́_İΣ가\x1c\x85"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def texts(count=2000):
    draw = random.Random(3)
    made = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 40))) for _ in range(count)]
    return [*made, "", "it'll've 're", "The (end).", "a" * 3000, "<|endoftext|> a<|startoftext|>", "naïve, café!"]


@pytest.mark.parametrize("cache", [5, 100_000])
def test_word_cache(reference, cache):
    tokenizer = WordTokenizer(PATH, cache_words=cache)
    for text, ids in zip(texts(), tokenizer.encode(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference(text)


ROWS = [
    (7, "word " * 9000, 1), (3, None, 2), (4, "", 3), (4, "", 3), (11, "Some text, twice.", 4), (12, "Some text, twice.", None),
    *((100 + i, "alpha beta gamma " * (i * 37 % 500), 5) for i in range(120)),
]
SCHEMA = "doc_id long, text string, sequence_id int"


def test_token_ids(spark, reference):
    found = token_ids(spark.createDataFrame(ROWS, SCHEMA), PATH, 2).collect()
    wanted = {r[0]: [*reference(r[1]), 2] for r in ROWS}
    assert len(found) == len(ROWS)
    assert all(np.frombuffer(r.token_ids, "<u4").tolist() == wanted[r.doc_id] for r in found)


@pytest.mark.parametrize(("parts", "windows"), [(1, 64), (5, 2), (20, 3)])
def test_packing(spark, reference, parts, windows):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    pieces = packing.pack_documents(df, PATH, 2, window=512, open_windows=windows, fan_in=4).collect()
    check_pieces(pieces, ROWS, reference, 512)
    used = defaultdict(int)
    for p in pieces:
        used[p.sequence_id] += p.length
    total = sum(used.values())
    assert sum(512 - u for u in used.values()) < 0.1 * total + 512 * parts


def check_pieces(pieces, rows, reference, window):
    wanted = {r[0]: [*reference(r[1]), 2] for r in rows}
    copies = defaultdict(int)
    for row in rows:
        copies[row[0]] += 1
    sequences, cover = defaultdict(list), defaultdict(int)
    for p in pieces:
        ids = wanted[p.doc_id]
        assert p.doc_tokens == len(ids)
        assert np.frombuffer(p.ids, "<u4").tolist() == ids[p.start : p.start + p.length]
        sequences[p.sequence_id].append((p.offset, p.length))
        for at in range(p.start, p.start + p.length):
            cover[p.doc_id, at] += 1
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    assert cover == {(d, at): copies[d] for d, ids in wanted.items() for at in range(len(ids))}


def test_packing_nothing(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH, 2).count() == 0


def test_padding_leaves_powers_of_two(spark):
    rows = [(1, 256), (1, 256), (2, 100), (3, 4096)]
    found = packing.padding(spark.createDataFrame(rows, "sequence_id long, length long")).first()
    assert (found.sequences, found.ids, found.padding) == (3, 4708, 3996)


def test_id_files(spark, reference):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    out = scratch(spark, "test-ids")
    id_files.write_documents(df, out, PATH, 2, docs_per_shard=20, segment_limit=5000)
    rows = id_files.with_starts(id_files.read_segments(spark, out), spark, out).collect()
    wanted = sorted((r[0], tuple([*reference(r[1]), 2])) for r in ROWS)
    found = sorted((r.doc_id, tuple(np.frombuffer(r.token_ids, "<u4").tolist())) for r in rows)
    assert found == wanted
    at = 0
    starts = sorted((r.start, r.doc_id, r.n_tokens) for r in rows)
    assert [d for _, d, _ in starts] == [d for d, _ in wanted]
    for start, _, n in starts:
        assert start == at
        at += n
    one = id_files.read_document(spark, out, 11).collect()
    assert len(one) == 1 and zlib.crc32(one[0].token_ids) == zlib.crc32(np.array(dict(wanted)[11], "<u4").tobytes())
    assert one[0].start == next(s for s, d, _ in starts if d == 11)


def test_id_files_of_nothing(spark):
    out = scratch(spark, "test-none")
    id_files.write_documents(spark.createDataFrame([], SCHEMA), out, PATH, 2)
    assert id_files.with_starts(id_files.read_segments(spark, out), spark, out).count() == 0


def test_rows_without_id_have_no_place(spark):
    with pytest.raises(ValueError):
        id_files.write_documents(spark.createDataFrame([(None, "x", 1)], SCHEMA), scratch(spark, "test-null"), PATH, 2)


def test_a_wrong_dictionary_is_an_error():
    import hashlib

    import zstandard

    frame = zstandard.ZstdCompressor().compress(b"\1\0\0\0")
    data = id_files.segment_bytes(0, 0, hashlib.sha256(b"a").digest(), [(1, 1, frame)])
    with pytest.raises(ValueError):
        id_files.Segment(data, hashlib.sha256(b"b").digest())


def test_words_met_again_cost_no_walk_through_the_older_generation(reference):
    tokenizer = WordTokenizer(PATH)
    tokenizer.old_words = {f"old{k}": b"" for k in range(400_000)}
    tokenizer.old_pieces = {f"old{k}": b"" for k in range(400_000)}
    texts = [f"new{k}a again, Again new{k}b" for k in range(500)]
    begun = time.process_time()
    found = list(tokenizer.encode(texts))
    # A walk through 400,000 entries for each text takes more than ten times as long.
    assert time.process_time() - begun < 1
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [reference(t) for t in texts]
