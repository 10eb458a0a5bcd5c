"""Byte-level BPE against the tiktoken library, and the exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quarterdeck.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = "aZé1９ \n\t 　'srtdmvel!.$日\U0001f600́_"


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.load_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    draw = random.Random(5)
    made = ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    return [*made, "", "'''''s", "it'll've 're", "a" * 5000, "   \n\n  x  ", "\n", "<|endoftext|>"]


def test_ids_and_round_trip(reference):
    encoder, decoder = byte_bpe.Encoder(PATH), byte_bpe.Decoder(PATH)
    for text, (ids, ends) in zip(texts(), encoder.encode(texts()), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert decoder.decode(ids, ends) == text.encode()


def test_small_cache_changes_nothing(reference):
    encoder = byte_bpe.Encoder(PATH, cache_pieces=3)
    for text, (ids, _) in zip(texts()[:300], encoder.encode(texts()[:300]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_long_pieces_merge_as_short_ones():
    ranks = byte_bpe.load_ranks(PATH)
    draw = random.Random(2)
    for _ in range(200):
        piece = "".join(draw.choice("thearnio") for _ in range(draw.randint(2, 40))).encode()
        if piece not in ranks:
            assert byte_bpe.merge_piece(piece, ranks) == byte_bpe._merge_long(piece, ranks)


def test_scan_composes_functions_in_order():
    of_symbol, _, applied, _ = byte_bpe.transition_functions()
    draw = np.random.default_rng(1)
    symbols = draw.integers(0, 9, 5000)
    state, states = 0, []
    for symbol in symbols:
        state = byte_bpe._step(state, int(symbol))[0]
        states.append(state)
    assert applied[byte_bpe.prefix_functions(of_symbol[symbols], width=7), 0].tolist() == states


def test_documents(spark, reference):
    rows = [(1, "It's  here.", "x"), (2, None, "y"), (2, None, "y"), (3, "", None), (None, "naïve", None), (5, "ab " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    encoded = byte_bpe.encode_documents(df, PATH)
    found = byte_bpe.decode_documents(encoded, PATH).collect()
    assert len(found) == len(rows)
    wanted = {r[0]: r[1] or "" for r in rows}
    for row in found:
        assert np.frombuffer(row.token_ids, "<u4").tolist() == reference.encode_ordinary(wanted[row.doc_id])
        assert bytes(row.decoded) == wanted[row.doc_id].encode()
    assert byte_bpe.encode_documents(df.limit(0), PATH).count() == 0


def test_foreign_offsets_are_an_error():
    decoder = byte_bpe.Decoder(PATH)
    ids, ends = next(byte_bpe.Encoder(PATH).encode(["some text"]))
    with pytest.raises(ValueError):
        decoder.decode(ids, ends[:-4] + b"\0\0\0\0")
