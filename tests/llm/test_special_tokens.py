"""Strings of special tokens within texts, against the tokenizers library as it is by default."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quarterdeck.llm import packing
from quarterdeck.llm.words import WordTokenizer, token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["end of page <|endoftext|> next page", "a<|startoftext|>b", "<|EndOfText|> x", "<|endoftext |>", "<| endoftext|>",
         "<|endoftext|><|endoftext|>\n tail", "no token", None]


def test_special_tokens_as_the_library_has_them(spark):
    reference = Tokenizer.from_file(PATH)
    wanted = {i: [*reference.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(TEXTS)}
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: np.frombuffer(r.token_ids, "<u4").tolist() for r in token_ids(df, PATH, 2).collect()}
    assert found == wanted
    packed = packing.pack_documents(df, PATH, 2).collect()
    assert {r.doc_id: r.doc_tokens for r in packed} == {i: len(ids) for i, ids in wanted.items()}
    assert len(wanted[0]) == 7


def test_generations_keep_what_is_met_again():
    tokenizer = WordTokenizer(PATH, cache_words=40)
    wanted = {}
    for k in range(200):
        text = f"often Often, rare{k} naïve{k}! often"
        (found,) = tokenizer.encode([text])
        wanted[text] = found
        assert len(tokenizer.words) <= 25 and "often" in tokenizer.words
    assert not any(f"rare{k}" in tokenizer.words or f"rare{k}" in tokenizer.old_words for k in range(100))
    whole = WordTokenizer(PATH)
    assert list(whole.encode(wanted)) == list(wanted.values())
