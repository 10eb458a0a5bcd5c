"""Token ids of a public tokenizer file, with a cache of words.

The tokenizers library gives the ids of every distinct word; equal words of a batch
or of an earlier batch are looked up.  This needs a tokenizer whose pieces never
reach over white space, which the file's own normalizer and splitter must grant:
the ids of a text are then those of its words in order.
"""

from __future__ import annotations

import functools
import itertools
import os
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarterdeck.llm.shared import RowBuffer

# What str.split() parts at although the tokenizers' white space does not hold it.
SPLIT_ONLY = ("\x1c", "\x1d", "\x1e", "\x1f")

# Marks that no splitter joins with letters; an apostrophe may begin a tail such as 're.
MARKS = string.punctuation.replace("'", "")


def byte_alphabet() -> dict[int, str]:
    """The rule by which byte-level tokenizers show bytes: printable ones as they are, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """Packed ids of texts, with what is known of words and of their pieces in two generations.

    When the newer generation holds half of ``cache_words`` words, or words of half of
    ``cache_chars`` characters, it becomes the older one and the older one goes; what is met
    again in time is taken over, so frequent words stay and rare ones leave.

    With ``special_tokens`` the string of a special token in a text is that token, as the
    library has it by default; without, it is ordinary text.
    """

    def __init__(self, path: str, cache_words: int = 600_000, cache_chars: int = 8 << 20, special_tokens: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if special_tokens or not t.special]
        # Such a token may reach over words and is sought in the text as it is or as it is normalized.
        self.added = [t.content for t in added if not t.normalized]
        self.added_normal = [self.tokenizer.normalizer.normalize_str(t.content) for t in added if t.normalized]
        self.cache_words, self.cache_chars = cache_words, cache_chars
        self.chars = 0
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.alphabet = byte_alphabet()
        # Letters, marks and digits as the file's own splitter shows them, or no shortcut.
        probe = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("é" + MARKS)]
        self.plain = probe == [self._shown("é"), MARKS]
        # What the normalizer makes of ASCII letters with marks behind them: lower case, nothing, or no shortcut.
        shapes = {string.ascii_letters.lower() + MARKS: str.lower, string.ascii_letters + MARKS: str}
        self.fold = shapes.get(self.tokenizer.normalizer.normalize_str(string.ascii_letters + MARKS))

    def _shown(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.alphabet)

    def _pieces_of(self, span: str) -> list[str]:
        """Pieces of one normalized word: letters and then marks are told apart here, all else by the library."""
        if self.plain:
            letters = span.rstrip(MARKS)
            if letters.isalpha():
                tail = span[len(letters) :]
                shown = letters if letters.isascii() else self._shown(letters)
                return [shown, tail] if tail else [shown]
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(span)]

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _holds_added(self, text: str) -> bool:
        if any(content in text for content in self.added):
            return True
        if not self.added_normal:
            return False
        normal = self.tokenizer.normalizer.normalize_str(text)
        return any(content in normal for content in self.added_normal)

    def _turn_if_full(self) -> None:
        if len(self.words) > self.cache_words // 2 or self.chars > self.cache_chars // 2:
            self.old_words, self.old_pieces = self.words, self.pieces
            self.words, self.pieces, self.chars = {}, {}, 0

    def _know_pieces(self, wanted: Iterable[str]) -> None:
        """Ids of pieces: one call of the model for each that is new."""
        pieces, old = self.pieces, self.old_pieces
        new = set(wanted).difference(pieces)
        if old:
            # The difference looks up what is new; an intersection with a dict would walk through the dict.
            unknown = new.difference(old)
            pieces.update((p, old[p]) for p in new - unknown)
            new = unknown
        tokenize = self.tokenizer.model.tokenize
        pieces.update((p, b"".join([t.id.to_bytes(4, "little") for t in tokenize(p)])) for p in new)

    def _learn_plain(self, words: list[str], stems: list[str]) -> None:
        """Words of ASCII letters (``stems``) with marks behind them or none."""
        shown = list(map(self.fold, stems))
        tails = [word[len(stem) :] for word, stem in zip(words, stems)]
        self._know_pieces([*shown, *filter(None, tails)])
        get = self.pieces.__getitem__
        ids = [get(s) + get(tail) if tail else get(s) for s, tail in zip(shown, tails)]
        self.words.update(zip(words, ids))

    def _learn_other(self, words: list[str]) -> None:
        """Any words: normalized in one call, then split into pieces."""
        spans = self.tokenizer.normalizer.normalize_str(" ".join(words)).split(" ")
        if len(spans) != len(words):  # a normalizer that makes or removes blanks: no shortcut
            self.words.update((w, self._whole(w)) for w in words)
            return
        split = list(map(self._pieces_of, spans))
        self._know_pieces(itertools.chain.from_iterable(split))
        get = self.pieces.__getitem__
        self.words.update((w, b"".join(map(get, found))) for w, found in zip(words, split))

    def _learn(self, words: list[str]) -> None:
        """Ids of words the newer generation does not hold."""
        self.chars += sum(map(len, words))
        if self.old_words:
            known = list(map(self.old_words.get, words))
            self.words.update((w, ids) for w, ids in zip(words, known) if ids is not None)
            words = [w for w, ids in zip(words, known) if ids is None]
        if self.plain and self.fold:
            stems = [w.rstrip(MARKS) for w in words]
            plain = [s.isascii() and s.isalpha() for s in stems]
            self._learn_plain(list(itertools.compress(words, plain)), list(itertools.compress(stems, plain)))
            words = [w for w, is_plain in zip(words, plain) if not is_plain]
        if words:
            self._learn_other(words)

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        for text in texts:
            if any(mark in text for mark in SPLIT_ONLY) or self._holds_added(text):
                yield self._whole(text)
                continue
            self._turn_if_full()
            words = text.split()
            # Repeated words meet the large table once before the ids are joined.
            new = set(words).difference(self.words)
            if new:
                self._learn(list(new))
            yield b"".join(map(self.words.__getitem__, words))


@functools.lru_cache(maxsize=2)
def tokenizer_of(path: str) -> WordTokenizer:
    """One per worker and file; it gives the ids the library gives by default."""
    return WordTokenizer(path, special_tokens=True)


def token_ids(df: DataFrame, path: str, end_id: int | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, token_ids): packed ids of every whole text, ``end_id`` appended; null counts as empty."""
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")
    schema = pa.schema([("id", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        tokenizer, rows = tokenizer_of(path), RowBuffer(schema)
        for batch in batches:
            texts = (t or "" for t in batch.column(1).to_pylist())
            for key, ids in zip(batch.column(0).to_pylist(), tokenizer.encode(texts), strict=True):
                rows.add(key, ids + tail, size=len(ids))
                if rows.full():
                    yield from rows.take()
        yield from rows.take()

    asked = df.selectExpr(f"CAST(`{id_column}` AS bigint) AS id", f"CAST(`{text_column}` AS string) AS text")
    return asked.mapInArrow(run, "id bigint, ids binary").selectExpr(f"id AS `{id_column}`", "ids AS token_ids")
