"""Byte-level BPE encoding and decoding.

Texts are cut into pieces without regular expressions.  Each code point has a
class; classes of a text's neighbours settle every look-ahead; what is left is a
machine of eight states.  A character is then a function on states, functions
compose associatively, and all the distinct compositions are few, so a prefix
scan over table look-ups gives the state at every character of a batch at once.
The pieces between boundaries are merged pair by pair, each distinct piece once
per worker while it stays in a bounded cache.

Ids travel as little-endian unsigned 32-bit integers in a binary column, with the
byte offset of every token's end beside them; decoding places the bytes of each
token by these offsets.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarterdeck.llm.shared import RowBuffer, pair_slices

# ---- classes of code points

LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_RUN, SPACE_JOINED, SPACE_ALONE, STOP = range(9)
END_OF_TEXT = 0x110000

# The code points of Unicode's White_Space property.
WHITE_SPACE = (
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x0085, 0x00A0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
    0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# What may follow an apostrophe as a piece of its own.
SHORT_TAILS = "stmd"
LONG_TAILS = ("re", "ve", "ll")


@functools.cache
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACE_RUN for every code point, and STOP for the mark between texts."""
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.full(END_OF_TEXT + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            classes[point] = kind
    classes[list(WHITE_SPACE)] = SPACE_RUN
    classes[END_OF_TEXT] = STOP
    return classes


def symbols(points: np.ndarray) -> np.ndarray:
    """Classes with every look-ahead settled.

    White space is in a run that goes on (or ends the text), or is the last of its
    run: then a blank joins what follows and any other stands alone.  An apostrophe
    says whether a short or a long tail follows it.
    """
    base = code_point_classes()[points]
    after = np.append(base[1:], STOP)
    out = base.copy()
    last = (base == SPACE_RUN) & (after != SPACE_RUN) & (after != STOP)
    out[last] = SPACE_ALONE
    out[last & (points == 0x20)] = SPACE_JOINED
    marks = np.flatnonzero(points == 0x27)
    if marks.size:
        padded = np.append(points, [END_OF_TEXT, END_OF_TEXT])
        one, two = padded[marks + 1], padded[marks + 2]
        out[marks[np.isin(one, [ord(c) for c in SHORT_TAILS])]] = SHORT
        for tail in LONG_TAILS:
            out[marks[(one == ord(tail[0])) & (two == ord(tail[1]))]] = LONG
    return out


# ---- the machine: states say what the last character left open

CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_BLANK, TAIL_ONE, TAIL_TWO = range(8)
STATES = 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether the character begins a piece."""
    if symbol == STOP:
        return CLOSED, True
    if state == TAIL_TWO:
        return TAIL_ONE, False
    if state == TAIL_ONE:
        return CLOSED, False
    if symbol == LETTER:
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if symbol in (OTHER, SHORT, LONG):
        if state in (IN_OTHERS, AFTER_BLANK):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: TAIL_ONE, LONG: TAIL_TWO}[symbol], True
    if symbol == SPACE_RUN:
        return IN_SPACES, state != IN_SPACES
    return (AFTER_BLANK if symbol == SPACE_JOINED else CLOSED), True


@functools.cache
def transition_functions() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All compositions of the symbols' functions: (of symbol, composed [f, then g], applied [f, state], begins).

    ``begins[state, symbol]`` tells whether a character of that class begins a piece.
    """
    single = [tuple(_step(s, c)[0] for s in range(STATES)) for c in range(STOP + 1)]
    number: dict[tuple[int, ...], int] = {}
    queue = [tuple(range(STATES)), *single]
    for f in queue:
        if f not in number:
            number[f] = len(number)
            queue += [tuple(g[x] for x in f) for g in single]
    known = list(number)
    composed = np.array([[number[tuple(g[x] for x in f)] for g in known] for f in known], np.int32)
    begins = np.array([[_step(s, c)[1] for c in range(STOP + 1)] for s in range(STATES)])
    return np.array([number[f] for f in single], np.int32), composed, np.array(known, np.uint8), begins


def prefix_functions(functions: np.ndarray, width: int = 256) -> np.ndarray:
    """Inclusive prefix scan by composition: blocks side by side, then the blocks' totals."""
    _, composed, _, _ = transition_functions()
    size = len(functions)
    if size <= 1:
        return functions
    flat, kinds = composed.ravel(), len(composed)
    rows = -(-size // width)
    padded = np.zeros(rows * width, np.int32)  # function 0 changes nothing
    padded[:size] = functions
    block = np.ascontiguousarray(padded.reshape(rows, width).T)
    for column in range(1, width):
        np.take(flat, block[column - 1] * kinds + block[column], out=block[column])
    if rows > 1:
        totals = prefix_functions(block[-1].copy(), width)
        block[:, 1:] = flat[totals[:-1] * kinds + block[:, 1:]]
    return block.T.ravel()[:size]


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where pieces begin; ``points`` are texts, each followed by ``END_OF_TEXT``, whose mark counts as a piece."""
    of_symbol, _, applied, begins = transition_functions()
    symbol = symbols(points)
    after = applied[prefix_functions(of_symbol[symbol]), CLOSED]
    before = np.empty_like(after)
    before[0], before[1:] = CLOSED, after[:-1]
    return np.flatnonzero(begins[before, symbol])


def split_texts(texts: list[str]) -> Iterator[list[str]]:
    """The pieces of each text, in order; they add up to the text."""
    mark = END_OF_TEXT.to_bytes(4, "little")
    points = np.frombuffer(mark.join([*(t.encode("utf-32-le") for t in texts), b""]), "<u4")
    starts = piece_starts(points)
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    places = np.searchsorted(starts, stops).tolist()
    at = base = 0
    for text, stop, place in zip(texts, stops.tolist(), places, strict=True):
        cuts = (starts[at : place + 1] - base).tolist()
        yield [text[a:b] for a, b in zip(cuts, cuts[1:])]
        at, base = place + 1, stop + 1


# ---- merges


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token and its rank, line by line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens of one piece: the pair of lowest rank merges first, of equals the leftmost."""
    if piece in ranks:
        return [piece]
    if len(piece) > 48:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    pairs = [ranks.get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return parts


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The same by a heap over a linked list, n log n for pieces without a break."""
    size = len(piece)
    end = list(range(1, size + 1))  # of the token that starts here; 0 once merged away
    before = list(range(-1, size - 1))
    heap = []

    def offer(start: int) -> None:
        middle = end[start]
        if middle < size:
            rank = ranks.get(piece[start : end[middle]])
            if rank is not None:
                heapq.heappush(heap, (rank, start, middle, end[middle]))

    for i in range(size - 1):
        offer(i)
    while heap:
        _, start, middle, stop = heapq.heappop(heap)
        if end[start] != middle or end[middle] != stop:
            continue
        end[start], end[middle] = stop, 0
        if stop < size:
            before[stop] = start
            offer(start)
        if before[start] >= 0:
            offer(before[start])
    tokens, at = [], 0
    while at < size:
        tokens.append(piece[at : end[at]])
        at = end[at]
    return tokens


class Encoder:
    """Encodes texts by a rank file; keeps at most ``cache_pieces`` merged pieces, none of them over ``piece_chars``."""

    def __init__(self, path: str, cache_pieces: int = 500_000, piece_chars: int = 64):
        self.ranks = load_ranks(path)
        self.cache_pieces, self.piece_chars = cache_pieces, piece_chars
        self.cache: dict[str, bytes] = {}
        self.lengths = np.zeros(max(self.ranks.values(), default=-1) + 1, np.uint32)
        for token, rank in self.ranks.items():
            self.lengths[rank] = len(token)

    def _merged(self, piece: str) -> bytes:
        tokens = merge_piece(piece.encode(), self.ranks)
        return np.fromiter(map(self.ranks.__getitem__, tokens), "<u4", len(tokens)).tobytes()

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """(ids, byte offset of every token's end) of each text, both as packed 32-bit integers."""
        cache = self.cache
        for first, last in pair_slices(texts):
            for pieces in split_texts(texts[first:last]):
                found = list(map(cache.get, pieces))
                if None in found:
                    if len(cache) > self.cache_pieces:
                        cache.clear()
                    for place, ids in enumerate(found):
                        if ids is None:
                            piece = pieces[place]
                            # The same piece may stand twice in a text.
                            known = cache.get(piece)
                            found[place] = known = self._merged(piece) if known is None else known
                            if len(piece) <= self.piece_chars:
                                cache[piece] = known
                ids = b"".join(found)
                yield ids, np.cumsum(self.lengths[np.frombuffer(ids, "<u4")], dtype="<u4").tobytes()


class Decoder:
    """Bytes of packed ids; given the offsets, every token's bytes are put in place at once."""

    def __init__(self, path: str):
        ranks = load_ranks(path)
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.lengths = lengths

    def decode(self, ids: bytes, ends: bytes) -> bytes:
        """Raises when the offsets do not belong to the ids."""
        tokens, stops = np.frombuffer(ids, "<u4"), np.frombuffer(ends, "<u4").astype(np.int64)
        lengths = self.lengths[tokens]
        if not np.array_equal(np.cumsum(lengths), stops):
            raise ValueError("offsets and ids differ")
        if not len(tokens):
            return b""
        shift = np.repeat(self.starts[tokens] - (stops - lengths), lengths)
        return self.flat[shift + np.arange(stops[-1])].tobytes()


# One of each per worker and rank file.
@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(maxsize=2)
def decoder_of(path: str) -> Decoder:
    return Decoder(path)


def encode_documents(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: (id, token_ids, token_ends), both binary, packed 32-bit little-endian.

    Nulls count as the empty text, which has no tokens.  Equal rows give equal rows;
    other columns are left out, so their names cannot clash.  An empty table gives an
    empty result.  A very long text is worked on alone; memory follows the longest text.
    """
    kind = df.schema[id_column].dataType.simpleString()
    schema = pa.schema([("id", pa.int64() if kind == "bigint" else pa.string()), ("ids", pa.binary()), ("ends", pa.binary())])

    def run(batches):
        encoder = encoder_of(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            keys, rows = batch.column(0).to_pylist(), RowBuffer(schema)
            for key, (ids, ends) in zip(keys, encoder.encode(texts), strict=True):
                rows.add(key, ids, ends, size=len(ids) + len(ends))
                if rows.full():
                    yield from rows.take()
            yield from rows.take()

    id_type = "bigint" if kind == "bigint" else "string"
    asked = df.selectExpr(f"CAST(`{id_column}` AS {id_type}) AS id", f"CAST(`{text_column}` AS string) AS text")
    out = asked.mapInArrow(run, f"id {id_type}, ids binary, ends binary")
    return out.selectExpr(f"id AS `{id_column}`", "ids AS token_ids", "ends AS token_ends")


def decode_documents(df: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """Adds ``decoded`` (binary) to (id, token_ids, token_ends); null ids decode to nothing."""
    kind = df.schema[id_column].dataType.simpleString()
    key = pa.int64() if kind == "bigint" else pa.string()
    schema = pa.schema([("id", key), ("ids", pa.binary()), ("ends", pa.binary()), ("decoded", pa.binary())])

    def run(batches):
        decoder = decoder_of(path)
        for batch in batches:
            rows = RowBuffer(schema)
            for one, ids, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = decoder.decode(ids or b"", ends or b"")
                rows.add(one, ids, ends, text, size=3 * len(text))
                if rows.full():
                    yield from rows.take()
            yield from rows.take()

    asked = df.selectExpr(f"`{id_column}` AS id", "token_ids AS ids", "token_ends AS ends")
    out = asked.mapInArrow(run, f"id {kind}, ids binary, ends binary, decoded binary")
    return out.selectExpr(f"id AS `{id_column}`", "ids AS token_ids", "ends AS token_ends", "decoded")
