"""Word counts over running text that is stored as many rows.

A group's text is its rows joined by one blank.  Joining them for real would put
all text of a group into one string, so each row is counted where it lies:

* a word without a blank never reaches over a join, so row counts add up;
* a phrase with blanks may begin in one row and end in a later one.  A row then
  becomes a small table: for each amount of the phrase already seen, how many
  matches the row completes and how much of the phrase is open at its end.  These
  tables compose in row order, in any grouping, and stay a few numbers wide.

The functions return SQL expressions over column names: one word list makes
hundreds of nodes, and a parsed text builds them in one call.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

_CUT = "\\0"


def check_words(words: Sequence[str]) -> None:
    for word in words:
        if not word or word != word.strip() or "\0" in word:
            raise ValueError(f"tone word must be non-empty, without outer white space: {word!r}")


def plain_words(words: Sequence[str]) -> list[str]:
    return [w.lower() for w in words if " " not in w]


def phrases(words: Sequence[str]) -> list[str]:
    return [w.lower() for w in words if " " in w]


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _size(text: str) -> int:
    return len(text.encode("utf-8"))


def _sum(terms: Iterable[str]) -> str:
    return " + ".join(["0L", *terms])


def hits(lowered: str, words: Sequence[str]) -> str:
    """Non-overlapping occurrences of each word in a lower-cased text, summed.

    Byte lengths suffice, and are stored with the string, so nothing is decoded.
    """
    return _sum(
        f"(octet_length({lowered}) - octet_length(replace({lowered}, {quoted(w)}, ''))) div {_size(w)}" for w in words
    )


def balance(positive: str, negative: str) -> str:
    """(positive - negative) / (positive + negative), 0 without any hit."""
    return f"coalesce(({positive} - {negative}) / nullif({positive} + {negative}, 0), 0D)"


def open_lengths(phrase: str) -> list[int]:
    """How much of the phrase can be open at a join: nothing, or up to one of its blanks."""
    return [0, *(i for i, ch in enumerate(phrase) if ch == " ")]


def marked(joined: str, phrase: str, opened: int = 0) -> str:
    """The row's text after ``opened`` characters of the phrase, each match replaced by a mark."""
    text = f"concat({quoted(phrase[:opened])}, {joined})" if opened else joined
    return f"replace({text}, {quoted(phrase)}, '{_CUT}')"


def _step(joined: str, cut: str, phrase: str, opened: int) -> str:
    whole = f"octet_length({joined}) + {_size(phrase[:opened])}"
    longest_first = list(enumerate(open_lengths(phrase)))[:0:-1]
    cases = " ".join(f"WHEN endswith({cut}, {quoted(phrase[:n])}) THEN {i}" for i, n in longest_first)
    found = f"({whole} - octet_length({cut})) div {_size(phrase) - 1}"
    return f"named_struct('n', {found}, 'to', CASE {cases} ELSE 0 END)"


def continues(joined: str, phrase: str) -> str:
    """Whether the row, ``joined`` to what came before, can continue an open phrase."""
    tails = [quoted(phrase[n:]) for n in open_lengths(phrase)[1:]]
    return "(" + " OR ".join(f"startswith({joined}, {t}) OR startswith({t}, {joined})" for t in tails) + ")"


def leaves_open(cut: str, phrase: str) -> str:
    """Whether the row ends within the phrase."""
    return "(" + " OR ".join(f"endswith({cut}, {quoted(phrase[:n])})" for n in open_lengths(phrase)[1:]) + ")"


def own_hits(joined: str, cut: str, phrase: str) -> str:
    """Matches of the phrase within the row."""
    return f"(octet_length({joined}) - octet_length({cut})) div {_size(phrase) - 1}"


def phrase_steps(joined: str, cut: str, phrase: str) -> str:
    """One row's table for one phrase: ``array<struct<n, to>>`` indexed by the open amount.

    ``joined`` is the lower-cased text after a blank and ``cut`` its ``marked`` form.
    The other entries differ from the first only when the row continues the phrase.
    """
    fresh = _step(joined, cut, phrase, 0)
    carried = [
        f"CASE WHEN {continues(joined, phrase)} THEN {_step(joined, marked(joined, phrase, n), phrase, n)} "
        f"ELSE {fresh} END"
        for n in open_lengths(phrase)[1:]
    ]
    return f"array({', '.join([fresh, *carried])})"


def compose(ordered: str, words: Sequence[str]) -> str:
    """Folds an ordered array of rows' tables (one per phrase) into one.

    A null stands for a row that neither continues a phrase nor leaves one open; it
    closes what is open.  Most rows are such, and after the first they cost nothing.
    """
    starts = (
        "array(" + ", ".join(f"named_struct('n', 0L, 'to', {i})" for i in range(len(open_lengths(p)))) + ")"
        for p in words
    )
    follow = "transform(done, e -> named_struct('n', e.n + step[e.to].n, 'to', step[e.to].to))"
    close = "transform(acc.tables, done -> transform(done, e -> named_struct('n', e.n, 'to', 0)))"
    return (
        f"aggregate({ordered}, named_struct('tables', array({', '.join(starts)}), 'open', true), "
        "(acc, steps) -> CASE "
        f"WHEN steps IS NOT NULL THEN named_struct('tables', zip_with(acc.tables, steps, (done, step) -> {follow}), "
        "'open', true) "
        f"WHEN acc.open THEN named_struct('tables', {close}, 'open', false) "
        "ELSE acc END, acc -> acc.tables)"
    )


def is_live(tables: str) -> str:
    """Whether composed tables depend on what came before or leave a phrase open."""
    return f"exists({tables}, t -> exists(t, e -> e.to <> 0 OR e.n <> t[0].n))"


def phrase_hits(tables: str, positions: Iterable[int]) -> str:
    """Matches counted from the start of the text for the phrases at ``positions``."""
    return _sum(f"coalesce({tables}[{p}][0].n, 0L)" for p in positions)
