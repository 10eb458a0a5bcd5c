"""Language identification, words first.

A known word scores by its log frequency in each language.  An unseen word falls back
to its character n-grams, the longest first; where no n-gram of a length is known at a
place, the next shorter one is tried there.  Frequencies are counted by Spark over a
bounded sample of the labelled rows, even over the languages; the model keeps the most
frequent words and n-grams of each language, so it is small and travels with the task.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.llm.shared import stored

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageRules:
    """Bounds of the model: labelled rows it is fitted on, and entries it keeps over all languages."""

    docs_per_language: int = 4000
    words: int = 80_000
    grams: int = 16_000  # of each length
    longest_gram: int = 4
    smoothing: float = 0.5
    # Unseen words say less than known ones.
    backoff_weight: float = 0.5


# Python's \w also holds numerals that are no decimal digits, such as a half; a class that lists them all is slow.
WORD = re.compile(r"[^\W\d_]+")
_NOT_LETTERS = {i: " " for i in range(128) if not chr(i).isalpha()}
WORD_SQL = r"\p{L}+"


def words_of(text: str) -> list[str]:
    """Letters of any script in a row, in the order of the text."""
    if text.isascii():
        return text.translate(_NOT_LETTERS).split()
    runs = WORD.findall(text)
    if "".join(runs).isalpha():
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


@dataclass
class LanguageModel:
    """Log probabilities per language: one row per known word or n-gram."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    word_scores: np.ndarray | None = None
    grams: dict[str, int] = field(default_factory=dict)
    gram_scores: np.ndarray | None = None
    rules: LanguageRules = field(default_factory=LanguageRules)


# ---- learning


def training_sample(df: DataFrame, rules: LanguageRules, id_column: str, text_column: str, lang_column: str) -> DataFrame:
    """(lang, text) of about ``docs_per_language`` rows of each language, chosen by a hash of id and text,
    so that an id of very many rows is neither taken whole nor left out whole."""
    labelled = df.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(lang_column).alias("lang")
    ).filter("lang IS NOT NULL AND text IS NOT NULL")
    # One count per language; texts are chosen where they are read and do not move.
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    shares = [F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, rules.docs_per_language / n))]
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = place < F.create_map(*shares)[F.col("lang")] if shares else F.lit(False)
    return labelled.filter(chosen).select("lang", "text")


def entry_counts(sample: DataFrame, rules: LanguageRules) -> DataFrame:
    """(length, entry, lang, n, total): length 0 for words, else of the n-gram; total is the language's sum at that length."""
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD_SQL), F.lit(0))).alias("word"))
    counted = stored(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    framed = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    lengths = range(1, rules.longest_gram + 1)
    grams = F.flatten(F.array(*(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(framed) - size + 1, F.lit(1))),
            lambda at, size=size: F.struct(F.lit(size).alias("length"), F.substring(framed, at, F.lit(size)).alias("entry")),
        )
        for size in lengths
    )))
    exploded = counted.select("lang", "n", F.explode(grams).alias("g")).select("lang", "n", "g.*")
    exploded = exploded.filter(F.length("entry") == F.col("length"))
    entries = (
        counted.select("lang", F.lit(0).alias("length"), F.col("word").alias("entry"), "n")
        .unionByName(exploded)
        .groupBy("lang", "length", "entry")
        .agg(F.sum("n").alias("n"))
    )
    return stored(entries, "entries")


def learn(
    df: DataFrame,
    rules: LanguageRules = LanguageRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """A model from the rows with a language; without such rows a model that knows no language."""
    entries = entry_counts(training_sample(df, rules, id_column, text_column, lang_column), rules)
    totals = {(r["lang"], r["length"]): r["n"] for r in entries.groupBy("lang", "length").agg(F.sum("n").alias("n")).collect()}
    # Every language keeps the same number of entries.
    languages = max(1, len({lang for lang, _ in totals}))
    words, grams = max(1, rules.words // languages), max(1, rules.grams // languages)
    best = Window.partitionBy("lang", "length").orderBy(F.desc("n"), "entry")
    ranked = entries.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= max(words, grams))
    kept = ranked.filter(F.col("_rank") <= F.when(F.col("length") == 0, words).otherwise(grams))
    # What one language keeps is counted in the others too.
    chosen = kept.select("length", "entry").distinct()
    counted = entries.join(chosen, ["length", "entry"]).groupBy("length", "entry")
    # Bounded by the rules; Arrow keeps them small on the driver.
    table = counted.agg(F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("counts")).toArrow()
    table = table.sort_by([("length", "ascending"), ("entry", "ascending")])
    return build_model(_entries(table), totals, rules)


def _entries(table: pa.Table):
    """(length, entry, [(lang, n), ...]) one after the other."""
    for batch in table.to_batches(max_chunksize=4096):
        lengths, entries, counts = (batch.column(n).to_pylist() for n in ("length", "entry", "counts"))
        for length, entry, found in zip(lengths, entries, counts):
            yield length, entry, [(c["lang"], c["n"]) for c in found]


def build_model(rows, totals: dict[tuple[str, int], int], rules: LanguageRules) -> LanguageModel:
    languages = sorted({lang for lang, _ in totals})
    place = {lang: i for i, lang in enumerate(languages)}
    model = LanguageModel(languages, rules=rules)
    lists: dict[bool, list[list[float]]] = {True: [], False: []}
    sums: dict[int, list[float]] = {}
    for length, entry, counts in rows:
        if length not in sums:
            sums[length] = [float(totals.get((lang, length), 0)) for lang in languages]
        found = [0.0] * len(languages)
        for lang, n in counts:
            found[place[lang]] = float(n)
        space = rules.words if length == 0 else rules.grams
        scores = [
            math.log((n + rules.smoothing) / (total + rules.smoothing * space)) for n, total in zip(found, sums[length])
        ]
        (model.words if length == 0 else model.grams)[entry] = len(lists[length == 0])
        lists[length == 0].append(scores)
    model.word_scores = np.array(lists[True]).reshape(len(lists[True]), len(languages))
    model.gram_scores = np.array(lists[False]).reshape(len(lists[False]), len(languages))
    return model


# ---- scoring


class Scorer:
    """Scores texts; keeps the scores of at most ``cache_words`` unseen words, or of words of ``cache_chars`` characters."""

    def __init__(self, model: LanguageModel, cache_words: int = 200_000, cache_chars: int = 8 << 20):
        self.model = model
        self.cache_chars, self.chars = cache_chars, 0
        self.rows = dict(model.words)
        self.scores = np.concatenate([model.word_scores, np.zeros((cache_words, len(model.languages)))])
        self.known = self.used = len(model.words)

    def backoff(self, word: str) -> np.ndarray:
        """Mean over the word's places of the longest known n-gram there, weighted less than a known word."""
        framed, grams = f"^{word}$", self.model.grams
        longest = self.model.rules.longest_gram
        found = []
        for at in range(len(framed)):
            for size in range(min(longest, len(framed) - at), 0, -1):
                row = grams.get(framed[at : at + size])
                if row is not None:
                    found.append(row)
                    break
        if not found:
            return np.zeros(len(self.model.languages))
        return self.model.rules.backoff_weight * self.model.gram_scores[found].mean(axis=0)

    def _forget(self) -> None:
        self.rows, self.used, self.chars = dict(self.model.words), self.known, 0

    def _row(self, word: str) -> int:
        row = self.rows.get(word)
        if row is None:
            if self.used == len(self.scores):
                self._forget()
            row = self.rows[word] = self.used
            self.chars += len(word)
            self.scores[row] = self.backoff(word)
            self.used += 1
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, probability); no letter, or no language learned, gives ``und`` and 0."""
        words = Counter(words_of(text.lower())) if text else None
        if not words or not self.model.languages:
            return UNDETERMINED, 0.0
        if self.used + len(words) > len(self.scores) or self.chars > self.cache_chars:
            # Room for all words of this text at once, or one by one where even that is too little.
            self._forget()
        counts = np.fromiter(words.values(), float, len(words))
        if len(words) <= len(self.scores) - self.used:
            rows = list(map(self.rows.get, words))
            if None in rows:
                rows = [self._row(w) if r is None else r for w, r in zip(words, rows)]
            sums = counts @ self.scores[rows]
        else:
            sums = sum(c * self.scores[self._row(w)] for w, c in zip(words, counts))
        best = int(np.argmax(sums))
        return self.model.languages[best], float(1 / np.exp(sums - sums[best]).sum())


def identify(df: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: (id, lang_pred, score).

    Only the text is looked at.  A null text, or one without a letter, is ``und`` with
    score 0.  Languages that score alike go to the first by name.  Equal rows give equal
    rows; other columns are left out; an empty table gives an empty result.
    """
    schema = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column(1).to_pylist()]
            columns = (pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    asked = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    return asked.mapInArrow(run, "id bigint, lang_pred string, score double").withColumnRenamed("id", id_column)


def keep_identified(df: DataFrame, model: LanguageModel, min_score: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows whose language is told with at least ``min_score``, all columns kept."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for texts in batches:
            found = (scorer.predict(t) for t in texts.to_pylist())
            yield pa.array([lang != UNDETERMINED and score >= min_score for lang, score in found], pa.bool_())

    return df.filter(told(F.col(text_column).cast("string")))
