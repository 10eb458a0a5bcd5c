"""Quality classification by co-training of two views.

One classifier sees only the text's content, the other only what stands beside it
(source, language, stated size).  Both start from the labelled rows; in every round each
hands its most confident pseudo-labels on unlabelled rows to the other.  Both views are
then calibrated on labelled rows that neither was trained on, and a last logistic
regression combines the calibrated views.  Fitting uses bounded samples; scoring covers
every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.shared import one_row_each, pair_slices


@dataclass(frozen=True)
class QualityModelRules:
    """Bounds and settings of the fit."""

    labelled_rows: int = 8_000  # at most about so many labelled rows are used
    unlabelled_rows: int = 4_000  # and so many rows without label
    rounds: int = 4
    per_round: int = 400  # pseudo-labels a view may hand over in a round, and at most a tenth of the labels
    least_proof: int = 5  # held-out rows of a class a view must be sure of before it hands over labels
    confidence: float = 0.95
    ridge: float = 1.0
    keep_at: float = 0.5


# ---- the text view: shares of character classes and of pairs of neighbours, and a few ratios

CLASSES = 16
CLASS_NAMES = ("lower", "upper", "digit", "blank", "line", "other letter", "other")
MARK_CLASSES = CLASSES - len(CLASS_NAMES)
TEXT_FEATURES = CLASSES + CLASSES * CLASSES + 8


def _class_table() -> np.ndarray:
    """Classes of code points below 128; every mark has a class by the rule code mod 9."""
    table = np.full(128, 6, np.uint8)
    for point in range(128):
        char = chr(point)
        if char.islower():
            table[point] = 0
        elif char.isupper():
            table[point] = 1
        elif char.isdigit():
            table[point] = 2
        elif char in " \t":
            table[point] = 3
        elif char in "\r\n":
            table[point] = 4
        elif 32 < point < 127:
            table[point] = len(CLASS_NAMES) + point % MARK_CLASSES
    return table


_TABLE = _class_table()


def text_features(texts: list[str]) -> np.ndarray:
    """One row per text; an empty text has zeros throughout."""
    out = np.zeros((len(texts), TEXT_FEATURES), np.float32)
    for first, last in pair_slices(texts):
        for i in range(first, last):
            out[i] = _one_text(texts[i])
    return out


def _one_text(text: str) -> np.ndarray:
    row = np.zeros(TEXT_FEATURES, np.float32)
    if not text:
        return row
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    # Letters beyond ASCII count as lower or upper case where they have one.
    classes = _TABLE[np.minimum(points, 127)].astype(np.int64)
    beyond = np.flatnonzero(points > 127)
    if beyond.size:
        kinds, which = np.unique(points[beyond], return_inverse=True)
        table = [0 if c.islower() else 1 if c.isupper() else 5 if c.isalpha() else 6 for c in map(chr, kinds.tolist())]
        classes[beyond] = np.array(table)[which]
    size = len(classes)
    row[:CLASSES] = np.bincount(classes, minlength=CLASSES) / size
    pairs = classes[:-1] * CLASSES + classes[1:]
    row[CLASSES : CLASSES + CLASSES * CLASSES] = np.sqrt(np.bincount(pairs, minlength=CLASSES * CLASSES) / size)
    words = text.split()
    if words:
        distinct = len(set(words))
        repeats = sum(a == b for a, b in zip(words, words[1:]))
        lines = text.split("\n")
        row[-8:] = (
            distinct / len(words),
            repeats / len(words),
            min(len(words) / distinct, 20) / 20,
            min(size / len(words), 40) / 40,
            min(max(map(len, words)), 100) / 100,
            len(set(lines)) / len(lines),
            min(len(words) / len(lines), 200) / 200,
            np.log1p(len(words)) / 12,
        )
    return row


# ---- the metadata view

META_BUCKETS = 64
META_FEATURES = META_BUCKETS + 4


def meta_features(sources: list, langs: list, sizes: list) -> np.ndarray:
    """Hashed source and language, and the stated size; nulls are values of their own."""
    import xxhash

    out = np.zeros((len(sources), META_FEATURES), np.float32)
    for i, (source, lang, size) in enumerate(zip(sources, langs, sizes)):
        for name, value in (("source", source), ("lang", lang)):
            out[i, xxhash.xxh64_intdigest(f"{name}={value}") % META_BUCKETS] += 1
        known = size is not None and size >= 0
        log = np.log1p(float(size)) / 12 if known else 0.0
        out[i, META_BUCKETS:] = (known, log, log * log, log < 0.4)
    return out


# ---- logistic regression


@dataclass
class Logistic:
    """Weights over centred and scaled features."""

    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def odds(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 12) -> Logistic:
    """Newton's method with a ridge; one class alone gives its smoothed share as a constant."""
    x = x.astype(np.float64)
    mean = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    spread = x.std(axis=0) if len(x) else np.ones(x.shape[1])
    scale = np.where(spread > 1e-6, spread, 1.0)
    share = (y.sum() + 1) / (len(y) + 2)
    weights, bias = np.zeros(x.shape[1]), float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Logistic(weights, bias, mean, scale)
    design = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    beta = np.append(weights, bias)
    penalty = np.full(len(beta), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = _sigmoid(design @ beta)
        gradient = design.T @ (p - y) + penalty * beta
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(beta[:-1], float(beta[-1]), mean, scale)


# ---- co-training


@dataclass
class QualityModel:
    text: Logistic
    meta: Logistic
    text_calibration: tuple[float, float] = (1.0, 0.0)
    meta_calibration: tuple[float, float] = (1.0, 0.0)
    combine: tuple[float, float, float] = (1.0, 0.0, 0.0)  # of the text logit, the metadata logit, and a constant
    exchanged: list[tuple[int, int]] = field(default_factory=list)

    def views(self, x_text: np.ndarray, x_meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated logits of both views."""
        (a, b), (c, d) = self.text_calibration, self.meta_calibration
        return a * self.text.logits(x_text) + b, c * self.meta.logits(x_meta) + d

    def score(self, x_text: np.ndarray, x_meta: np.ndarray) -> np.ndarray:
        text, meta = self.views(x_text, x_meta)
        a, b, c = self.combine
        return _sigmoid(a * text + b * meta + c)


def _confident(
    model: Logistic, x: np.ndarray, free: np.ndarray, held_x: np.ndarray, held_y: np.ndarray, room: int, rules: QualityModelRules
) -> tuple[np.ndarray, np.ndarray]:
    """(rows, labels) of the surest free rows of each class.

    A view speaks for a class only when held-out rows it is as sure of bear it out; a
    view that says no more than the usual share hands over nothing.
    """
    odds, held_odds = model.odds(x), model.odds(held_x)
    rows, labels = [np.zeros(0, int)], [np.zeros(0, int)]
    for label, sure, held_sure in ((1, odds, held_odds), (0, 1 - odds, 1 - held_odds)):
        proof = held_y[held_sure >= rules.confidence] == label
        if len(proof) < rules.least_proof or proof.mean() < rules.confidence:
            continue
        at = np.flatnonzero(free & (sure >= rules.confidence))
        share = (held_y == label).mean()
        chosen = at[np.argsort(-sure[at], kind="stable")][: max(1, int(room * share))]
        rows.append(chosen)
        labels.append(np.full(len(chosen), label))
    return np.concatenate(rows), np.concatenate(labels)


def co_train(
    text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, free_text: np.ndarray, free_meta: np.ndarray,
    rules: QualityModelRules = QualityModelRules(),
) -> QualityModel:
    """Fits both views on labelled rows (not ``held``) and on what they hand each other; calibrates on ``held``."""
    fit = ~held if (~held).any() else held
    given = {"text": (np.zeros(0, int), np.zeros(0)), "meta": (np.zeros(0, int), np.zeros(0))}
    exchanged = []

    def fitted(labelled: np.ndarray, pool: np.ndarray, name: str) -> Logistic:
        rows, labels = given[name]
        return fit_logistic(np.vstack([labelled[fit], pool[rows]]), np.append(y[fit], labels), rules.ridge)

    check = held if held.any() else fit
    room = max(1, min(rules.per_round, int(fit.sum()) // 10))
    by_text, by_meta = fitted(text, free_text, "text"), fitted(meta, free_meta, "meta")
    for _ in range(rules.rounds):
        free = [~np.isin(np.arange(len(free_text)), given[name][0]) for name in ("meta", "text")]
        for_meta = _confident(by_text, free_text, free[0], text[check], y[check], room, rules)
        for_text = _confident(by_meta, free_meta, free[1], meta[check], y[check], room, rules)
        exchanged.append((len(for_text[0]), len(for_meta[0])))
        if not len(for_meta[0]) and not len(for_text[0]):
            break
        for name, (rows, labels) in (("meta", for_meta), ("text", for_text)):
            given[name] = (np.append(given[name][0], rows), np.append(given[name][1], labels))
        by_text, by_meta = fitted(text, free_text, "text"), fitted(meta, free_meta, "meta")
    model = QualityModel(by_text, by_meta, exchanged=exchanged)
    model.text_calibration = _calibrated(by_text.logits(text[check]), y[check])
    model.meta_calibration = _calibrated(by_meta.logits(meta[check]), y[check])
    views = np.stack(model.views(text[check], meta[check]), axis=1)
    both = fit_logistic(views, y[check], 1.0)
    slopes = both.weights / both.scale
    model.combine = (*(float(s) for s in slopes), float(both.bias - (slopes * both.mean).sum()))
    return model


def _calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt scaling."""
    found = fit_logistic(np.clip(logits, -30, 30)[:, None], y, 1.0)
    slope = float(found.weights[0] / found.scale[0])
    return slope, float(found.bias - slope * found.mean[0])


# ---- as Spark jobs


def _share(limit: int, rows: int, *salt: int):
    """Predicate on doc_id that about ``limit`` of ``rows`` ids fulfil."""
    part = int(min(1.0, limit / max(rows, 1)) * (1 << 30))
    return F.pmod(F.xxhash64("doc_id", *(F.lit(s) for s in salt)), F.lit(1 << 30)) < part


def learn(docs: DataFrame, labels: DataFrame, rules: QualityModelRules = QualityModelRules()) -> QualityModel:
    """A model from bounded samples of ``docs`` (doc_id, text, lang, source, n_chars) and ``labels`` (doc_id, quality).

    A document with several labels counts as good when most are good, as bad on a tie.
    Labels other than 0 and 1 are left out.  Without labels every text scores one half.
    Of rows that share an id one is fitted on, so that the samples are bounded whatever ids repeat.
    """
    clean = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("mean"))
    clean = clean.select("doc_id", (F.col("mean") > 0.5).cast("int").alias("quality"))
    columns = ("text", "lang", "source", "n_chars")
    wanted = docs.select("doc_id", *columns).filter("doc_id IS NOT NULL")
    # Rows are chosen by their ids before texts move.
    known, free = _share(rules.labelled_rows, clean.count()), _share(rules.unlabelled_rows, wanted.count(), 1)
    labelled = one_row_each(wanted.filter(known).join(clean.filter(known).select("doc_id"), "doc_id", "left_semi"), "doc_id", *columns)
    labelled = labelled.join(clean.filter(known), "doc_id")
    unlabelled = one_row_each(wanted.filter(free).join(clean.filter(free), "doc_id", "left_anti"), "doc_id", *columns)
    unlabelled = unlabelled.withColumn("quality", F.lit(None).cast("int"))
    found = labelled.unionByName(unlabelled).mapInArrow(_featured, FEATURED).collect()
    # In one order whatever the partitions were, so that a rerun fits the same model.
    found.sort(key=lambda r: (r["doc_id"], bytes(r["text_x"])))
    text = np.array([np.frombuffer(r["text_x"], "<f4") for r in found], np.float32).reshape(-1, TEXT_FEATURES)
    meta = np.array([np.frombuffer(r["meta_x"], "<f4") for r in found], np.float32).reshape(-1, META_FEATURES)
    known = np.array([r["quality"] is not None for r in found], bool)
    y = np.array([r["quality"] for r in found if r["quality"] is not None], float)
    held = np.array([r["fold"] == 0 for r in found], bool)[known]
    return co_train(text[known], meta[known], y, held, text[~known], meta[~known], rules)


FEATURED = "doc_id bigint, quality int, fold int, text_x binary, meta_x binary"


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    columns = {n: batch.column(n).to_pylist() for n in ("text", "source", "lang", "n_chars")}
    texts = [t or "" for t in columns["text"]]
    return text_features(texts), meta_features(columns["source"], columns["lang"], columns["n_chars"])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        text, meta = _features(batch)
        ids = batch.column("doc_id").to_pylist()
        folds = [xxhash.xxh64_intdigest(str(i), 7) % 5 for i in ids]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("quality"), pa.array(folds, pa.int32()),
                pa.array([r.tobytes() for r in text], pa.binary()), pa.array([r.tobytes() for r in meta], pa.binary()),
            ],
            ["doc_id", "quality", "fold", "text_x", "meta_x"],
        )


def score_documents(docs: DataFrame, model: QualityModel, keep_at: float = 0.5) -> DataFrame:
    """One row per input row: (doc_id, text_score, meta_score, score, accepted).

    Scores are probabilities of good quality: of each calibrated view, and combined.
    A null text counts as empty; null metadata are values of their own.  Equal rows give
    equal rows; columns other than those of ``documents`` are left out; an empty table
    gives an empty result.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), *((n, pa.float64()) for n in ("text_score", "meta_score", "score")), ("accepted", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, meta = _features(batch)
            by_text, by_meta = model.views(text, meta)
            scores = model.score(text, meta)
            arrays = [pa.array(np.asarray(a, float)) for a in (_sigmoid(by_text), _sigmoid(by_meta), scores)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays, pa.array(scores >= keep_at)], schema=schema)

    asked = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *(F.col(n).cast("string").alias(n) for n in ("text", "lang", "source")),
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )
    return asked.mapInArrow(run, "doc_id bigint, text_score double, meta_score double, score double, accepted boolean")


def keep_accepted(docs: DataFrame, model: QualityModel, keep_at: float = 0.5) -> DataFrame:
    """The rows whose score is at least ``keep_at``, all columns kept."""

    @F.arrow_udf("boolean")
    def accepted(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text, lang, source, n_chars], ["text", "lang", "source", "n_chars"])
        return pa.array(model.score(*_features(batch)) >= keep_at)

    columns = [*(F.col(n).cast("string") for n in ("text", "lang", "source")), F.col("n_chars").cast("bigint")]
    return docs.filter(accepted(*columns))
