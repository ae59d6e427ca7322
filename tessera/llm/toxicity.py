"""Toxicity categories by a classifier chain.

The categories are predicted one after the other by linear (logistic) models;
each model sees the text's features and the probabilities of all earlier
categories.  For training, those probabilities are out-of-fold predictions, so
a later model learns from errors of the kind it will meet.

Features are character n-grams of words (with word borders) that tell the
categories apart in the learning sample; a feature's value is its share of the
words, saturating at one in ``1 / GAIN`` words, so long texts do not gather
features by length alone.
"""

from __future__ import annotations

import re
from itertools import chain as _chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

# The chain: category -> SQL condition on the labels.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"), ("toxic_low_quality", "toxic = 1 and quality = 0"))
POSITIVE, NEGATIVE = 1200, 2400     # learning sample: toxic and other labelled rows
LONGEST = 50_000                    # characters of a text of the sample
FEATURES = 400                      # n-grams chosen for each category
SPANS = (3, 4, 5, 6)                # characters of an n-gram
GAIN = 50.0
FOLDS = 5
RIDGE = 1e-4
ROUNDS = 200                        # gradient steps
THRESHOLD = 0.5
KEPT_WORDS = 1 << 19                # words whose features are kept in a task

_WORD = re.compile(r"[^\W\d_]+")


def word_grams(word: str) -> set[str]:
    s = f"<{word}>"
    return {s[i:i + n] for n in SPANS for i in range(len(s) - n + 1)}


class WordFeatures(dict):
    """Word -> numbers of the chosen n-grams in it; filled on demand, emptied when full."""

    def __init__(self, chosen: list[str]):
        super().__init__()
        self.number = {g: i for i, g in enumerate(chosen)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.number[g] for g in word_grams(word) if g in self.number)
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> np.ndarray:
        words = _WORD.findall(text.lower()) if text else []
        counts = np.bincount(np.fromiter(_chain.from_iterable(map(self.__getitem__, words)), np.int64), minlength=len(self.number))
        return np.minimum(1.0, GAIN * counts / max(1, len(words)))


def choose(texts: list[str], targets: np.ndarray, n: int = FEATURES) -> list[str]:
    """For each category the n-grams whose presence has the largest chi-square with it (ties: in order of the n-gram)."""
    number: dict[str, int] = {}
    of_word: dict[str, np.ndarray] = {}

    def grams(word: str) -> np.ndarray:
        if word not in of_word:
            of_word[word] = np.array([number.setdefault(g, len(number)) for g in word_grams(word)], np.int32)
        return of_word[word]
    none = np.zeros(0, np.int32)
    sets = [np.unique(np.concatenate([none, *map(grams, set(_WORD.findall(t.lower())))])) if t else none for t in texts]
    of_word.clear()

    def rows_with(picked) -> np.ndarray:
        return np.bincount(np.concatenate([none, *picked]), minlength=len(number)).astype(float)
    names, have, rows = list(number), rows_with(sets), len(texts)
    frequent = np.flatnonzero(have >= 3)
    chosen: set[str] = set()
    for y in targets.T:
        both, pos = rows_with([s for s, t in zip(sets, y) if t]), y.sum()
        spread = have * (rows - have) * pos * (rows - pos)
        chi = np.divide((both * rows - have * pos) ** 2 * rows, spread, out=np.zeros_like(both), where=spread > 0)
        chosen.update(names[i] for i in sorted(frequent.tolist(), key=lambda i: (-chi[i], names[i]))[:n])
    return sorted(chosen)


def _logit(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(30):                                     # power iteration: the largest curvature bounds the step
        v = x.T @ (x @ v)
        v /= max(float(np.linalg.norm(v)), 1e-12)
    step = 4.0 / (1.1 * float(np.linalg.norm(x @ v)) ** 2 / max(1, len(x)) + 4 * RIDGE)
    y, w, ahead = y.astype(x.dtype), np.zeros(x.shape[1], x.dtype), np.zeros(x.shape[1], x.dtype)
    for k in range(ROUNDS):
        new = ahead - step * (x.T @ (_logit(x @ ahead) - y) / len(x) + RIDGE * ahead)
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def fit_chain(x: np.ndarray, targets: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """One weight vector per category; row i's earlier probabilities come from models that did not see its fold."""
    models, so_far = [], x
    for y in targets.T:
        out = np.zeros(len(x))
        for f in np.unique(folds):
            away = folds != f
            w = fit_linear(so_far[away], y[away]) if away.any() else np.zeros(so_far.shape[1] + 1)
            out[~away] = _logit(so_far[~away] @ w[:-1] + w[-1])
        models.append(fit_linear(so_far, y))
        so_far = np.column_stack([so_far, out.astype(so_far.dtype)])
    return models


def run_chain(x: np.ndarray, models: list[np.ndarray]) -> np.ndarray:
    """Probabilities, a column per category."""
    for w in models:
        x = np.column_stack([x, _logit(x @ w[:-1] + w[-1])])
    return x[:, x.shape[1] - len(models):]


def learning_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``POSITIVE`` toxic and ``NEGATIVE`` other labelled documents, by a hash of the id: text, targets, fold.

    Of rows that repeat a doc_id one text (the first in order) is learned from.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), *(F.expr(c).alias(n) for n, c in CATEGORIES))
    known = known.where(" and ".join(["id is not null", *(f"{n} is not null" for n, _ in CATEGORIES)])).dropDuplicates(["id"])
    known = checkpointed(known)

    def first(rows: DataFrame, n: int) -> DataFrame:        # every task hands on at most n rows
        return rows.orderBy(F.xxhash64("id"), "id").limit(n)
    known = first(known.where("toxic"), POSITIVE).unionByName(first(known.where("not toxic"), NEGATIVE))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.length("text") <= LONGEST)
    one = texts.join(F.broadcast(known), "id").groupBy("id", *(n for n, _ in CATEGORIES)).agg(F.min("text").alias("text"))
    return one.withColumn("fold", F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)))


def fit(docs: DataFrame, labels: DataFrame) -> dict | None:
    """The chain, learned on a bounded sample; None if no labelled document has a text."""
    rows = learning_sample(docs, labels).select("id", "text", "fold", *(n for n, _ in CATEGORIES)).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: r["id"])
    texts = [r["text"] for r in rows]
    targets = np.array([[r[n] for n, _ in CATEGORIES] for r in rows], dtype=float)
    chosen = choose(texts, targets)
    features = WordFeatures(chosen)
    x = np.array([features.of(t).astype(np.float32) for t in texts]).reshape(len(texts), len(chosen))
    return {"chosen": chosen, "models": fit_chain(x, targets, np.array([r["fold"] for r in rows]))}


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, p_<category>..., toxic`` for every row.

    Null and empty texts have no features and get the models' base rates;
    without a model all probabilities are null and nothing is toxic.
    """
    names = [n for n, _ in CATEGORIES]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = SimpleNamespace(**shared.value) if shared.value else None
        features = WordFeatures(m.chosen) if m else None
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                if m:
                    x = np.array([features.of(t) for t in part.column(1).to_pylist()])
                    columns = [pa.array(np.round(p, 6)) for p in run_chain(x, m.models).T]
                else:
                    columns = [pa.nulls(part.num_rows, pa.float64()) for _ in names]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *(f"p_{n}" for n in names)])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, ", ".join(["doc_id long", *(f"p_{n} double" for n in names)]))
    return out.withColumn("toxic", F.coalesce(F.col("p_toxic") >= THRESHOLD, F.lit(False)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from ``labels`` (doc_id, quality, toxic; rows with a null are not used) and score every row of ``docs``."""
    return score(docs, fit(docs, labels))
