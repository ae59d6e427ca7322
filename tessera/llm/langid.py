"""Language identification with a blended-spectrum string kernel.

Two texts are as alike as the distinct character n-grams (n = 1..3) that both
have: ``k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|)`` (presence kernel).
Nystroem landmarks turn the kernel into a few hundred features, one-versus-rest
ridge regression on them gives a score per language, and texts are scored in
batches by two matrix products: presence against landmarks, then weights.

The regression values of the languages add up to 1, so the winner's is never
low: whether a text is in a learned language at all is judged by the share of
its 3-grams, repeats included, that the learning sample of some language has.
That share does not fall with the length of a text as one of distinct 3-grams
would: few of a long text's rare 3-grams are known, but they stay few.  Only the
languages that the regression finds likely count.

n-grams are taken of lower-case letters; every run of other characters is one
gap.  Letters beyond the ``LETTERS`` most frequent ones of the learning sample
share one code.
"""

from __future__ import annotations

from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
SPECTRUM = 3                # longest n-gram
LETTERS = 126               # letters with a code of their own (code 0: gap, LETTERS + 1: any other letter)
BITS = 7                    # bits of a code
PER_LANGUAGE = 160          # learning sample: documents of each language
LANDMARKS = 32              # of these, landmarks of each language
LONG_TEXT = 20_000          # characters; longer texts are learned from only if a language has too few others
RIDGE = 1e-3
MIN_SHARE = 0.54            # share of a text's 3-grams that some language has; below: none of the learned languages
SLACK = 0.9                 # with few texts of a language: of the share that 95% of them reach without themselves
FLOOR = 0.2                 # however few: random letters have up to 0.2
LIKELY = 0.5                # of the winner's regression value: languages with less are not the text's
BATCH = 256                 # texts of one matrix product
PIECE = 1 << 20             # characters of a text that are looked at a time


def _offsets() -> list[int]:
    sizes = [1 << (BITS * n) for n in range(1, SPECTRUM + 1)]
    return [sum(sizes[:n]) for n in range(SPECTRUM + 1)]


class Grams:
    """Distinct n-grams of texts, with one table that is never cleared between texts.

    With ``watched`` n-grams, ``self.heard`` is how often the last text has each of
    them, by length (row 0: n-grams of one character; column 0: any other n-gram).
    """

    def __init__(self, letters: str, watched: np.ndarray | None = None):
        points = np.arange(0x110000)
        is_letter = np.array([chr(p).isalpha() for p in range(0x110000)])
        self.code = np.where(is_letter, LETTERS + 1, 0).astype(np.int32)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        del points
        self.offsets = _offsets()
        self.seen = np.full(self.offsets[-1], -1, dtype=np.int64)
        self.clock = 0
        self.counts = np.zeros(SPECTRUM)
        self.slots, self.heard = None, None
        if watched is not None:
            self.slots = np.zeros(self.offsets[-1], np.int32)
            self.slots[watched] = np.arange(1, len(watched) + 1)
            self.heard = np.zeros((SPECTRUM, len(watched) + 1), np.int64)

    def of(self, text: str) -> tuple[int, bool]:
        """Number of distinct n-grams (``self.counts``: of each length), and whether there is a letter; marks them as seen
        since ``self.begun``."""
        self.begun, any_letter, tail = self.clock, False, np.zeros(1, np.int32)
        self.counts = np.zeros(SPECTRUM)
        if self.heard is not None:
            self.heard[:] = 0
        for at in range(0, len(text), PIECE):
            codes = self.code[np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
            any_letter = any_letter or bool(codes.any())
            codes = np.concatenate([tail, codes])
            codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
            self._mark(codes)
            tail = codes[-(SPECTRUM - 1):]
        return int(self.counts.sum()), any_letter

    def _mark(self, codes: np.ndarray) -> None:
        gram = codes.astype(np.int64)
        for n in range(SPECTRUM):
            if n:
                gram = (gram[:-1] << BITS) | codes[n:]
            places = gram + self.offsets[n]
            if self.heard is not None:
                self.heard[n] += np.bincount(self.slots[places], minlength=self.heard.shape[1])
            places = places[self.seen[places] < self.begun]
            stamps = np.arange(self.clock, self.clock + len(places))
            self.seen[places] = stamps
            self.counts[n] += (self.seen[places] == stamps).sum()
            self.clock += len(places)

    def have(self, vocabulary: np.ndarray) -> np.ndarray:
        """Which n-grams of ``vocabulary`` the last text has."""
        return self.seen[vocabulary] >= self.begun

    def marked(self) -> np.ndarray:
        return np.flatnonzero(self.seen >= self.begun)


@dataclass
class Model:
    languages: list[str]
    letters: str
    vocabulary: np.ndarray      # n-grams of the landmarks
    landmarks: np.ndarray       # presence of each in each landmark (vocabulary x landmarks)
    sizes: np.ndarray           # distinct n-grams of each landmark
    weights: np.ndarray         # kernel values -> score per language
    bias: np.ndarray


@dataclass
class Known:
    """What the learning sample knows of each language."""
    grams: np.ndarray           # n-grams of all texts of the sample
    owned: np.ndarray           # which of them each language has (languages x grams)
    least: np.ndarray           # by language: share of its 3-grams that a text in it has at least


def kernel(presence: np.ndarray, counts: np.ndarray, landmarks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    shared = (presence @ landmarks).astype(np.float64)
    return shared / np.sqrt(np.maximum(counts, 1)[:, None] * np.maximum(sizes, 1)[None, :])


def fit(texts: list[str], labels: list[str], per_language: int = LANDMARKS) -> Model:
    """Fit on a bounded sample; the first ``per_language`` texts of each language are the landmarks."""
    languages = sorted(set(labels))
    found: dict[str, int] = {}
    for t in texts:
        for c in t.lower():
            found[c] = found.get(c, 0) + 1
    letters = "".join(sorted((c for c in found if c.isalpha()), key=lambda c: (-found[c], c))[:LETTERS])
    taken: dict[str, int] = {}
    chosen = []
    for i, lang in enumerate(labels):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= per_language:
            chosen.append(i)
    grams = Grams(letters)
    sets = []
    for i in chosen:
        grams.of(texts[i])
        sets.append(grams.marked())
    vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
    landmarks = np.zeros((len(vocabulary), len(chosen)), np.float32)
    for k, s in enumerate(sets):
        landmarks[np.searchsorted(vocabulary, s), k] = 1
    sizes = landmarks.sum(axis=0).astype(np.float64)
    rows, counts = _presence(grams, texts, vocabulary)
    k_nm = kernel(rows, counts, landmarks, sizes)
    k_mm = k_nm[chosen]
    values, vectors = np.linalg.eigh((k_mm + k_mm.T) / 2)
    usable = values > 1e-9 * max(values.max(), 1e-12)
    root = vectors[:, usable] / np.sqrt(values[usable])
    features = k_nm @ root
    target = np.array([[lab == lang for lang in languages] for lab in labels], dtype=np.float64)
    mean_x, bias = features.mean(axis=0), target.mean(axis=0)
    centred = features - mean_x
    inner = np.linalg.solve(centred.T @ centred + RIDGE * len(texts) * np.eye(centred.shape[1]), centred.T @ (target - bias))
    return Model(languages, letters, vocabulary, landmarks, sizes, root @ inner, bias - mean_x @ inner)


def _presence(grams: Grams, texts: list[str], vocabulary: np.ndarray, heard: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    rows, counts = np.zeros((len(texts), len(vocabulary)), np.float32), np.zeros(len(texts))
    for i, t in enumerate(texts):
        counts[i], _ = grams.of(t)
        rows[i] = grams.have(vocabulary)
        if heard is not None:
            heard.append(_longest(grams))
    return rows, counts


def _longest(grams: Grams) -> np.ndarray:
    """How often the last text has each watched n-gram of the longest length it has (3 unless it is too short)."""
    return grams.heard[int(np.flatnonzero(grams.counts)[-1]) if grams.counts.any() else 0].copy()


def _shares(heard: np.ndarray, owned: np.ndarray) -> list[float]:
    """The share of the n-grams heard that each language (a row of ``owned``) has."""
    return [float(heard[1:][one].sum() / max(1, heard.sum())) for one in owned]


def know(model: Model, texts: list[str], labels: list[str]) -> Known:
    """The n-grams of each language in the whole learning sample, and the least share of them that a text in it has:
    ``MIN_SHARE``, or less (never under ``FLOOR``) for a language of which the sample has several texts but too few to
    know most n-grams of each other. One language's few texts lower no other's share, and a lone text, which has no
    others, not its own."""
    plain, sets = Grams(model.letters), []
    for t in texts:
        plain.of(t)
        sets.append(plain.marked())
    grams = np.unique(np.concatenate(sets))
    number = np.zeros((len(model.languages), len(grams)), np.int32)      # texts that have an n-gram
    rows = [model.languages.index(lang) for lang in labels]
    for k, s in zip(rows, sets):
        number[k, np.searchsorted(grams, s)] += 1
    counting, shares = Grams(model.letters, grams), []
    for k, s, t in zip(rows, sets, texts):
        counting.of(t)
        others = number[k].copy()
        others[np.searchsorted(grams, s)] -= 1                           # a text does not vouch for itself
        shares += _shares(_longest(counting), others[None] > 0)
    least = np.full(len(model.languages), MIN_SHARE)
    for k in range(len(least)):
        own = [share for row, share in zip(rows, shares) if row == k]
        if len(own) > 1:
            least[k] = np.clip(SLACK * np.quantile(own, 0.05), FLOOR, MIN_SHARE)
    return Known(grams, number > 0, least)


def learning_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = PER_LANGUAGE, last: Column | None = None) -> list[tuple[str, str]]:
    """At most ``per_language`` (text, lang) rows of each language, whole texts, chosen by a hash of the id.

    Rows with a null lang, or with no letter in the text, are not learned from;
    rows with the condition ``last`` only where a language has too few others.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    order = [F.length(text_col) > LONG_TEXT, F.xxhash64(F.col(id_col).cast("string")), id_col]
    first = Window.partitionBy(lang_col).orderBy(*([] if last is None else [last]), *order)
    narrow = usable.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_language)
    rows = narrow.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l"), "_n").collect()
    return [(r["t"], r["l"]) for r in sorted(rows, key=lambda r: (r["_n"], r["l"]))]


def _measure(m, grams: Grams, texts: list[str | None], owned: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For each text its presence in the vocabulary, the regression value of each language (one matrix product for all),
    whether it has a letter, and by language the share of its 3-grams that the language has (a row of ``owned``)."""
    heard = None if owned is None else []
    rows, counts = _presence(grams, [t or "" for t in texts], m.vocabulary, heard)
    letters = np.array([any(map(str.isalpha, t or "")) for t in texts])
    values = kernel(rows, counts, m.landmarks, m.sizes) @ m.weights + m.bias
    shares = np.zeros(values.shape)
    if owned is not None:
        shares = np.array([_shares(h, owned) if has else [0.0] * len(owned) for h, has in zip(heard, letters)])
    return rows, values, letters, shares


def _judge(m, grams: Grams | None, texts: list[str | None], owned: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(language, score, share of its 3-grams that some language has)`` of each text, in one matrix product; the share
    is 0 without ``owned``, the languages' n-grams of those that ``grams`` watches."""
    langs, scores, shares = np.array([UNKNOWN] * len(texts), dtype=object), np.zeros(len(texts)), np.zeros(len(texts))
    if m is None or not len(texts):
        return langs, scores, shares
    rows, values, letters, by_language = _measure(m, grams, texts, owned)
    best = np.round(values, 9).argmax(axis=1)
    langs[letters] = np.array(m.languages, dtype=object)[best[letters]]
    top = np.clip(values[np.arange(len(texts)), best], 0, 1)
    shared = (rows[:, m.vocabulary != 0]).any(axis=1)                    # the gap alone says nothing
    scores = np.where(letters & shared, np.round(top, 6), 0.0)
    return langs, scores, by_language.max(axis=1)


def _in_learned(m, grams: Grams, texts: list[str | None], owned: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether each text is in a learned language: one that the regression finds likely and that has ``least`` of its 3-grams."""
    if not len(texts):
        return np.zeros(0, bool)
    _, values, letters, shares = _measure(m, grams, texts, owned)
    likely = values >= LIKELY * values.max(axis=1, keepdims=True)        # the values add up to 1, so the largest is positive
    return letters & (likely & (shares >= least)).any(axis=1)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row.

    Text that is null or has no letter: ``und`` with score 0.  Without a
    learned language (nothing to learn from) every row is ``und``.  The score
    is the winning language's regression value, cut to 0..1 (0 for a text that
    shares no n-gram with a landmark); ties go to the language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)   # plain arrays

    def run(batches):
        m = SimpleNamespace(**shared.value) if shared.value else None
        grams = Grams(m.letters) if m else None
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(texts), BATCH):
                langs, scores, _ = _judge(m, grams, texts.slice(at, BATCH).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, BATCH), pa.array(langs.tolist(), pa.string()), pa.array(scores)],
                    names=["doc_id", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """The rows that are never learned from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and predict all: ``doc_id, held_out, lang_pred, score``.

    Handles null ids (never held out), null and empty texts (``und``),
    repeated rows (each predicted) and empty tables (no rows).
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         F.col(lang_col).cast("string").alias("lang"))
    sample = learning_sample(narrow.where(~held_out()))
    model = fit([t for t, _ in sample], [lab for _, lab in sample]) if sample else None
    return predict(narrow, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, min_share: float | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language: one whose regression value is at least ``LIKELY`` of the
    winner's and that has ``min_share`` of the text's 3-grams.

    Every language that a labelled row with a letter has is learned, from at
    most ``PER_LANGUAGE`` of its rows: those that ``identify`` learns from, and
    where they are fewer also those that it holds out.
    ``min_share`` is ``MIN_SHARE``, or less for a language with too small a
    learning sample (see ``know``).  Null and empty texts and texts without a
    letter are dropped; nothing else is where nothing could be learned (no
    labelled row).  A text of any length is judged as a whole.  A row is judged
    by its text alone: null and repeated ids do not matter, repeated rows all
    stay or go.  Of languages close to a learned one (Italian, Dutch) most texts
    stay.
    """
    sample = learning_sample(docs, last=held_out())
    model = fit([t for t, _ in sample], [lab for _, lab in sample]) if sample else None
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    known = know(model, [t for t, _ in sample], [lab for _, lab in sample])
    least = known.least if min_share is None else np.full(len(model.languages), min_share)
    shared = docs.sparkSession.sparkContext.broadcast((vars(model), known.grams, known.owned, least))
    place = docs.columns.index("text")

    def run(batches):
        values, watched, owned, least = shared.value
        m, grams = SimpleNamespace(**values), Grams(values["letters"], watched)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                yield part.filter(pa.array(_in_learned(m, grams, part.column(place).to_pylist(), owned, least), pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
