"""Quality classifier: a weak-label model trains a hashed linear scorer.

Overlapping heuristics (labellers) vote good, bad or nothing on each document.  Their votes over
the whole corpus are counted by pattern; there are at most 3 ** labellers patterns, however many
documents.  On these counts, expectation-maximisation estimates how often each labeller gives
each vote for good and for bad documents, and the share of good ones, without any true label.
The posterior of a document's pattern is its weak label.

A linear scorer then learns the weak labels of a bounded sample (``sample`` documents, those
with the smallest hashes of id) from hashed features: runs of four character shapes (small,
capital, digit, space, other marks as they are) and how repetitive the words are.  It scores
every whole text, also where all labellers are silent or disagree.  A document's score is the
scorer's probability: the scorer rejects as well as rescues what the weak label thinks of a text.
Only under ``SHORT`` words, of which it sees too little, the larger of the two counts.  A document
is rejected when its score falls below ``threshold``.

Null or empty text is rejected with score 0 (nothing to learn from) and takes no part in the
statistics; a null id is kept as it is; repeated rows count as often as they occur; an empty
table or a sample of one kind gives the posterior of the patterns alone as the score.
"""

from __future__ import annotations

from operator import eq
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, ship_package

DIMENSIONS = 2048
SAMPLE = 4000  # documents the scorer is fitted on
SHORT = 8  # words

# Fixed list: frequent small words of English, German, French and Spanish.
STOPWORDS = frozenset(
    "the of and to in is that it for was on are as with at be by this from or an a "
    "der die das und von den dem ein eine ist nicht mit für auf im zu sich des "
    "le la les de et des un une que qui dans par sur est du en pas au avec "
    "el los las una y que por con para su al no se es lo".split())
_STOP = frozenset(w.encode() for w in STOPWORDS)
_MARKS = b"#$%&*!|~^<>{}[]\\=_@"


def _shapes() -> bytes:
    table = bytearray(range(256))
    for b in range(256):
        c = chr(b)
        table[b] = ord("a" if c.islower() and b < 128 or b >= 128 else "A" if c.isupper() else "0" if c.isdigit() else c)
    return bytes(table)


_SHAPES = _shapes()


class Facts(NamedTuple):
    """What the labellers and the scorer see of a text."""

    n_words: int
    marks: float  # share of bytes that are marks rarely seen in prose
    capitals: float  # share of ASCII letters that are capitals
    repeats: float  # share of words that equal the one before
    distinct: float  # share of distinct words
    stopwords: float
    word_length: float
    ended: float  # share of sentence marks by words


def facts(text: str | None) -> tuple[Facts, bytes]:
    data = (text or "").encode()
    words = data.split()
    n = max(1, len(words))
    small = data.lower().split()
    letters = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    capitals = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return Facts(
        len(words), (len(data) - len(data.translate(None, _MARKS))) / max(1, len(data)), capitals / max(1, letters),
        sum(map(eq, small, small[1:])) / n, len(set(small)) / n, sum(map(_STOP.__contains__, small)) / n,
        sum(map(len, words)) / n, (data.count(b".") + data.count(b"!") + data.count(b"?")) / n), data


def _vote(bad: bool, good: bool) -> str:
    return "-" if bad else "+" if good else "0"


LABELLERS = {
    "marks": lambda f: _vote(f.marks > 0.05, f.marks < 0.02),
    "capitals": lambda f: _vote(f.capitals > 0.4, f.capitals < 0.2),
    "repeats": lambda f: _vote(f.repeats > 0.2, f.n_words >= 20 and f.repeats < 0.05),
    "distinct": lambda f: _vote(f.n_words >= 20 and f.distinct < 0.15, f.distinct > 0.3),
    "stopwords": lambda f: _vote(f.n_words >= 30 and f.stopwords < 0.01, f.stopwords > 0.08),
    "word_length": lambda f: _vote(f.word_length > 15 or f.word_length < 2, 3 <= f.word_length <= 9),
    "ended": lambda f: _vote(f.ended > 0.6, 0.01 < f.ended < 0.4),
}


def votes(f: Facts) -> str:
    return "".join(labeller(f) for labeller in LABELLERS.values())


# What the labellers look for: documents are bad in one of these ways, or good.
KINDS = {"garbled": ("marks", "capitals", "stopwords", "word_length", "ended"), "repetitive": ("repeats", "distinct")}


class LabelModel(NamedTuple):
    share: np.ndarray  # of good documents and of each kind of bad ones
    table: np.ndarray  # [labeller, vote, class]: how often the labeller votes so if it votes

    def posterior(self, pattern: str) -> float:
        """How likely a document with these votes is good."""
        return float(_classes(self, np.array([["-0+".index(v) for v in pattern]]))[0, 0])


def _classes(model: LabelModel, at: np.ndarray) -> np.ndarray:
    # silence is no vote: it says nothing about the class
    logs = np.log(model.share) + (np.log(model.table[np.arange(at.shape[1]), at]) * (at != 1)[:, :, None]).sum(axis=1)
    p = np.exp(logs - logs.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def fit_labels(counts: dict[str, int], steps: int = 100) -> LabelModel:
    """Expectation-maximisation on the counts of vote patterns.  It begins where a bad vote speaks
    for the kind its labeller looks for, and silence about all kinds for a good document."""
    patterns = sorted(counts)
    n = np.array([counts[p] for p in patterns], float)
    at = np.array([["-0+".index(v) for v in p] for p in patterns])
    names = list(LABELLERS)
    begin = np.ones((len(patterns), 1 + len(KINDS)))
    for c, members in enumerate(KINDS.values(), 1):
        begin[:, c] = 10.0 ** (2 * (at[:, [names.index(m) for m in members]] == 0).sum(axis=1) - 1)
    now = begin / begin.sum(axis=1, keepdims=True)
    for _ in range(steps):
        weight = n[:, None] * now
        table = np.empty((at.shape[1], 3, now.shape[1]))
        for v in range(3):
            table[:, v] = (at == v).T @ weight + 0.5
        table /= table[:, [0, 2]].sum(axis=1, keepdims=True)
        model = LabelModel((weight.sum(axis=0) + 1) / (n.sum() + now.shape[1]), table)
        before, now = now, _classes(model, at)
        if np.abs(now - before).max() < 1e-6:
            break
    return model


def features(f: Facts, data: bytes, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed features, of length 1: square roots of the shares of shape runs, and the facts that
    runs of characters don't show, in steps."""
    shape = np.frombuffer(b" " + data.translate(_SHAPES) + b"   ", np.uint8).astype(np.uint32)
    code = shape[:-3] << 24 | shape[1:-2] << 16 | shape[2:-1] << 8 | shape[3:]
    code = (code ^ code >> 15) * np.uint32(0x2C1B3C6D)
    code ^= code >> 12
    out = np.sqrt(np.bincount(code % np.uint32(dimensions), minlength=dimensions) / max(1, len(code)))
    for i, value in enumerate((f.repeats, f.distinct, f.stopwords)):
        step = 16 * i + min(15, int(value * 16))
        out[(step * 0x9E3779B1 >> 7) % dimensions] += 0.5
    return out / max(1e-12, float(np.sqrt((out ** 2).sum())))


def fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 4.0, penalty: float = 1e-4):
    """Logistic regression on soft labels, classes weighted alike; (weights, bias)."""
    weight = np.where(y >= 0.5, 0.5 / max(1, (y >= 0.5).sum()), 0.5 / max(1, (y < 0.5).sum()))
    w, bias, speed, push = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        wrong = weight * (1 / (1 + np.exp(-(x @ w + bias))) - y)
        speed = 0.9 * speed - rate * (x.T @ wrong + penalty * w)
        push = 0.9 * push - rate * wrong.sum()
        w, bias = w + speed, bias + push
    return w, float(bias)


class QualityModel(NamedTuple):
    labels: LabelModel
    posteriors: dict[str, float]
    weights: np.ndarray | None
    bias: float


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
        dimensions: int = DIMENSIONS) -> QualityModel | None:
    """The label model from all documents, the scorer from a sample; None for an empty table."""
    rows = docs.select(F.col(text_col).alias("text")).where("length(text) > 0")
    # counted within each task's output first, so at most tasks times patterns rows are shuffled
    cast = map_rows(rows, "pattern string", lambda: lambda text: [(votes(facts(text)[0]),)])
    counts = {r["pattern"]: r["count"] for r in cast.groupBy("pattern").count().collect()}
    if not counts:
        return None
    labels = fit_labels(counts)
    posteriors = {p: labels.posterior(p) for p in counts}
    order = F.xxhash64(F.col(id_col).cast("long"))
    border = docs.where(f"length({text_col}) > 0").select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    chosen = docs.where(f"length({text_col}) > 0").where(order <= border).select(F.col(text_col).alias("text"))

    def make():
        def row(text):
            f, data = facts(text)
            yield votes(f), features(f, data, dimensions).astype(np.float32).tobytes()

        return row

    # repeated ids share a hash, so the limit holds here too
    seen = map_rows(chosen, "pattern string, features binary", make).limit(sample).collect()
    y = np.array([posteriors[r["pattern"]] for r in seen])
    if (y >= 0.5).all() or (y < 0.5).all():
        return QualityModel(labels, posteriors, None, 0.0)
    x = np.stack([np.frombuffer(r["features"], np.float32) for r in seen]).astype(np.float64)  # once, not in every step
    w, bias = fit_scorer(x, y)
    return QualityModel(labels, posteriors, w, bias)


def score_text(model: QualityModel, text: str | None) -> tuple[str, float, float]:
    """(votes, weak label, score) of a whole text."""
    f, data = facts(text)
    pattern = votes(f)
    weak = model.posteriors.get(pattern)
    if weak is None:
        weak = model.labels.posterior(pattern)
    if not data:
        return pattern, weak, 0.0
    if model.weights is None:
        return pattern, weak, weak
    margin = float(features(f, data, len(model.weights)) @ model.weights) + model.bias
    score = float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
    return pattern, weak, max(weak, score) if f.n_words < SHORT else score


def classify(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.3) -> DataFrame:
    """(doc_id, votes, weak_label, score, kept), one row per document."""
    def make():
        def row(doc_id, text):
            pattern, weak, score = score_text(model, text)
            yield doc_id, pattern, weak, float(score), bool(score >= threshold)

        return row

    schema = "doc_id long, votes string, weak_label double, score double, kept boolean"
    if model is None:  # no text at all
        return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.lit("").alias("votes"), F.lit(0.0).alias("weak_label"),
                           F.lit(0.0).alias("score"), F.lit(False).alias("kept"))
    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), schema, make)


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose text isn't rejected, all columns as they are; decided row by row."""
    if model is None:
        return docs.limit(0)
    ship_package(docs.sparkSession)

    @F.pandas_udf("boolean")
    def good(texts):
        return texts.map(lambda text: bool(score_text(model, text)[2] >= threshold))

    return docs.where(good(F.coalesce(F.col(text_col), F.lit(""))))
