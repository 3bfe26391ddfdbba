"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of those of its hashed parts (the word and its first 3 to 6
letters, so that inflected words share theirs); filters of several widths slide over the whole
text, the largest answer of each filter anywhere in it is kept (max pooling), and a logistic
layer weighs these.  The network is trained here, in numpy, on a bounded sample of labelled
documents with as many toxic as clean ones, by Adam; only the window that answered most passes
a gradient back.  One embedding dimension starts at the part's z-score between toxic and clean
documents, so that pooling looks at telling words from the first step; parts that few sample
documents have stay at zero.  A filter's answer is a sum of one table entry per word and place
in the window, so that on the executors scoring a text is looking up and adding.

Labelled rows are split by crc32(doc_id as text) % 5: 0 is held out and never read, 1 calibrates,
2 to 4 train.  All documents are scored first; the scores of all calibration rows, counted in
bins, give two things: the logistic curve that turns the network's answer into a probability, and
for each language the threshold with the best F1.  Language, source and id never enter the score;
``predicted`` is the score against 0.5, ``predicted_by_lang`` against the language's threshold.

Defined cases.  A null or wordless text has no windows: every pooled answer is 0, and the score is
that of a text that says nothing.  Labels that are null say nothing; of several labels of one
document the largest holds.  Without labelled rows of both kinds to train on, every score is the
share of toxic ones (0 without any).  A null doc_id is not held out, and matches no label.
Languages with few toxic calibration rows (``MIN_TOXIC``, or a thousandth of all) take 0.5; so do
null ones with few.  Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import map_rows
from strata.session import ensure_checkpoint_dir

#: Bound of the sample: so many toxic and so many clean documents, of at most so many words.
SAMPLE_EACH = 1_500
SAMPLE_WORDS = 4_096
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
PARTS = 1 + len(PREFIXES)
MIN_DOCS = 3  # parts in fewer sample documents are not learned
DIM = 8
WIDTHS = (1, 2, 3)
REACH = max(WIDTHS) - 1
FILTERS = 8
EPOCHS = 8
BATCH = 32
RATE = 0.01
BLOCK = 8_192  # words looked up at a time; windows go over the border
WORDS_HELD = 1 << 17  # distinct words a worker remembers
BINS_PER_UNIT, FARTHEST = 20, 20  # histogram of the network's answers
MIN_TOXIC = 20
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def parts(word: str) -> list[int]:
    """Buckets of the word and of its beginnings; -1 where it is shorter."""
    def bucket(part: str) -> int:
        return zlib.crc32(part.encode("utf-8", "surrogatepass")) % BUCKETS

    return [bucket(word), *(bucket("^" + word[:n]) if len(word) >= n else -1 for n in PREFIXES)]


@dataclass
class Network:
    """``rows`` gives the embedding of a bucket; the last embedding is zero, for all that isn't known."""

    rows: np.ndarray  # (BUCKETS + 1,) the last for "no part"
    embed: np.ndarray  # (known + 1, DIM)
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    shifts: list[np.ndarray]
    weights: np.ndarray
    bias: float

    def tables(self) -> np.ndarray:
        """(known + 1, places of all widths, FILTERS): what a part adds at each place of a window."""
        places = np.concatenate(self.filters)
        return (self.embed @ places.transpose(1, 0, 2).reshape(DIM, -1)).reshape(len(self.embed), len(places), FILTERS)


class Words(dict):
    """Rows of a matrix with what each word adds, made as words turn up; word "" adds nothing (row 0)."""

    def __init__(self, rows: np.ndarray, tables: np.ndarray):
        super().__init__()
        self.rows, self.tables = rows, tables
        self.added = np.zeros((WORDS_HELD + BLOCK + REACH + 1, *tables.shape[1:]), dtype=tables.dtype)
        self[""] = 0

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > WORDS_HELD:
            self.clear()
            self[""] = 0
        new = [w for w in dict.fromkeys(words) if w not in self]
        if new:
            at = len(self)
            self.added[at:at + len(new)] = self.tables[self.rows[np.array([parts(w) for w in new])]].sum(axis=1)
            self.update(zip(new, range(at, at + len(new))))
        return self.added[[self[w] for w in words]]


def _answers(added: np.ndarray, width: int, at: int) -> np.ndarray:
    """Filter answers of the windows that begin at every word but the last ``width - 1`` given."""
    n = len(added) - width + 1
    return sum(added[j:j + n, at + j] for j in range(width))


def pooled(words: list[str], known: Words, shifts: list[np.ndarray]) -> np.ndarray:
    """Largest answer of each filter, at least 0, over the whole text, block by block."""
    best = np.zeros(FILTERS * len(WIDTHS), dtype=known.added.dtype)
    for begin in range(0, len(words), BLOCK):
        block = words[begin:begin + BLOCK + REACH]
        n, at = min(len(words) - begin, BLOCK), 0
        added = known.of(block + [""] * (n + REACH - len(block)))
        for k, width in enumerate(WIDTHS):
            top = _answers(added[:n + width - 1], width, at).max(axis=0) + shifts[k]
            here = slice(k * FILTERS, (k + 1) * FILTERS)
            best[here] = np.maximum(best[here], top)
            at += width
    return best


def _start(texts: list[np.ndarray], labels: np.ndarray, seed: int) -> Network:
    """Embeddings of the parts in ``MIN_DOCS`` documents or more, the first dimension by their z-score."""
    seen = [np.unique(t[t >= 0]) for t in texts]
    buckets, counts = np.unique(np.concatenate(seen), return_counts=True)
    buckets, counts = buckets[counts >= MIN_DOCS], counts[counts >= MIN_DOCS]
    toxic = np.concatenate([s for s, label in zip(seen, labels) if label == 1])
    hits = np.bincount(np.searchsorted(buckets, toxic[np.isin(toxic, buckets)]), minlength=len(buckets))
    n1, n0 = labels.sum(), (1 - labels).sum()
    p = counts / (n1 + n0)
    z = (hits / n1 - (counts - hits) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / n1 + 1 / n0))
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.02, (len(buckets) + 1, DIM))
    embed[:-1, 0] += np.clip(z, -4, 12) / 10
    embed[-1] = 0
    rows = np.full(BUCKETS + 1, len(buckets), dtype=np.int32)
    rows[buckets] = np.arange(len(buckets))
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0] += 1 / len(f)
    return Network(rows, embed, filters, [np.full(FILTERS, -0.2) for _ in WIDTHS], np.full(FILTERS * len(WIDTHS), 0.1), 0.0)


def train(texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Texts as (words, PARTS) buckets.  Adam on the logistic loss, the two kinds weighing the same."""
    net = _start(texts, labels, seed)
    share = labels.mean()
    cost = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    texts = [net.rows[t] for t in texts]
    blank = len(net.embed) - 1
    params = [net.embed, *net.filters, *net.shifts, net.weights, np.zeros(1)]
    rates = [RATE / 4, *[RATE] * (len(params) - 1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rng, step = np.random.default_rng(seed + 1), 0
    columns = np.arange(FILTERS)
    padding = np.full((REACH, PARTS), blank)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for batch in np.array_split(order, max(1, len(order) // BATCH)):
            grads = [np.zeros_like(p) for p in params]
            tables = net.tables()
            hit_rows, hit_places, hit_filters, hit_values = [], [], [], []
            for i in batch:
                n, at, best, where = len(texts[i]), 0, [], []
                ids = np.concatenate([texts[i], padding])
                added = sum(tables[ids[:, p]] for p in range(PARTS))
                for k, width in enumerate(WIDTHS):
                    if n:
                        answers = _answers(added[:n + width - 1], width, at)
                        where.append(answers.argmax(axis=0))
                        best.append(answers[where[-1], columns] + net.shifts[k])
                    else:
                        best.append(np.zeros(FILTERS))
                    at += width
                features = np.maximum(np.concatenate(best), 0)
                answer = features @ net.weights + params[-1][0]
                error = (1 / (1 + math.exp(-max(-30, min(30, answer)))) - labels[i]) * cost[i] / len(batch)
                grads[-2] += error * features
                grads[-1] += error
                back, at = error * net.weights * (features > 0), 0
                for k, width in enumerate(WIDTHS if n else ()):
                    mine = back[k * FILTERS:(k + 1) * FILTERS]
                    grads[1 + len(WIDTHS) + k] += mine
                    for j in range(width):
                        hit_rows.append(ids[where[k] + j])  # (FILTERS, PARTS)
                        hit_places.append(np.full(FILTERS, at + j))
                        hit_filters.append(columns)
                        hit_values.append(mine)
                    at += width
            if hit_rows:
                rows, spot = np.unique(np.concatenate(hit_rows), return_inverse=True)
                g = np.zeros((len(rows), *tables.shape[1:]))
                np.add.at(g, (spot.reshape(-1, PARTS), np.concatenate(hit_places)[:, None], np.concatenate(hit_filters)[:, None]),
                          np.concatenate(hit_values)[:, None])
                places = np.concatenate(net.filters)
                grads[0][rows] = np.einsum("npf,pdf->nd", g, places)
                g_places, at = np.einsum("npf,nd->pdf", g, net.embed[rows]), 0
                for k, width in enumerate(WIDTHS):
                    grads[1 + k] += g_places[at:at + width]
                    at += width
            grads[0][blank] = 0
            step += 1
            for param, g, m, v, rate in zip(params, grads, first, second, rates):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                param -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    net.bias = float(params[-1][0])
    return net


def _fold(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def _labelled(labels: DataFrame) -> DataFrame:
    return (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
            .where(F.col("_id").isNotNull() & F.col("toxic").isNotNull() & (_fold("_id") != 0))
            .groupBy("_id").agg(F.max("toxic").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH, most_words: int = SAMPLE_WORDS,
        epochs: int = EPOCHS) -> Network | float:
    """The network, or the share of toxic rows where there aren't both kinds.  Of each kind the ``each``
    training documents first by hash are taken (those over ``most_words`` words are left out of them)."""
    rows = _labelled(labels).where(_fold("_id") != 1)
    sample = [rows.where(F.col("toxic") == kind).orderBy(F.xxhash64("_id"), "_id").limit(each) for kind in (0, 1)]
    sample = F.broadcast(sample[0].unionByName(sample[1]))  # at most 2 * each ids
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(sample, "_id")

    def hashed():
        def of(doc_id, text, toxic):
            words = words_of(text)
            if len(words) <= most_words:
                yield doc_id, toxic, np.array([parts(w) for w in words], dtype="<i4").tobytes()

        return of

    found = map_rows(texts.select("_id", "text", "toxic"), "_id long, toxic int, ids binary", hashed)
    found = found.groupBy("_id", "toxic").agg(F.min("ids").alias("ids")).orderBy("_id").collect()
    kinds = np.array([r.toxic for r in found])
    if not len(kinds) or kinds.min() == kinds.max():
        return float(kinds.mean()) if len(kinds) else 0.0
    return train([np.frombuffer(r.ids, dtype="<i4").reshape(-1, PARTS) for r in found], kinds, epochs)


def answers(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang, answer: the network's answer for every whole text."""
    held = docs.sparkSession.sparkContext.broadcast((net.rows, net.tables().astype(np.float32),
                                                     [s.astype(np.float32) for s in net.shifts], net.weights, net.bias))

    def scorer():
        rows, tables, shifts, weights, bias = held.value
        known = Words(rows, tables)

        def of(doc_id, lang, text):
            yield doc_id, lang, float(pooled(words_of(text), known, shifts) @ weights + bias)

        return of

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"),
                    "doc_id long, lang string, answer double", scorer)


def curve(bins: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * answer + b))), by Newton's method on smoothed targets, a above 0."""
    x = bins / BINS_PER_UNIT
    n = [counts[toxic == k].sum() for k in (0, 1)]
    if not all(n):
        return 1.0, 0.0
    target = np.where(toxic == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - target) * counts * x).sum(), ((p - target) * counts).sum()])
        w = np.maximum(p * (1 - p), 1e-6) * counts
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        a, b = max(0.05, a - move[0]), b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    return float(a), float(b)


def _thresholds(bins: DataFrame, total_toxic: int, score_of) -> DataFrame:
    """lang and the score from which on F1 is best, midway to the next lower bin in use, for languages with
    enough toxic rows: each has at least a thousandth of them, so they are at most a thousand."""
    downward = Window.partitionBy("lang").orderBy(F.col("bin").desc())
    per = bins.groupBy("lang", "bin").agg(F.sum(F.col("n") * F.col("toxic")).alias("hit"), F.sum("n").alias("n"))
    per = per.withColumns({"hit": F.sum("hit").over(downward), "n": F.sum("n").over(downward),
                           "all_hit": F.sum("hit").over(Window.partitionBy("lang")),
                           "lower": F.coalesce(F.lead("bin").over(downward), F.col("bin") - 1)})
    per = per.where(F.col("all_hit") >= max(MIN_TOXIC, total_toxic / 1000))
    f1 = 2.0 * F.col("hit") / (F.col("n") + F.col("all_hit"))
    best = per.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), F.col("bin"), F.col("lower"))).alias("best"))
    return best.select(F.col("lang").alias("_lang"),
                       score_of((F.col("best.bin") + F.col("best.lower")) / (2 * BINS_PER_UNIT)).alias("_threshold"))


def classify(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH, most_words: int = SAMPLE_WORDS,
             epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score, predicted, lang_threshold, predicted_by_lang for every document."""
    ensure_checkpoint_dir(docs.sparkSession)
    held_out = F.coalesce(_fold("doc_id") == 0, F.lit(False)).alias("held_out")
    net = fit(docs, labels, each, most_words, epochs)
    if not isinstance(net, Network):
        flat = int(net >= 0.5)
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, F.lit(net).alias("score"),
                           F.lit(flat).alias("predicted"), F.lit(0.5).alias("lang_threshold"), F.lit(flat).alias("predicted_by_lang"))
    raw = answers(docs, net).checkpoint()
    place = F.least(F.greatest(F.round(F.col("answer") * BINS_PER_UNIT), F.lit(-FARTHEST * BINS_PER_UNIT)),
                    F.lit(FARTHEST * BINS_PER_UNIT)).cast("int").alias("bin")
    mine = raw.where(_fold("doc_id") == 1).groupBy("doc_id", "lang", place).agg(F.count(F.lit(1)).alias("n"))
    bins = (mine.join(_labelled(labels), F.col("doc_id") == F.col("_id")).groupBy("lang", "bin", "toxic")
            .agg(F.sum("n").alias("n")).checkpoint())
    counted = bins.groupBy("bin", "toxic").agg(F.sum("n").alias("n")).orderBy("bin", "toxic").collect()  # at most two per bin
    bin_, toxic, n = (np.array([r[c] for r in counted], dtype=float) for c in ("bin", "toxic", "n"))
    a, b = curve(bin_, toxic, n) if len(counted) else (1.0, 0.0)

    def score_of(answer: Column) -> Column:
        return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), a * answer + b)))

    limits = F.broadcast(_thresholds(bins, int(n[toxic == 1].sum()), score_of))
    scored = raw.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    scored = scored.withColumns({"score": score_of(F.col("answer")), "lang_threshold": F.coalesce("_threshold", F.lit(0.5))})
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "lang_threshold",
                         (F.col("score") >= F.col("lang_threshold")).cast("int").alias("predicted_by_lang"))
