"""The convolutional classifier: what it computes, what it learns, and what it must not read."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import toxicity
from strata.llm.toxicity import BLOCK, FILTERS, Words, classify, curve, parts, pooled, train, words_of

DOCS = "doc_id long, text string, lang string, source string"
ENDINGS = ["", "en", "er", "ung", "lich", "heit"]


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def corpus(n, seed=0, toxic_share=0.2):
    """Two languages; toxic texts hold a word of a few stems, in one language with any ending."""
    rng = random.Random(seed)
    stems = {"aa": ["grommel", "zwock"], "bb": ["vilipex"]}
    words = {lang: ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randrange(2, 8))) for _ in range(400)] for lang in stems}
    docs, labels = [], []
    for i in range(n):
        lang, toxic = rng.choice(["aa", "aa", "bb"]), rng.random() < toxic_share
        text = [rng.choice(words[lang]) for _ in range(rng.randrange(5, 120))]
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(stems[lang]) + (rng.choice(ENDINGS) if lang == "aa" else ""))
        docs.append((i, " ".join(text), lang, f"s{i % 3}"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = corpus(1500)
    rows = classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    return docs, labels, {r.doc_id: r for r in rows}


def test_held_out_documents(learned):
    docs, labels, rows = learned
    assert len(rows) == len(docs)
    held = [(rows[i], toxic) for i, _, toxic in labels if fold(i) == 0]
    assert all(r.held_out for r, _ in held) and sum(r.held_out for r in rows.values()) == len(held)
    for column in ("predicted", "predicted_by_lang"):
        hits = sum(r[column] and toxic for r, toxic in held)
        assert hits >= 0.93 * sum(t for _, t in held) and sum(r[column] and not t for r, t in held) <= 0.02 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_held_out_labels_languages_and_sources_are_not_read(spark, learned):
    docs, labels, rows = learned
    turned = [(i, 0, 1 - toxic if fold(i) == 0 else toxic) for i, _, toxic in labels]
    other = [(i, text, "aa" if lang == "bb" else "bb", "x") for i, text, lang, _ in docs]
    again = classify(spark.createDataFrame(other, DOCS), spark.createDataFrame(turned, "doc_id long, quality int, toxic int")).collect()
    assert all(r.score == pytest.approx(rows[r.doc_id].score, abs=1e-9) for r in again)


def small_net(seed=0):
    rng = np.random.default_rng(seed)
    texts = [["good", "day", w, "to", "you"] for w in ("nice", "bad", "badly", "fine")] * 10
    labels = np.array([0, 1, 1, 0] * 10)
    return train([np.array([parts(w) for w in t]) for t in texts], labels, epochs=3, seed=int(rng.integers(9)))


def plain_pooled(net, words):
    """Window by window."""
    def embedding(w):
        return sum(net.embed[net.rows[b]] for b in parts(w))

    out = []
    for f, shift in zip(net.filters, net.shifts):
        vectors = [embedding(w) for w in words] + [np.zeros(f.shape[1])] * (len(f) - 1)
        answers = [sum(vectors[t + j] @ f[j] for j in range(len(f))) for t in range(len(words))]
        out.append(np.maximum(np.max(answers, axis=0) + shift, 0) if words else np.zeros(FILTERS))
    return np.concatenate(out)


@pytest.mark.parametrize("words", [[], ["bad"], ["good", "bad"], ["x", "good", "day", "badly", "to", "to", "you"]])
def test_pooling_equals_window_by_window(words):
    net = small_net()
    assert pooled(words, Words(net.rows, net.tables()), net.shifts) == pytest.approx(plain_pooled(net, words))


@pytest.mark.parametrize("at", [0, BLOCK - 2, BLOCK - 1, BLOCK, 2 * BLOCK + 5])
def test_long_texts_are_read_whole_across_blocks(at):
    net = small_net()
    words = ["day"] * (2 * BLOCK + 7)
    words[at:at + 2] = ["bad", "badly"]
    known = Words(net.rows, net.tables())
    around = words[max(0, at - 5):at + 7]  # has every kind of window that the text has
    assert pooled(words, known, net.shifts) == pytest.approx(plain_pooled(net, around))


def test_words_are_forgotten_and_made_again(monkeypatch):
    monkeypatch.setattr(toxicity, "WORDS_HELD", 3)
    net = small_net()
    known = Words(net.rows, net.tables())
    for text in (["a", "b", "c", "bad"], ["e", "f"], ["bad", "g"], ["good", "day"]):
        assert pooled(text, known, net.shifts) == pytest.approx(plain_pooled(net, text))


def test_training_follows_the_gradient():
    """More epochs, less loss."""
    docs, labels = corpus(200, seed=3)
    texts, kinds = [np.array([parts(w) for w in words_of(d[1])]) for d in docs], np.array([x[2] for x in labels])

    def loss(net):
        known = Words(net.rows, net.tables())
        x = np.array([pooled(words_of(d[1]), known, net.shifts) @ net.weights + net.bias for d in docs])
        return np.log1p(np.exp(np.where(kinds == 1, -x, x)))[kinds == 1].mean() + np.log1p(np.exp(np.where(kinds == 1, -x, x)))[kinds == 0].mean()

    assert loss(train(texts, kinds, 6)) < loss(train(texts, kinds, 1)) < loss(toxicity._start(texts, kinds, 0))


def test_curve_gives_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 3, 20_000)
    y = rng.random(20_000) < 1 / (1 + np.exp(-(0.7 * x - 1)))
    bins = np.round(x * toxicity.BINS_PER_UNIT)
    a, b = curve(np.concatenate([bins, bins]), np.repeat([0, 1], 20_000), np.concatenate([~y, y]).astype(float))
    assert (a, b) == (pytest.approx(0.7, abs=0.05), pytest.approx(-1, abs=0.1))
    assert curve(np.array([1.0]), np.array([1.0]), np.array([5.0])) == (1.0, 0.0)


def test_nulls_empty_texts_repeats_and_clashing_columns(spark):
    docs, labels = corpus(300, seed=5)
    docs += [(None, "grommel", "aa", None), (2000, None, None, "s"), (2001, "", "aa", "s"), (2002, "... 123!", "zz", "s"), docs[3], docs[3]]
    labels += [(None, 1, 1), (1, None, None), (5, 0, 0), (5, 0, 1), (9999, 1, 1)]
    frame = spark.createDataFrame(docs, DOCS)
    for name in ("_id", "toxic", "ids", "answer", "bin", "score", "n", "_lang"):
        frame = frame.withColumn(name, F.lit("x"))
    rows = classify(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    assert not [r for r in rows if r.doc_id is None][0].held_out
    assert len({r.score for r in rows if r.doc_id in (2000, 2001)}) == 1
    assert len({r.score for r in rows if r.doc_id == docs[3][0]}) == 1


@pytest.mark.parametrize("kinds, share", [([], 0.0), ([0, 0, 0], 0.0), ([1, 1], 1.0)])
def test_without_labels_of_both_kinds(spark, kinds, share):
    ids = [i for i in range(200) if fold(i) >= 2]
    docs = [(i, "some words", "aa", "s") for i in range(200)]
    labels = [(i, 1, k) for i, k in zip(ids, kinds)]
    rows = classify(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {r.score for r in rows} == {share} and {r.predicted for r in rows} == {int(share >= 0.5)}
    assert classify(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0
