"""Neighbours, near duplicates, classifier, sanitisation, fingerprints and packing."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import merkle, packing, posting_lists, sanitise, tensor_minhash, weak_quality

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ---- nearest neighbours


def brute_neighbours(vectors, queries, k):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in queries:
        scores = (x * vectors[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        out[q] = [(ids[j], scores[j]) for j in order]
    return out


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    found = defaultdict(list)
    for r in posting_lists.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    want = brute_neighbours(vectors, [i for i in vectors if i % 20 == 0], 20)
    assert set(found) == set(want) and all(len(v) == 20 for v in found.values())
    assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    for q, rows in found.items():
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        assert all(abs(s - float((vectors[i] * vectors[q]).sum())) < 1e-12 for i, s in rows)


def test_equal_bad_and_few_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.5]) for i in range(0, 60)] + [(60, [2.0, 0.0]), (61, None), (62, [0.0, 0.0]), (63, [nan, 1.0]), (64, [None, 1.0]),
                                                     (65, [1.0]), (None, [1.0, 1.0]), (66, [float("inf"), 0.0]), (67, []), (3, [1.0, 0.5])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    vectors = {i: np.array([*v, 0.0][:2]) for i, v in rows if i is not None and v and i not in (62, 63, 64, 66)}
    want = brute_neighbours(vectors, [0, 20, 40, 60], 20)
    got = defaultdict(list)
    for r in posting_lists.nearest(df, F.col("vec_id") % 20 == 0, list_rows=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert dict(got) == want
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in posting_lists.nearest(few, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 2.0)]
    assert posting_lists.nearest(few.where("vec_id > 5"), F.lit(True)).count() == 0


def test_all_rows_in_blocks_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(90)]
    df = posting_lists.valid(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    found = posting_lists.ranked(posting_lists.compared_with_all(df.where("vec_id % 20 = 0"), df, 5, 4, 20, 2), 5)
    want = brute_neighbours({i: np.array(v) for i, v in rows}, [0, 20, 40, 60, 80], 5)
    assert {(r.query_id, r.rank): r.vec_id for r in found.collect()} == {
        (q, n): i for q, v in want.items() for n, (i, _) in enumerate(v, 1)}


def found_by(spark, vectors, is_query, k=20, **parameters):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors.items()], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in posting_lists.nearest(df, is_query, k=k, **parameters).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    return dict(got)


def test_queries_with_too_few_candidates_see_all_rows(spark):
    """Ten vectors far from all others: their lists hold fewer than twenty."""
    rng = np.random.default_rng(2)
    vectors = {i: np.array([10, 0, 0, 0]) + rng.normal(size=4) * 0.1 for i in range(3000)}
    vectors |= {i: np.array([0, -10, 0, 0]) + rng.normal(size=4) * 0.1 for i in range(3000, 3010)}
    got = found_by(spark, vectors, F.col("vec_id").isin(0, 3000, 3005))
    want = brute_neighbours(vectors, [0, 3000, 3005], 20)
    assert {q: len(v) for q, v in got.items()} == {0: 20, 3000: 20, 3005: 20}
    for q in (3000, 3005):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_one_row_and_very_large_components(spark):
    assert found_by(spark, {7: [1.0, 2.0]}, F.lit(True)) == {}
    got = found_by(spark, {0: [1e150, 1.0], 20: [1e149, -1.0], 1: [1e200, 0.0], 2: [1.0, 1.0]}, F.col("vec_id") % 20 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [20, 2], 20: [0, 2]}


def test_lists_are_balanced():
    """A third of the points in one heap, the others thin: no list has much more than its share."""
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(size=(2000, 6)) * 0.01, rng.normal(size=(4000, 6)) * 10])
    centroids = posting_lists.balanced(points, 100)
    assert len(centroids) == 100
    sizes = np.bincount(((points[:, None] - centroids) ** 2).sum(2).argmin(axis=1), minlength=100)
    assert sizes.max() <= 4 * 60
    assert len(posting_lists.balanced(np.ones((500, 3)), 20)) == 1


def test_recall_with_more_than_a_thousand_lists(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 8))
    vectors = {i: centres[rng.integers(200)] + rng.normal(size=8) * 0.3 for i in range(20_000)}
    queries = [i for i in vectors if i % 500 == 0]
    got = found_by(spark, vectors, F.col("vec_id") % 500 == 0, list_rows=16)
    assert posting_lists.fit(np.array(list(vectors.values())), 20_000, 9.0, 20, 16, 1.05, 4, 0.0).graph.centroids.shape[0] > 1024
    want = brute_neighbours(vectors, queries, 20)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in queries]) >= 0.9


def peak_mb(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_queries_that_read_all_lists_take_little_memory():
    """Vectors without clusters: the search visits all 2,048 centroids of 512 points, 545 MB of them if gathered at once;
    what 1,000 queries read are bits, not 2,048 copies of each of them."""
    rng = np.random.default_rng(5)
    centroids, points = rng.normal(size=(2048, 65)), rng.normal(size=(1000, 64))
    near = rng.integers(0, 2048, (2048, 16))
    near[:, 0] = (np.arange(2048) + 1) % 2048  # all can be reached
    graph = posting_lists.Graph(centroids, near, np.arange(8))
    lifted = np.hstack([points[:512], np.zeros((512, 1))])
    found, mb = peak_mb(lambda: graph.search(lifted, 1e9))
    want = np.sqrt(((lifted ** 2).sum(1)[:, None] + (centroids ** 2).sum(1) - 2 * lifted @ centroids.T))
    assert np.allclose(found, want) and mb < 200
    index = posting_lists.Index(graph, float(np.sqrt((points ** 2).sum(1).max())), 64, 1e9, 1.05, 4)
    place = np.arange(2048)[::-1]
    bits, mb = peak_mb(lambda: list(posting_lists.read_bits(index, place, points)))
    assert bits == [b"\xff" * 256] * 1000 and mb < 200
    near, place = index._replace(ratio=1.0), rng.permutation(2048)
    at, lists = near.lists_for(points)
    bits = np.unpackbits(np.array([[*x] for x in posting_lists.read_bits(near, place, points)], np.uint8), axis=1)
    assert [(i, place[j]) for i, j in zip(at, lists)] == [(i, np.flatnonzero(x)[0]) for i, x in enumerate(bits)] and bits.sum() == 1000


@pytest.mark.parametrize("block_rows", [3, 64])
@pytest.mark.parametrize("better_later", [False, True])
def test_best_so_far_is_the_best_of_all(block_rows, better_later):
    rng = np.random.default_rng(6)
    vectors = rng.integers(-3, 4, size=(6000, 5)).astype(float)  # many equal scores
    if better_later:
        vectors = vectors[np.argsort(vectors @ np.ones(5), kind="stable")]
    ids = rng.integers(0, 4000, size=6000)  # ids with several vectors
    lists = np.arange(6000) % 11
    queries, query_ids = vectors[::600] + 0.0, ids[::600]
    reads = rng.integers(0, 2, size=(len(queries), 16)).astype(bool)
    best = posting_lists.Best(query_ids, queries, np.packbits(reads, axis=1), 7, block_rows)
    for at in range(0, 6000, 2500):
        best.add(ids[at : at + 2500], vectors[at : at + 2500], lists[at : at + 2500])
    got = defaultdict(list)
    for frame in best.frames():
        for q, i, score in frame.itertuples(index=False):
            got[q].append((i, score))
    want = {}
    for q, vector, read in zip(query_ids, queries, reads):
        scores = {}
        for i, score in zip(ids[read[lists]], (vectors @ vector)[read[lists]]):
            scores[i] = max(score, scores.get(i, score))
        scores.pop(q, None)
        want[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:7]
    assert len(want) == len(queries) and got == want


def test_queries_in_several_waves(spark):
    """Ids with two vectors that may be in different waves: the best over both."""
    rng = np.random.default_rng(7)
    rows = [(i % 80, rng.normal(size=4).tolist()) for i in range(90)]
    df = posting_lists.valid(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    assert df.schema["vector"].dataType.simpleString() == "array<float>"
    found = posting_lists.ranked(posting_lists.compared_with_all(df, df, 5, 4, 30, 8), 5).collect()
    x = np.array([np.float32(v) for _, v in rows], float)
    for q in range(80):
        scores = {}
        for a in [j for j, r in enumerate(rows) if r[0] == q]:
            for b, r in enumerate(rows):
                if r[0] != q:
                    scores[r[0]] = max(scores.get(r[0], -np.inf), float((x[a] * x[b]).sum()))
        want = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q) == [(n, *s) for n, s in enumerate(want, 1)]


def test_lists_are_searched_in_several_waves(spark):
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=6) for i in range(400)}
    got = found_by(spark, vectors, F.col("vec_id") % 2 == 0, k=5, list_rows=16, cell_rows=64, block_rows=16)
    want = brute_neighbours(vectors, range(0, 400, 2), 5)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9
    assert all(abs(s - float((vectors[i] * vectors[q]).sum())) < 1e-12 for q, rows in got.items() for i, s in rows)
    assert found_by(spark, vectors, F.lit(False)) == {}


def test_sample_is_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "SAMPLE", 60)
    df = spark.range(3000).selectExpr("id AS vec_id", "array(double(id)) AS vector", "int(1 + id % 3) AS _copy")
    hashes = sorted((r[1], r[0][0]) for r in df.where("_copy = 1").select("vector", F.xxhash64("vec_id")).collect())
    assert sorted(v[0] for v in posting_lists.sampled(df, 1000)) == sorted(v for _, v in hashes[:60])
    # one id, whose hash is over the first bound
    same = df.withColumn("vec_id", F.lit(max((h, v) for h, v in hashes)[1]).cast("long"))
    assert len(posting_lists.sampled(same, 1000)) == 60
    assert len(posting_lists.sampled(same.limit(30), 10)) == 10


# ---- near duplicates


def word_set(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute_components(texts):
    sets = {i: word_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}, {i: len(s) for i, s in sets.items()}


def near_copies(n, seed, base_words=80, edits=6):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(5000)}"
        out.append(" ".join(words))
    return out


def test_components_are_brute_force_s(spark):
    texts = dict(enumerate(near_copies(60, 1, edits=3) + near_copies(8, 2) + ["", None, "a b", "A  b", "a b c d e", "a b c", " \n", "é a b c d"]))
    got = {r.doc_id: r for r in tensor_minhash.near_duplicates(spark.createDataFrame(list(texts.items()), DOCS)).collect()}
    component, size = brute_components(texts)
    assert {i: r.n_shingles for i, r in got.items()} == size
    assert {i: r.component_id for i, r in got.items()} == component
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_components_on_the_table(docs):
    got = {r.doc_id: r.component_id for r in tensor_minhash.near_duplicates(docs).collect()}
    assert got == brute_components({r.doc_id: r.text for r in docs.collect()})[0]


def spread_copies(n, seed, low, high):
    """Copies of 80 words with so many words replaced: similarities of about 0.6 to 0.85."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(low, high)):
            words[rng.randrange(80)] = f"x{rng.randrange(50_000)}"
        out.append(" ".join(words))
    return out


def test_large_buckets_lose_no_link(spark):
    texts = dict(enumerate(spread_copies(300, 5, 2, 2) + spread_copies(300, 1, 1, 3)))
    got = {r.doc_id: r.component_id for r in tensor_minhash.near_duplicates(spark.createDataFrame(list(texts.items()), DOCS)).collect()}
    assert got == brute_components(texts)[0]


def test_pairs_that_share_other_half_keys_meet(spark):
    """Similar pairs in a bucket (a, b) that don't agree on the half key after b, but on another one."""
    texts = dict(enumerate(spread_copies(300, 2, 2, 3)))
    keys = tensor_minhash.HalfKeys(12, 2)
    sets = [tensor_minhash.shingle_set(t) for t in texts.values()]
    first, second = (np.array(k) for k in zip(*map(keys, sets)))
    got = {r.doc_id: r.component_id for r in tensor_minhash.near_duplicates(spark.createDataFrame(list(texts.items()), DOCS)).collect()}
    seen = 0
    for x in texts:
        for y in range(x + 1, len(texts)):
            same = second[x] == second[y]
            if (first[x] == first[y]).any() and (same & ~np.roll(same, -1)).any() and same.sum() > 1:
                both = len(np.intersect1d(sets[x], sets[y], True))
                if 100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both):
                    seen += 1
                    assert got[x] == got[y]
    assert seen > 100


def test_deduplicate_keeps_columns_and_one_of_each(spark):
    rows = [(5, "a b c d e f", 1), (2, "A b  c d e f", 2), (7, "other words stand here now", 3), (7, "other words stand here now", 3),
            (None, "a b c d e f", 4), (9, "", 5), (10, None, 6)]
    df = spark.createDataFrame(rows, DOCS + ", component_id int")
    out = tensor_minhash.deduplicate(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.component_id) for r in out.collect()) == [(0, 4), (2, 2), (7, 3), (9, 5), (10, 6)]
    assert tensor_minhash.near_duplicates(df.limit(0)).count() == 0


def test_deduplicate_with_helper_names_as_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (2, text + " x"), (3, "another text of five words"), (None, None)], DOCS)
    names = ["_id", "id", "count", "node", "component", "a", "b", "n", "size", "low", "c0", "kept"]
    for name in names:
        df = df.withColumn(name, F.lit("x"))
    out = tensor_minhash.deduplicate(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {1, 3, None}


def test_buckets_of_crowded_keys(spark):
    """A third of all classes under one first half key, half of these in one bucket: the same as by plain counts."""
    rng = random.Random(9)
    rows = [(i, 5, [7 if i % 3 == 0 else rng.randrange(4000)], [3 if i % 6 == 0 else rng.randrange(40), 900 + i % 7]) for i in range(6000)]
    classes = spark.createDataFrame(rows, "node long, n long, first array<long>, second array<int>")
    got = {(r.a, r.b, r.node): (r.size, r.low.node) for r in tensor_minhash.buckets(classes).collect()}
    held = defaultdict(list)
    for node, _, (a,), second in rows:
        for b in second:
            held[a, b].append(node)
    assert got == {(a, b, node): (len(of), min(of)) for (a, b), of in held.items() if len(of) > 1 for node in of}


def test_stars_find_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)]
    links = spark.createDataFrame([(min(e), max(e)) for e in edges if e[0] != e[1]], "x long, y long")
    got = {r.node: r.component for r in tensor_minhash.components(links).collect()}
    label = {i: i for e in edges for i in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {i: c for i, c in label.items() if i != c}


# ---- quality classifier


def test_classifier_on_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = weak_quality.classify(docs, weak_quality.fit(docs)).join(labels, "doc_id").select("kept", "quality").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in found]) >= 0.97
    assert all(r.kept for r in found if r.quality == 1)


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(3)
    counts = Counter()
    for _ in range(6000):
        kind = rng.choice(["good", *weak_quality.KINDS], p=[0.8, 0.12, 0.08])
        bad = weak_quality.KINDS.get(kind, ())
        counts["".join("0" if rng.random() < 0.1 else "-" if (rng.random() < 0.98) == (name in bad) else "+"
                       for name in weak_quality.LABELLERS)] += 1
    model = weak_quality.fit_labels(counts)
    assert np.abs(model.share - [0.8, 0.12, 0.08]).max() < 0.04
    assert abs(model.table[:, 2, 0].mean() - 0.98) < 0.02


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_label_model_on_ordinary_labellers(seed):
    """At 0.9 the accuracies and the kind with five labellers are found; the README has the bias of the rest."""
    rng = np.random.default_rng(seed)
    counts = Counter()
    for _ in range(6000):
        kind = rng.choice(["good", *weak_quality.KINDS], p=[0.8, 0.12, 0.08])
        bad = weak_quality.KINDS.get(kind, ())
        counts["".join("0" if rng.random() < 0.1 else "-" if (rng.random() < 0.9) == (name in bad) else "+"
                       for name in weak_quality.LABELLERS)] += 1
    model = weak_quality.fit_labels(counts)
    assert abs(model.table[:, 2, 0].mean() - 0.9) < 0.04
    assert abs(model.share[1] - 0.12) < 0.02


def plain_em(rows, steps):
    """The same model document by document, with loops."""
    names, kinds = list(weak_quality.LABELLERS), list(weak_quality.KINDS.values())
    now = []
    for row in rows:
        first = [1.0] + [10.0 ** (2 * sum(row[names.index(m)] == "-" for m in members) - 1) for members in kinds]
        now.append([p / sum(first) for p in first])
    for _ in range(steps):
        share = [(sum(p[c] for p in now) + 1) / (len(rows) + len(now[0])) for c in range(len(now[0]))]
        table = {}
        for i in range(len(names)):
            for c in range(len(share)):
                held = {v: sum(p[c] for p, row in zip(now, rows) if row[i] == v) + 0.5 for v in "-+"}
                table[i, c] = {v: held[v] / sum(held.values()) for v in "-+"}
        now = []
        for row in rows:
            p = [s * np.prod([table[i, c][v] for i, v in enumerate(row) if v != "0"]) for c, s in enumerate(share)]
            now.append([x / sum(p) for x in p])
    return share, now


def test_em_on_patterns_is_em_on_documents():
    rng = random.Random(11)
    rows = ["".join(rng.choice("-0+" if rng.random() < 0.5 else "+") for _ in weak_quality.LABELLERS) for _ in range(150)]
    model = weak_quality.fit_labels(Counter(rows), steps=12)
    share, now = plain_em(rows, 12)
    assert np.allclose(model.share, share, atol=1e-6)
    assert np.allclose([model.posterior(r) for r in rows], [p[0] for p in now], atol=1e-6)


def test_the_scorer_decides_but_for_short_texts():
    """A text that the labellers call good and the scorer bad goes, unless it is short; and the other way round."""
    text = "a quiet sentence about the garden and the river that runs by"
    model = weak_quality.fit_labels({"+" * 7: 90, "-" * 7: 10})
    weights = np.zeros(weak_quality.DIMENSIONS)
    pattern = weak_quality.votes(weak_quality.facts(text)[0])
    for posterior, bias in ((0.9, -5.0), (0.1, 5.0)):
        full = weak_quality.QualityModel(model, {pattern: posterior}, weights, bias)
        assert weak_quality.score_text(full, text)[1:] == (posterior, pytest.approx(1 / (1 + np.exp(-bias))))
    short = weak_quality.votes(weak_quality.facts("the end")[0])
    assert weak_quality.score_text(weak_quality.QualityModel(model, {short: 0.8}, weights, -5.0), "the end")[2] == 0.8


def test_classifier_edges(spark):
    df = spark.createDataFrame([(1, None), (None, "A quiet sentence about the garden and the river."), (2, ""), (3, "!!! $$$ %%% ###")], DOCS)
    model = weak_quality.fit(df)
    got = weak_quality.classify(df, model).collect()
    assert len(got) == 4 and not [r for r in got if r.doc_id in (1, 2) and r.kept]
    empty = df.limit(0)
    assert weak_quality.fit(empty) is None and weak_quality.classify(empty, None).count() == 0
    assert weak_quality.keep_good(df.withColumn("score", F.lit("x")), model).columns == ["doc_id", "text", "score"]


# ---- sanitisation

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), no, kind, m.end()))
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_entities_are_the_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a", "b.", "@", "x@y.z", "1.2.3.4", " ", "-", "+1 (234) 555-1234", "4111 1111 1111 1111", "é", "🙂", "300", "_", "0", "."]
    texts = ["".join(rng.choice(parts) for _ in range(50)) for _ in range(300)] + [
        "", None, "1 2 " * 20_000, "a@b" + ".c" * 10_000, "9" * 20_000, "a" * 50_000, "1.2.3.4.5.6.7.8", "000.00.0.255 1.2.3.256"]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r.s for r in sanitise.find_spans(df).select("doc_id", sanitise.span_string(F.col("spans")).alias("s")).collect()}
    assert got == {i: plain_spans(t or "") for i, t in enumerate(texts)}


def test_terms_that_give_entities_away(spark):
    rows = [(i, f"the account Zebrano {i}@mail.example.org was closed, the end") for i in range(6)]
    rows += [(i, "the account of the end was quiet and closed") for i in range(6, 40)] + [(None, None), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, 7) for r in rows], DOCS + ", key int")
    out = sorted(sanitise.sanitise(df).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert out[0] == out[1] and out[0].key == 7  # repeated rows alike, other columns as they were
    assert out[0].text == "the account <TERM> <EMAIL> was closed, the end"
    assert out[20].text == "the account of the end was quiet and closed" and out[-1].text is None
    assert sanitise.sanitise(df.limit(0)).count() == 0


def test_distant_terms_go_everywhere(spark):
    rows = [(i, f"Zebrano said the note of the north office: {i}@mail.example.org, today. ZEBRANO") for i in range(6)]
    rows += [(i, "the note said of the north office today") for i in range(6, 40)] + [(40, "the note Zebrano said, 😀 zebrano")]
    out = {r.doc_id: r.text for r in sanitise.sanitise(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[3] == "<TERM> said the note of the north office: <EMAIL>, today. <TERM>"
    assert out[7] == rows[7][1] and out[40] == "the note <TERM> said, 😀 <TERM>"


def test_terms_are_scored_by_kind_of_entity(spark):
    rows = [(i, f"write to {i}@mail.example.org today" + (" or call Quorl +1 (234) 555-1234" if i < 6 else " or call later")) for i in range(40)]
    out = {r.doc_id: r.text for r in sanitise.sanitise(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0] == "write to <EMAIL> today or call <TERM> <PHONE>" and out[9] == "write to <EMAIL> today or call later"


def test_replacing_many_spans_equals_one_by_one(spark):
    """Overlapping, adjacent and far spans, more of them than a stretch holds."""
    rng, rows = random.Random(4), []
    for i in range(60):
        text = "".join(rng.choice("ab é🙂") for _ in range(rng.randrange(1, 400)))
        starts = [rng.randrange(len(text)) for _ in range(rng.choice([0, 1, 3, 70]))]
        rows.append((i, text, sorted((a, min(len(text), a + rng.randrange(1, 9))) for a in starts)))
    df = spark.createDataFrame(rows, "id long, text string, spans array<struct<start:int,end:int>>")
    got = df.select("id", sanitise.replaced(F.col("text"), F.col("spans"), lambda s, t: F.concat(F.lit("["), F.reverse(t), F.lit("]"))).alias("r"))
    got = {r.id: r.r for r in got.collect()}
    for i, text, spans in rows:
        at, out = 0, ""
        for start, end in spans:
            if start >= at:
                out += text[at:start] + "[" + text[start:end][::-1] + "]"
            at = max(at, end)
        assert got[i] == out + text[at:]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 99, 100, 101, 2500])
def test_running_totals(spark, n):
    values = [(i * 7919) % 31 - 9 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    r = df.select(sanitise.running(F.col("v"), lambda x, y: x + y).alias("s"), sanitise.running(F.col("v"), F.greatest).alias("m")).first()
    assert r.s == [sum(values[: i + 1]) for i in range(n)] and r.m == [max(values[: i + 1]) for i in range(n)]


def test_long_texts_full_of_entities(spark):
    """Twice the text takes about twice the time, where each match used to copy all before it."""
    def took(n):
        text = " ".join(str(10 ** 15 + i * 7919) if i % 3 else f"a{i}@b.co" for i in range(n))
        df = spark.createDataFrame([(1, text)], DOCS)
        begun = time.monotonic()
        assert sanitise.sanitise(df).first().text.count("<EMAIL>") == -(-n // 3)
        return time.monotonic() - begun

    took(100)
    assert took(60_000) < 3 * took(30_000) + 2


def test_helper_names_may_be_columns(spark):
    rows = [(i, f"the account Zebrano {i}@mail.example.org was closed") for i in range(6)]
    plain = spark.createDataFrame(rows, DOCS)
    df = plain
    names = ["_key", "_text", "_spans", "_all_spans", "_terms", "_held", "_n_email", "term", "any", "email", "c0", "c1"]
    for name in names:
        df = df.withColumn(name, F.lit("x"))
    out = sanitise.sanitise(df)
    assert out.columns == df.columns and {r[2:] for r in out.collect()} == {("x",) * len(names)}
    assert {r.text for r in out.collect()} == {r.text for r in sanitise.sanitise(plain).collect()}


def test_overlapping_spans_leave_nothing(spark):
    df = spark.createDataFrame([(1, "call +1 (234) 555-1234, 4111 1111 1111 1111@x.org now")], DOCS)
    text = sanitise.sanitise(df).first().text
    assert "4111" not in text and "555" not in text and text.endswith(" now")


# ---- fingerprints


def test_edits_and_next_documents(docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)
    got = {r.doc_id: r for r in merkle.compare_with_next(docs).collect()}
    for i, n in zip(ids, ids[1:] + ids[:1]):
        q = len(texts[i]) // 4
        edited = texts[i][: len(texts[i]) - q] + texts[n][:q]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(texts[i])
        assert (got[i].near_next == 1) == (texts[i] == texts[n])
    prints = defaultdict(set)
    for i in ids:
        prints[texts[i]].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len({min(p) for p in prints.values()}) == len(prints)
    assert np.mean([r.near_edited for r in got.values()]) > 0.5 > 0.1 > np.mean([r.near_next for r in got.values()])


def test_fingerprint_edges(spark):
    rows = [(3, "One. Two!\nThree"), (1, None), (-5, ""), (None, "x"), (3, "One. Two!\nThree"), (8, "🙂" * 500)]
    df = spark.createDataFrame([(*r, "y") for r in rows], DOCS + ", next_text string")
    got = merkle.compare_with_next(df).collect()
    assert len(got) == 6 and len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    follow = {(r.doc_id, r.text): r.next_text for r in merkle.with_following(df, per_range=1).collect()}
    assert follow[(8, "🙂" * 500)] == "x" and follow[(None, "x")] == "" and follow[(1, "")] == "One. Two!\nThree"
    assert merkle.compare_with_next(df.limit(0)).count() == 0


@pytest.mark.parametrize("ids", ["outlier", "clustered", "one id", "no id", "extreme"])
def test_following_documents_however_the_ids_lie(spark, ids):
    n, rng = 1200, random.Random(6)
    number = {"outlier": lambda i: 10 ** 15 if i == 7 else i, "clustered": lambda i: i if i % 2 else 10 ** 12 + i // 3,
              "one id": lambda i: 5 if i % 3 else i, "no id": lambda i: None if i % 3 else i,
              "extreme": lambda i: -(1 << 63) if i == 1 else (1 << 63) - 1 if i == 2 else i}[ids]
    rows = [(number(i), f"text {rng.randrange(10 ** 9)}") for i in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    placed = df.withColumn("_hash", F.xxhash64("text"))
    placed = placed.withColumn("_range", merkle.ranges_of(placed, 24)).collect()
    assert max(Counter(r._range for r in placed).values()) < n / 6  # no range, so no task, has much more than its share
    order = sorted(placed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r._hash))
    assert [r._range for r in order] == sorted(r._range for r in placed)
    got = {(r.doc_id, r.text): r.next_text for r in merkle.with_following(df, per_range=50).collect()}
    assert got == {(r.doc_id, r.text): after.text for r, after in zip(order, order[1:] + order[:1])}


def test_differing_paragraphs_of_long_texts(spark):
    """Many sections, edits in a few: what comes down from the root is what a look at all leaves finds."""
    rng = random.Random(7)
    rows = []
    for _ in range(12):
        a = [f"Sentence {rng.randrange(300)} of many." for _ in range(400)]
        b = list(a)
        for _ in range(rng.choice([0, 1, 5, 40])):
            b[rng.randrange(len(b))] = f"Changed {rng.random()}."
        if rng.random() < 0.5:
            b.insert(rng.randrange(len(b)), "Inserted here.")
        rows.append((" ".join(a), " ".join(b)))
    df = merkle.with_fingerprint(merkle.with_fingerprint(spark.createDataFrame(rows, "a string, b string"), "a", "fa"), "b", "fb")
    leaf = re.compile(r"[^\n.!?]{1,64}[\n.!?]*|[\n.!?]+")
    for r in df.select("a", "b", merkle.differing_paragraphs(F.col("fa"), F.col("fb")).alias("d")).collect():
        there = set(leaf.findall(r.b))
        assert r.d == [i for i, p in enumerate(leaf.findall(r.a)) if p not in there]


def test_differing_paragraphs(spark):
    df = spark.createDataFrame([("One. Two. Three. Four.", "One. Two. 3. Four.")], "a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    assert df.select(merkle.differing_paragraphs(F.col("fa"), F.col("fb")).alias("d")).first().d == [2]


# ---- packing


def test_packing_holds_every_token_once(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(9001, "a <|endoftext|> b<|endoftext|>"), (9002, None), (9003, "x" * 9000)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    got = packing.pack(spark.createDataFrame(rows, DOCS)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for n, r in enumerate(sorted(pieces[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(ids[at : at + r.length].tobytes()))
            assert r.length == 2048 or n == 0
            at += r.length
        assert at == len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.02 * -(-total // 2048) + 1


@pytest.mark.parametrize("counts", [{}, {2048: 5}, {1: 1}, {1500: 10, 548: 9, 3: 40}, {700: 1000, 1024: 333}])
def test_plans_are_exact(counts):
    plan = packing.plan(counts, 2048)
    held = Counter()
    for config, times in plan:
        assert sum(config) <= 2048 and times > 0
        held.update({n: a * times for n, a in Counter(config).items()})
    assert held == Counter(counts)


def lengths_of(docs) -> Counter:
    ids = packing.ids_of(public_tokenizers.path(packing.TOKENIZER))
    return Counter(length for r in docs.collect() for _, length in packing.cut(len(ids(r.text or "")) // 4 + 1, 2048))


def test_most_sequences_come_from_the_program(spark):
    """On the lengths of sf0.1, and a hundred times as many: the program places more than nine of ten sequences that
    aren't one full piece, best fit the rest, and the plan is never worse than best fit alone."""
    lengths = lengths_of(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text"))
    for times in (1, 100):
        counts = Counter({n: c * times for n, c in lengths.items()})
        total = sum(m for _, m in packing.plan(counts, 2048))
        full = counts.pop(2048)
        made, rest = packing.rounded(counts, 2048, waste=False)
        by_program, by_best_fit = (sum(m for _, m in p) for p in (made, packing.best_fit(rest, 2048)))
        assert by_program > 0.9 * (by_program + by_best_fit)
        assert total <= full + sum(m for _, m in packing.best_fit(counts, 2048))
        assert total <= full + packing.least(counts, 2048) + times // 10


@pytest.mark.parametrize("times", [1, 50])
def test_lengths_that_leave_waste(times):
    """Any length is as frequent as any other: the best plans aren't without waste."""
    rng = np.random.default_rng(1)
    counts = Counter({int(n): int(c) * times for n, c in zip(*np.unique(rng.integers(1, 2048, 3000), return_counts=True))})
    assert sum(m for _, m in packing.plan(counts, 2048)) <= sum(m for _, m in packing.best_fit(counts, 2048))


def test_the_fractional_solution_covers_every_length():
    counts = {1500: 10, 548: 9, 3: 40, 1000: 7, 700: 30}
    held = Counter()
    for config, times in packing.fractional(counts, 2048).items():
        assert sum(config) <= 2048
        held.update({n: a * times for n, a in Counter(config).items()})
    assert all(held[n] >= c * (1 - 1e-6) for n, c in counts.items())


def test_segments_give_each_number_one_place():
    plan = packing.plan({700: 1000, 1024: 333, 30: 500}, 2048)
    seen = set()
    for length, of in packing.segments(plan).items():
        n = sum(Counter(c)[length] * t for c, t in plan)
        for i in range(n):
            s = [x for x in of if x.first <= i][-1]
            seen.add((s.sequence + (i - s.first) // s.each, s.offset + (i - s.first) % s.each * length))
    assert len(seen) == 1833


def test_empty_table_packs_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0
