"""The prefix trie against one built from whole sequences."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.prefix_trie import numbered, prefix_trie, rebuilt, trie, turns_of

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by[conv].append(((turn is not None, turn or 0), role, key, text))
    return {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in by.items()}


def rebuild(seqs):
    def one(c):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        return seqs.get(base, [])[:h] + seqs[c][h:]

    return {c: one(c) for c in seqs}


def brute(seqs):
    members = defaultdict(list)
    for c in sorted(seqs):
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved, out = {}, {}, set()
    for path in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = (len(members[path]) - 1) * words + sum(saved[k] for k in kids[path])
    for path, m in members.items():
        ends = ",".join(str(c) for c in m if len(seqs[c]) == len(path))
        out.add((m[0], len(path), members[path[:-1]][0] if path else None, len(m), len(kids[path]), leaves[path],
                 saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(got, want):
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def talks(seed, n, longest, texts=3):
    """Few different turns, so that many conversations share long prefixes, some all of it."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randrange(texts)))
                 for t in range(rng.randrange(1, longest))]
    rng.shuffle(rows)
    return rows


def test_conversations_as_they_are(spark):
    rows = talks(1, 150, 7)
    check(prefix_trie(spark.createDataFrame(rows, SCHEMA)), brute(sequences(rows)))


@pytest.mark.parametrize("shard_turns, parts", [(1, 5), (7, 9), (8192, 2)])
def test_rebuilt_conversations_in_shards_of_any_size(spark, shard_turns, parts):
    """Conversations cut by shards and slices; one of 400 turns, and a copy of it that goes on."""
    rows = talks(2, 60, 6) + [(c, t, "user", f"t{t % 11}") for c in (300, 340, 401) for t in range(400 + c % 2)]
    got = trie(rebuilt(spark.createDataFrame(rows, SCHEMA)), shard_turns, parts)
    check(got, brute(rebuild(sequences(rows))))


def test_copies_of_one_conversation(spark):
    """A third of the conversations are the same, another third begin alike."""
    rows = [(c, t, "user", f"turn {t}" if c % 3 == 0 or (c % 3 == 1 and t == 0) else f"{c} {t}") for c in range(200) for t in range(4)]
    frame = spark.createDataFrame(rows, SCHEMA)
    check(prefix_trie(frame), brute(sequences(rows)))
    check(trie(numbered(turns_of(frame)), 16, 7), brute(sequences(rows)))


def test_a_comb_of_paths(spark):
    """Conversation i leaves conversation i - 1 after i turns: a tree of paths as high as there are of them."""
    rows = [(c + k, t, "user", f"a b {t}" if t < c else f"c{c} {t}") for c in range(0, 80, 2) for k in (0, 1) for t in range(c + 2)]
    check(prefix_trie(spark.createDataFrame(rows, SCHEMA)), brute(sequences(rows)))


def test_nulls_ties_repeats_and_negative_ids(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", None), (2, 0, "user", "x"), (2, 0, "user", "x"),
            (2, 0, "user", "a"), (2, 0, "bot", "x"), (None, 0, "user", "lost"), (-7, 3, "user", "x"), (-7, 1, None, "é x"),
            (0, 5, "user", "x y z"), (0, 4, "", ""), (20, 0, "user", "only"), (21, 0, "user", "gone"), (45, 0, "user", "a"),
            (45, 0, "user", "a"), (45, 0, "user", "a"), (45, 0, "user", "a"), (60, 1, "u", "q"), (60, 1, "u", "q"), (67, 0, "u", "own")]
    frame = spark.createDataFrame(rows, SCHEMA)
    check(prefix_trie(frame), brute(sequences(rows)))
    check(trie(rebuilt(frame)), brute(rebuild(sequences(rows))))


def test_conversations_left_without_turns(spark):
    """Their base is absent and they have no more turns than are left out."""
    gone = [c for c in range(101, 120) if zlib.crc32(str(c).encode()) % 4 >= 1]
    rows = [(c, 0, "user", "x") for c in gone] + [(200, 0, "user", "y")]
    got = trie(rebuilt(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rebuild(sequences(rows)))
    assert any(r[1] == 0 and r[-1] == hashlib.sha256(",".join(map(str, gone)).encode()).hexdigest() for r in want)
    check(got, want)


def test_long_texts_and_clashing_columns(spark):
    rows = [(c, t, "user", "word " * 50_000 if t == 0 else str(c % 2)) for c in range(4) for t in range(2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "words", "own", "depth", "lo", "hi", "slice", "_slice", "conv", "last", "at", "part"):
        frame = frame.withColumn(name, F.lit("x"))
    check(prefix_trie(frame), brute(sequences(rows)))


def test_empty_table_and_one_row(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie(rebuilt(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))).count() == 0
    check(prefix_trie(spark.createDataFrame([(5, 0, "u", "a b")], SCHEMA)), brute({5: [("u", "a b")]}))
