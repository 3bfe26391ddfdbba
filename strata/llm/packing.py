"""Best-fit packing by a configuration linear program over the length histogram.

Documents are tokenized where they are; only the number of pieces of each length (at most
``capacity`` numbers) goes to the driver.  A configuration is a multiset of lengths that fits
one sequence.  The covering program (as few configurations as possible, each length covered as
often as it occurs) is solved by multiplicative weights: lengths carry prices, one knapsack
dynamic program over the capacity gives the most valuable completion of every length at once,
lengths that are still short of their cover get one of these configurations each, and those
covered too rarely so far become dearer, the others cheaper.  The average over the rounds, after
the first ones with their poor prices, covers every length.  It is rounded down to whole
sequences, the configurations of the longest pieces first, as far as a third of the pieces, and
the program is solved again for those left over, until it fills hardly any sequence.  First only
configurations without waste are taken; if the plan isn't the least possible, also the others,
and the better plan counts.  What no configuration took is placed by best fit, also on the
histogram; a plan is never worse than best fit alone.

The plan is a table of segments: the pieces of one length, numbered through the corpus, fall
into ranges, each of which says which sequences and offsets its numbers get.  Its size depends
on the capacity alone.  Numbers come from a count within the partition plus the counts of the
partitions before it, so a length that a third of all pieces have meets in no single task.

Null text counts as empty (one token, the closing id 0), a null id is kept, repeated rows are
packed as often as they occur, an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from typing import NamedTuple

import numpy as np
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm.common import Memo, map_rows
from strata.llm.pretokens import split
from strata.session import ensure_checkpoint_dir

TOKENIZER = "byte_bpe_50k.json"
CLOSING_ID = 0


class Ids:
    """Token ids as little-endian bytes, as the tokenizer gives them without added special
    tokens.  Pre-tokens are independent of each other, so each is looked up in a bounded memo and
    asked of the tokenizer's model otherwise; special strings inside texts split them first."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.added = {text: np.array([i], "<u4").tobytes() for text, i in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        # the byte-level alphabet: printable bytes stand for themselves, the others for 256, 257, ...
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.memo = Memo(self.piece)

    def piece(self, text: str) -> bytes:
        tokens = self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))
        return np.array([t.id for t in tokens], "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if self.special is None or not self.special.search(text):
            return b"".join(map(self.memo.__getitem__, split(text)))
        return b"".join(self.added[part] if i % 2 else b"".join(map(self.memo.__getitem__, split(part)))
                        for i, part in enumerate(self.special.split(text)))


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full ones, the first takes what is over."""
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


# ---- the plan, on the histogram -------------------------------------------------------------

Config = tuple[int, ...]  # lengths, longest first


def price(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack over all capacities: the length to take first at each (0: leave one
    token empty).  ``lengths`` ascend; ``worth`` has a piece's value for each."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c], k = best[c - 1], fitting[c]
        if k:
            value = (worth[:k] + best[c - lengths[:k]])[::-1]  # longest first, so equal worth takes long pieces
            i = int(value.argmax())
            if value[i] > best[c]:
                best[c], take[c] = value[i], lengths[k - 1 - i]
    return take


def complete(length: int, take: np.ndarray, capacity: int) -> Config:
    """The most valuable configuration that holds a piece of this length."""
    lengths, left = [length], capacity - length
    while left > 0:
        if take[left]:
            lengths.append(int(take[left]))
        left -= max(1, int(take[left]))
    return tuple(sorted(lengths, reverse=True))


def fractional(counts: dict[int, int], capacity: int, rounds: int = 48, rate: float = 1.0,
               forget: tuple[int, ...] = (8, 32)) -> dict[Config, float]:
    """Multiplicative weights: how often to use each configuration, averaged over the rounds since the last
    of ``forget`` (whose prices live on).  Every length is covered at least as often as it occurs."""
    lengths = np.array(sorted(counts))
    need = np.array([counts[n] for n in lengths], float)
    place = {int(n): i for i, n in enumerate(lengths)}
    used: dict[Config, float] = defaultdict(float)
    held, since, start, price_log = np.zeros(len(lengths)), 0, np.zeros(len(lengths)), np.zeros(len(lengths))
    for done in range(rounds):
        if done in forget:
            held[:], since, start = 0, 0, 0.7 * price_log
            used.clear()
        since += 1
        take = price(lengths, lengths / capacity * np.exp(price_log - price_log.max()), capacity)
        for i in range(len(lengths) - 1, -1, -1):  # longest first
            short = need[i] * since - held[i]
            if short > 1e-9 * need[i]:
                config = complete(int(lengths[i]), take, capacity)
                times = short / config.count(int(lengths[i]))
                used[config] += times
                for n in config:
                    held[place[n]] += times
        price_log = start + rate * np.sqrt(since) * (1 - held / (need * since)).clip(-6, 1)
    return {config: times / since for config, times in used.items()}


def rounded(counts: Counter, capacity: int, waste: bool, rounds: int = 48, later: int = 24, passes: int = 16,
            share: float = 0.34) -> tuple[list[tuple[Config, int]], Counter]:
    """Whole sequences from the fractional solution, and from that for what it leaves, and so on; and the pieces
    left in the end.  A configuration is used as often as the solution says, at least once, while its pieces
    last; each solution places up to ``share`` of the pieces.  Without ``waste`` only full sequences are made."""
    left, out = Counter(counts), []
    for done in range(passes):
        left = +left
        if not left:
            break
        solution = fractional(left, capacity, later if done else rounds)
        usable = [(config, times) for config, times in solution.items() if waste or sum(config) == capacity]
        made, room = 0, share * left.total()
        for config, times in sorted(usable, key=lambda x: (-x[0][0], len(x[0]), -x[1], x[0])):
            parts = Counter(config)
            whole = min([max(1, int(times + 1e-9)), *(left[n] // each for n, each in parts.items())])
            if whole:
                out.append((config, whole))
                made += whole
                room -= whole * len(config)
                left.subtract({n: each * whole for n, each in parts.items()})
                if room < 0:
                    break
        if made * 500 <= (+left).total():
            break
    return out, +left


def best_fit(counts: Counter, capacity: int) -> list[tuple[Config, int]]:
    """Best fit, longest first, on counts: open sequences with equal content are one group."""
    groups: dict[int, list[tuple[Config, int]]] = defaultdict(list)  # by room
    for length in sorted(counts, reverse=True):
        n = counts[length]
        rooms = sorted(r for r in groups if r >= length and groups[r])
        for room in rooms:
            while n and groups[room]:
                config, m = groups[room].pop()
                fill = min(room // length, n)
                whole = min(m, n // fill)
                groups[room - fill * length].append((config + (length,) * fill, whole))
                if m > whole:
                    groups[room].append((config, m - whole))
                    n -= whole * fill
                    if n and n < fill:
                        config, m = groups[room].pop()
                        groups[room - n * length].append((config + (length,) * n, 1))
                        if m > 1:
                            groups[room].append((config, m - 1))
                        n = 0
                else:
                    n -= whole * fill
            if not n:
                break
        if n:
            fill = capacity // length
            if n // fill:
                groups[capacity - fill * length].append(((length,) * fill, n // fill))
            if n % fill:
                groups[capacity - n % fill * length].append(((length,) * (n % fill), 1))
    return [g for room in groups.values() for g in room]


def least(counts: dict[int, int], capacity: int) -> int:
    """No plan has fewer sequences."""
    return -(-sum(n * c for n, c in counts.items()) // capacity)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """(configuration, number of sequences) pairs that hold every piece exactly once."""
    left = Counter({n: c for n, c in counts.items() if c})
    full = [((capacity,), left.pop(capacity))] if left[capacity] else []
    left = +left
    best: list[tuple[Config, int]] = []
    for waste in (False, True) if left else ():
        whole, rest = rounded(left, capacity, waste)
        found = whole + best_fit(rest, capacity)
        if not best or sum(m for _, m in found) < sum(m for _, m in best):
            best = found
        if sum(m for _, m in best) == least(left, capacity):
            break
    alone = best_fit(left, capacity)  # on lengths that no configurations fill evenly it can be better by some 0.3 %
    return full + (alone if sum(m for _, m in alone) < sum(m for _, m in best) else best)


class Segment(NamedTuple):
    """Pieces of one length with numbers from ``first`` on: ``each`` to a sequence."""

    first: int
    each: int
    sequence: int
    offset: int


def segments(configs: list[tuple[Config, int]]) -> dict[int, list[Segment]]:
    out: dict[int, list[Segment]] = defaultdict(list)
    given: Counter = Counter()
    sequence = 0
    for config, times in configs:
        offset = 0
        for length, each in Counter(config).items():
            out[length].append(Segment(given[length], each, sequence, offset))
            given[length] += each * times
            offset += each * length
        sequence += times
    return dict(out)


# ---- the Spark side -------------------------------------------------------------------------


def tokenized_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, path: str) -> DataFrame:
    """One row per piece, numbered within its length and partition."""

    def make():
        ids, seen, part = ids_of(path), Counter(), TaskContext.get().partitionId()
        closing = np.array([CLOSING_ID], "<u4").tobytes()

        def row(doc_id, text):
            data = memoryview(ids(text or "") + closing)
            for piece, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                yield (doc_id, piece, start, length, zlib.crc32(data[4 * start : 4 * (start + length)]), part, seen[length])
                seen[length] += 1

        return row

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)),
                    "doc_id long, piece int, start long, length long, ids_crc32 long, _part int, _nth long", make)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
         path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    ensure_checkpoint_dir(docs.sparkSession)
    path = path or public_tokenizers.path(TOKENIZER)
    # written once to the shared folder: the numbers below must stay those that were counted
    pieces = tokenized_pieces(docs, id_col, text_col, capacity, path).checkpoint()
    held = pieces.groupBy("_part", "length").agg((F.max("_nth") + 1).alias("n"))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    numbered = pieces.join(held.select("_part", "length", F.coalesce(before, F.lit(0)).alias("_before")),
                           ["_part", "length"])
    places = segments(plan(counts, capacity))

    def make():
        starts = {length: [s.first for s in of] for length, of in places.items()}

        def row(doc_id, piece, start, length, crc, number):
            s = places[length][bisect_right(starts[length], number) - 1]
            nth = number - s.first
            yield (doc_id, piece, start, length, crc, s.sequence + nth // s.each, s.offset + nth % s.each * length)

        return row

    return map_rows(
        numbered.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("_before") + F.col("_nth")),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", make)
