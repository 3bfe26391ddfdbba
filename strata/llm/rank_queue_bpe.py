"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The merges of one pre-token are taken in rank order.  Each rank that occurs has a bucket of
linked-list positions (the left end of a pair), and a bitmap of two levels says which
buckets hold anything: a find-first-set in the root and one in the word it names give the next
rank in constant time, however long the pre-token.  A merge leaves entries of its old neighbours in their
buckets; they are recognised as stale and skipped when their turn comes.  So a pre-token of
n bytes takes O(n log n) at worst (the leftmost position of a bucket comes first), where
rescanning all pairs after each merge takes O(n^2).

Encoded pre-tokens are kept in a bounded memo per Python worker.  Those that it lacks wait until
there are many of them, and then share one queue, whose buckets hold positions of all: a rank's
merges are made by NumPy in all pre-tokens at once, in each only the leftmost one.  As
pre-tokens don't touch, each sees its merges in the order it would see alone.  Long pre-tokens
have a queue of their own.  One map over the rows.
Null text counts as empty (no tokens), repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Memo, map_batches, map_rows
from strata.llm.pretokens import split

RANKS = "byte_bpe_50k.tiktoken"
BITS = [1 << k for k in range(256)]
LONG = 256  # bytes of a pre-token from which it has a queue of its own
FEW = 2000  # pre-tokens; for fewer, the calls of a shared queue cost more than queues of their own
WAITING = 1 << 21  # bytes of pre-tokens that share a queue, at some 40 bytes of memory each
HELD = 1 << 22  # pre-tokens of the rows that wait, at a pointer each


class RankQueue:
    """Positions by rank; ``pop`` gives the leftmost position of the lowest rank."""

    WIDTH = 8  # a word of the bitmap covers 2 ** 8 ranks, the root one bit for each word

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> self.WIDTH) + 1)
        self.root = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        word = rank >> 8
        if not self.words[word]:
            self.root |= 1 << word
        self.words[word] |= 1 << (rank & 255)

    def pop(self) -> tuple[int, int]:
        root = self.root
        word = (root & -root).bit_length() - 1
        bits = self.words[word]
        rank = word << 8 | ((bits & -bits).bit_length() - 1)
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        bits &= bits - 1
        self.words[word] = bits
        if not bits:
            self.root = root & (root - 1)
        return rank, bucket[0]


class SharedRankQueue:
    """Positions of many pre-tokens by rank, in arrays; ``pop`` gives all that the lowest rank has."""

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> RankQueue.WIDTH) + 1)
        self.root = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not ranks.size:
            return
        order = ranks.argsort(kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = (np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist()
        starts = [0, *cuts]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*cuts, len(ranks)]):
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(positions[a:b])
                continue
            self.buckets[rank] = [positions[a:b]]
            self.words[rank >> 8] |= BITS[rank & 255]
            self.root |= 1 << (rank >> 8)

    def pop(self) -> tuple[int, np.ndarray]:
        first = self.root & -self.root
        word = first.bit_length() - 1
        bits = self.words[word]
        lowest = bits & -bits
        rank = word << 8 | (lowest.bit_length() - 1)
        self.words[word] = bits ^ lowest
        if bits == lowest:
            self.root ^= first
        bucket = self.buckets.pop(rank)
        return rank, bucket[0] if len(bucket) == 1 else np.concatenate(bucket)


class PairRanks:
    """The rank of a pair of neighbouring tokens, -1 if they don't merge; ``none`` merges with nothing."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * (self.none + 1) + right] = rank
        keys = np.array([*pairs, np.iinfo(np.int64).max], np.int64)
        order = keys.argsort()
        self.keys, self.ranks = keys[order], np.array([*pairs.values(), -1], np.int32)[order]

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * (self.none + 1) + right
        at = self.keys.searchsorted(keys)
        return np.where(self.keys[at] == keys, self.ranks[at], np.int32(-1))


class BytePairEncoder:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.byte_ranks = [self.ranks.get(bytes([b])) for b in range(256)]
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.pair_ranks: PairRanks | None = None

    def encode_piece(self, piece: bytes) -> list[int]:
        rank_of = self.ranks.get
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        last = n - 1
        ids = [self.byte_ranks[b] for b in piece]  # the rank of the token that begins at i
        end = list(range(1, n + 1))  # the token at i is piece[i:end[i]]
        before = list(range(-1, n))
        pair = [rank_of(piece[i : i + 2], -1) for i in range(last)]  # rank of the pair that begins at i; -1: none
        pair.append(-1)
        live = n - pair.count(-1)
        queue = self.queue
        words, buckets, root = queue.words, queue.buckets, 0
        # RankQueue's push and pop, written out: nearly all pieces are short, and calls would cost more than the work
        for i in range(last):
            rank = pair[i]
            if rank >= 0:
                bucket = buckets.get(rank)
                if bucket is not None:
                    bucket.append(i)  # ascending: a heap already
                else:
                    buckets[rank] = [i]
                    word = rank >> 8
                    words[word] |= BITS[rank & 255]
                    root |= 1 << word
        while live > 0:
            first = root & -root
            word = first.bit_length() - 1
            bits = words[word]
            lowest = bits & -bits
            rank = word << 8 | (lowest.bit_length() - 1)
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[word] = bits = bits ^ lowest
                if not bits:
                    root ^= first
            if pair[i] != rank:
                continue  # stale: one of the two has grown or was merged into its left neighbour
            middle = end[i]
            right = end[middle]
            ids[i], end[i] = rank, right
            live -= 1
            if pair[middle] >= 0:
                pair[middle] = -1
                live -= 1
            if right < n:
                before[right] = i
                new = pair[i] = rank_of(piece[i : end[right]], -1)
                if new >= 0:
                    live += 1
                    bucket = buckets.get(new)
                    if bucket is not None:
                        heappush(bucket, i)
                    else:
                        buckets[new] = [i]
                        word = new >> 8
                        words[word] |= BITS[new & 255]
                        root |= 1 << word
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                if pair[left] >= 0:
                    live -= 1
                new = pair[left] = rank_of(piece[left:right], -1)
                if new >= 0:
                    live += 1
                    bucket = buckets.get(new)
                    if bucket is not None:
                        heappush(bucket, left)
                    else:
                        buckets[new] = [left]
                        word = new >> 8
                        words[word] |= BITS[new & 255]
                        root |= 1 << word
        for rank in buckets:  # only stale entries are left
            words[rank >> 8] = 0
        buckets.clear()
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = end[i]
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """``encode_piece`` of each."""
        out = [self.encode_piece(p) if p in self.ranks or len(p) > LONG else None for p in pieces]
        rest = [p for p, ids in zip(pieces, out) if ids is None]
        if len(rest) < FEW or None in self.byte_ranks:
            coded = map(self.encode_piece, rest)
        else:
            coded = self._encode_together(rest)
        return [next(coded) if ids is None else ids for ids in out]

    def _encode_together(self, pieces: list[bytes]) -> Iterator[list[int]]:
        if self.pair_ranks is None:
            self.pair_ranks = PairRanks(self.ranks)
        rank_of, none = self.pair_ranks, self.pair_ranks.none
        # a position for each byte and one before, between and after the pieces, whose token is none
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.array(self.byte_ranks, np.int32)[np.frombuffer(b"\0%b\0" % b"\0".join(pieces), np.uint8)]
        ids[np.append(0, (lengths + 1).cumsum())] = none
        n = len(ids)
        owner = np.repeat(np.arange(len(pieces) + 1, dtype=np.int32), np.append(lengths + 1, 1))
        end = np.arange(1, n + 1, dtype=np.int32)  # where the next token begins
        before = np.arange(-1, n - 1, dtype=np.int32)
        pair = np.append(rank_of(ids[:-1], ids[1:]), np.int32(-1))
        queue = SharedRankQueue(none)
        positions = np.flatnonzero(pair >= 0).astype(np.int32)
        queue.push(pair[positions], positions)
        while queue.root:
            rank, i = queue.pop()
            i = i[pair[i] == rank]  # without the stale
            if i.size > 1:  # of each piece the leftmost: its merge may bring a lower rank, or take the next one's token
                i.sort()
                whose = owner[i]
                first = np.append(True, whose[1:] != whose[:-1])
                if not first.all():
                    later = i[~first]
                    queue.push(pair[later], later)
                    i = i[first]
            middle = end[i]
            right = end[middle]
            ids[i], end[i], before[right] = rank, right, i
            ids[middle] = pair[middle] = -1
            changed = np.concatenate((before[i], i))
            pair[changed] = new = rank_of(ids[changed], ids[end[changed]])
            merging = new >= 0
            queue.push(new[merging], changed[merging])
        tokens = (ids >= 0) & (ids != none)
        flat, stop = ids[tokens].tolist(), 0
        for count in np.bincount(owner[tokens], minlength=len(pieces)).tolist():
            start, stop = stop, stop + count
            yield flat[start:stop]

    def encode(self, text: str) -> list[int]:
        return [i for piece in split(text) for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PieceMemo:
    """The decimal ids and the decoded bytes of pre-tokens, in lists that stay empty until ``fill``."""

    def __init__(self, bpe: BytePairEncoder):
        self.bpe, self.memo = bpe, Memo(self._later)
        self.waiting: list[tuple[bytes, list]] = []
        self.size = 0

    def _later(self, piece: str) -> list:
        data, coded = piece.encode(), []
        self.waiting.append((data, coded))
        self.size += len(data)
        if self.size >= WAITING:
            self.fill()
        return coded

    def fill(self) -> None:
        bpe = self.bpe
        for (_, coded), ids in zip(self.waiting, bpe.encode_pieces([data for data, _ in self.waiting])):
            coded[:] = " ".join(map(str, ids)), bpe.decode(ids)
        self.waiting, self.size = [], 0


_ENCODERS: dict[str, BytePairEncoder] = {}
_PIECES: dict[str, PieceMemo] = {}


def encoder(path: str) -> BytePairEncoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BytePairEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    path = path or public_tokenizers.path(RANKS)

    def make():
        bpe = encoder(path)
        return lambda doc_id, text: [(doc_id, bpe.encode(text or ""))]

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), "doc_id long, ids array<int>", make)


def decode_documents(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids",
                     path: str | None = None) -> DataFrame:
    """(doc_id, data): the bytes that the ids stand for; null ids count as none."""
    path = path or public_tokenizers.path(RANKS)

    def make():
        bpe = encoder(path)
        return lambda doc_id, ids: [(doc_id, bpe.decode(ids or []))]

    return map_rows(tokens.select(F.col(id_col).cast("long"), F.col(ids_col)), "doc_id long, data binary", make)


def roundtrip_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      path: str | None = None) -> DataFrame:
    """Encode and decode every whole text in one pass: token count, digest of the decimal ids
    joined by one space, digest of the decoded bytes."""
    path = path or public_tokenizers.path(RANKS)

    def make():
        if path not in _PIECES:
            _PIECES[path] = PieceMemo(encoder(path))
        pieces = _PIECES[path]

        def digests(held):
            pieces.fill()
            for doc_id, coded in held:
                ids = " ".join([a for a, _ in coded]).encode()
                yield (doc_id, ids.count(b" ") + bool(ids), hashlib.sha256(ids).hexdigest(),
                       hashlib.sha256(b"".join([b for _, b in coded])).hexdigest())

        def run(rows):
            held, n = [], 0
            for doc_id, text in rows:
                coded = list(map(pieces.memo.__getitem__, split(text or "")))
                held.append((doc_id, coded))
                n += len(coded)
                if n >= HELD:
                    yield from digests(held)
                    held, n = [], 0
            yield from digests(held)

        return run

    return map_batches(docs.select(F.col(id_col).cast("long"), F.col(text_col)),
                       "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
