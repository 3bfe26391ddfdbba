import base64
import hashlib
import itertools
import random

import public_tokenizers
import tiktoken

from strata.llm import rank_queue_bpe


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_stale_entries_cost_no_lookup():
    """One lookup for the piece and for each pair of neighbours that ever stands there: what is stale is told by the
    pair's rank, and the queue is empty afterwards."""
    bpe = rank_queue_bpe.BytePairEncoder(public_tokenizers.path(rank_queue_bpe.RANKS))
    bpe.ranks = Counted(bpe.ranks)
    r = random.Random(3)
    for n in [1, 2, 3, 9, 40, 400]:
        piece = "".join(r.choice("aeinrst\u00e9") for _ in range(n)).encode()
        bpe.ranks.asked = 0
        ids = bpe.encode_piece(piece)
        merges = len(piece) - len(ids)
        assert bpe.decode(ids) == piece
        assert bpe.ranks.asked <= 1 + (len(piece) - 1) + 2 * merges
        assert not bpe.queue.buckets and not any(bpe.queue.words)
    assert bpe.encode_piece(b"") == []


def words(r, n):
    parts = ["th", "er", "\u00e9", "ing", "st", "\u4e2d", "a", "aa", "\0", "E", "on", "\U0001f600", "7", "  "]
    return ["".join(r.choices(parts, k=r.randint(1, 9))).encode() for _ in range(n)]


def test_many_pieces_share_a_queue(monkeypatch):
    """A rank's merges are made in all pieces at once: one pop serves many merges, and no pair is looked up by itself."""
    bpe = rank_queue_bpe.BytePairEncoder(public_tokenizers.path(rank_queue_bpe.RANKS))
    pieces = [*words(random.Random(4), 20_000), b"", b"a", b"a" * 64, b"ab" * 128, b"aab" * 200]
    want = [bpe.encode_piece(p) for p in pieces]
    bpe.encode_pieces(pieces[:3000])  # makes the table of pairs
    pops = []
    pop = rank_queue_bpe.SharedRankQueue.pop
    monkeypatch.setattr(rank_queue_bpe.SharedRankQueue, "pop", lambda queue: pops.append(1) or pop(queue))
    short = pieces[:-1]
    bpe.ranks = Counted(bpe.ranks)
    assert bpe.encode_pieces(short) == want[:-1]
    merges = sum(len(p) - len(ids) for p, ids in zip(short, want) if p not in bpe.ranks)
    assert 0 < len(pops) < merges / 50
    assert bpe.ranks.asked <= sum(p in bpe.ranks for p in short)  # whole pieces only
    assert bpe.encode_pieces(pieces) == want


def test_any_ranks(tmp_path, monkeypatch):
    """Ranks in any order, so that merges bring lower ones and equal pairs overlap: the ids are the library's."""
    monkeypatch.setattr(rank_queue_bpe, "FEW", 0)
    for seed in range(30):
        r = random.Random(seed)
        tokens = ["".join(t) for n in (2, 3, 4, 5) for t in itertools.product("abc"[: r.randint(1, 3)], repeat=n)]
        tokens = r.sample(tokens, r.randint(1, len(tokens)))
        ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(tokens)}
        file = tmp_path / f"{seed}.tiktoken"
        file.write_bytes(b"".join(b"%b %d\n" % (base64.b64encode(t), i) for t, i in ranks.items()))
        bpe = rank_queue_bpe.BytePairEncoder(str(file))
        library = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
        pieces = ["".join(r.choices("abc", weights=[5, 2, 1], k=r.randint(1, 40))) for _ in range(200)]
        assert bpe.encode_pieces([p.encode() for p in pieces]) == [library.encode_ordinary(p) for p in pieces]


def test_waiting_pieces_are_filled(spark, monkeypatch):
    """Digests whatever the bounds: each row's pre-tokens are filled before its digest, with pieces that the memo
    doesn't keep, repeated rows and null."""
    r = random.Random(5)
    texts = [" ".join(w.decode() for w in words(r, r.randint(0, 60))) for _ in range(120)] + ["x" * 300, "x" * 300, None, ""]
    texts += texts[:20]
    path = public_tokenizers.path(rank_queue_bpe.RANKS)
    bpe = rank_queue_bpe.encoder(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    pieces = rank_queue_bpe.PieceMemo(bpe)
    monkeypatch.setattr(rank_queue_bpe, "WAITING", 100)
    monkeypatch.setattr(rank_queue_bpe, "FEW", 0)
    held = [[pieces.memo[p] for p in rank_queue_bpe.split(t or "")] for t in texts]
    pieces.fill()
    for text, coded in zip(texts, held):
        ids = library.encode_ordinary(text or "")
        assert " ".join(a for a, _ in coded) == " ".join(map(str, ids))
        assert b"".join(b for _, b in coded) == (text or "").encode()
    assert not pieces.waiting and not pieces.size
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {row.doc_id: row for row in rank_queue_bpe.roundtrip_digests(df).collect()}
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())
