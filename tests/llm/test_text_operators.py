"""License scan, byte-pair encoding, chat formatting and token counts against plain versions."""

import base64
import functools
import hashlib
import random
import re
import time

import public_tokenizers
import pytest
import regex
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat_parts, license_scan, rank_queue_bpe, token_count
from strata.llm.pretokens import split

HARD = ["", " ", "  a  b", "a\nb\n\n c", "日本語 ▁x", "\x1c \x85 x\xa0y", "a" * 5000, "ab" * 3000, "x" + " " * 50 + "y",
        "it's I'll 12345 ²³ ½", "<s> </s> <unk> <0x0A>", "🙂🙂 é́", "\t\t x\r\n", "abcdefgh" * 2000 + " z"]
texts = st.text(alphabet=st.sampled_from("aehinrst ABZ \n.,'▁À²0🙂|é\t"), max_size=120)


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, "x") for i, t in enumerate(HARD)] + [(None, "mit license", "x"), (99, None, None), (3, "a\nb\n\n c", "x")]
    # a column whose name clashes with the results
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def rows(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


# ---- byte-pair encoding


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(rank_queue_bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@given(texts)
@settings(max_examples=150, deadline=None)
def test_encoding_is_the_library_s(text):
    bpe = rank_queue_bpe.encoder(public_tokenizers.path(rank_queue_bpe.RANKS))
    ids = bpe.encode(text)
    assert ids == library(bpe).encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@given(texts)
@settings(max_examples=100, deadline=None)
def test_split_is_the_pattern_s(text):
    assert split(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_roundtrip_digests(frame, reference):
    got = sorted(map(tuple, rank_queue_bpe.roundtrip_digests(frame).collect()), key=str)
    want = []
    for doc_id, text in rows(frame):
        ids = reference.encode_ordinary(text)
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_then_decode(frame):
    back = rank_queue_bpe.decode_documents(rank_queue_bpe.encode_documents(frame))
    assert sorted(((r.doc_id, bytes(r.data)) for r in back.collect()), key=str) == sorted(
        ((i, t.encode()) for i, t in rows(frame)), key=str)


def test_queue_gives_lowest_rank_leftmost():
    queue = rank_queue_bpe.RankQueue(50_000)
    for rank, place in [(49_999, 1), (3, 9), (3, 2), (256, 5), (0, 7)]:
        queue.push(rank, place)
    assert [queue.pop() for _ in range(5)] == [(0, 7), (3, 2), (3, 9), (256, 5), (49_999, 1)]
    assert not queue.root


# ---- token counts


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_count.MODEL))


def test_counts_are_the_library_s(frame, model):
    got = sorted(map(tuple, token_count.count_tokens(frame).collect()), key=str)
    want = [(i, len(t.encode()), len(model.encode(t)), len(model.encode(t)) > 4096) for i, t in rows(frame)]
    assert got == sorted(want, key=str)


@given(texts, st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_chunks_compose(text, chunk):
    counter = token_count.counter(public_tokenizers.path(token_count.MODEL))
    model = test_chunks_compose.__dict__.setdefault(
        "model", sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_count.MODEL)))
    counter.chunk, before = chunk, counter.chunk
    try:
        assert counter.count(text) == len(model.encode(text))
    finally:
        counter.chunk = before


def test_transducer_is_bounded_on_one_long_word():
    transducer = token_count.CountTransducer(public_tokenizers.path(token_count.MODEL))
    transducer.count_part("ab" * 20_000)
    assert len(transducer.moves) < 200


# ---- license scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    places = []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return (len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
            ",".join(sorted({n for _, n in places})))


LICENSES = ["Released under the MIT License. MIT license mit LICENSE", "Licenced undr the Apache Licence, Version 2.0",
            "GNU General-Public\nLicense, version 3", "mitlicense emit license mit licensed", "é MIT  license\u2003x", "mit license" * 3,
            "Licensed under CC BY-NC 4.0.", "", "general public general public license"]


def test_base_phrases_and_labels(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*LICENSES, None])], "doc_id long, text string, labels int")
    got = {r.doc_id: r for r in license_scan.license_scan(df).collect()}
    for i, t in enumerate([*LICENSES, ""]):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(t), t
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert "apache-2.0" in got[1].labels and got[1].base_labels == "" and 0.8 < got[1].score < 1
    assert got[6].labels == "cc-by-nc-4.0" and got[6].score == 1


@given(st.lists(st.sampled_from(["released", "undr", "under", "the", "mit", "license", "licence", "licens", "x", "gnu", "general",
                                 "public", "version", "3", "all", "rights", "reserved", "rigths"]), max_size=25))
@settings(max_examples=100, deadline=None)
def test_seeds_lose_no_match(words):
    """Without seeds: every notice searched over the whole string."""
    scanner = license_scan.NoticeScanner()
    text, _ = license_scan.word_string(" ".join(words))
    found = {h.label for h in scanner.scan(text)}
    assert found == {n.label for n, p in zip(scanner.notices, scanner.patterns) if p.search(text)}


def all_spans(scanner, text):
    """(label, start, end) of every notice in the whole string, best first, then left and right of it."""
    def search(p, lo, hi):
        m = p.search(text, lo, hi)
        if not m:
            return []
        left, right = m.start() + (text[m.start()] == " "), m.end() - (text[m.end() - 1] == " ")
        return [(m.start(), m.end()), *search(p, lo, left), *search(p, right, hi)]
    return {(i, *s) for i, p in enumerate(scanner.patterns) for s in search(p, 0, len(text))}


@given(st.lists(st.sampled_from(["released under the mit license", "released under the mit licence", "licensd undr the mit license",
                                 "mit license", "gnu general public license version 3", "gnu genral public licence version 2",
                                 "all rights reserved", "al rights reserved", "x", "of the foo"]), max_size=12))
@settings(max_examples=100, deadline=None)
def test_seeds_lose_no_span(parts):
    scanner = license_scan.NoticeScanner()
    text, _ = license_scan.word_string(" ".join(parts))
    found = {(i, m.start(), m.end()) for i, lo, hi in scanner.windows(text) for m in scanner.matches(i, text, lo, hi)}
    assert found == all_spans(scanner, text)


@pytest.mark.parametrize("words", ["foo released under the mit licence x released under the mit license bar",
                                   "foo released under the mit license x released under the mit licence bar",
                                   "released undr the mit licence released under the mit license released undr the mit licence"])
def test_worse_notices_beside_better_ones(words):
    scanner = license_scan.NoticeScanner([license_scan.Notice("mit", "released under the mit license", 3)])
    hits = scanner.scan(license_scan.word_string(words)[0])
    assert [h.first for h in hits] == [i for i, w in enumerate(words.split()) if w == "released"]
    assert [h.edits for h in hits] == [{"under license": 0, "under licence": 1, "undr licence": 2}[f"{u} {n}"]
                                       for u, n in re.findall(r"released (\w+) the mit (\w+)", words)]


@pytest.mark.parametrize("chunk, states", [(1, 100_000), (7, 100_000), (50, 60), (200, 40)])
def test_chunk_maps_compose_to_the_whole(chunk, states):
    """Texts cut anywhere, also within words and between starts of the machine: the counts of the library."""
    rng = random.Random(chunk)
    path = public_tokenizers.path(token_count.MODEL)
    library, tokens = sentencepiece.SentencePieceProcessor(model_file=path), token_count.TokenCounter(path, chunk)
    tokens.transducer.max_states = states
    alphabets = ["abcdefgh ", "theranind  .,\n1é🙂ß漢", ["the", "ing", "and", " ", "x", "aaa", "  "], "-", "ab"]
    for i in range(120):
        text = "".join(rng.choice(alphabets[i % 5]) for _ in range(rng.randrange(300)))
        assert tokens.count(text) == len(library.encode(text)), text
        assert len(tokens.transducer.moves) <= states + tokens.transducer.longest + 1


def test_state_maps_do_not_depend_on_how_they_are_composed():
    tokens = token_count.TokenCounter(public_tokenizers.path(token_count.MODEL), 10)
    text = token_count.SPACE + "unbrokenlettersthatgoonandon" * 3 + token_count.SPACE + "and" + token_count.SPACE + "another" * 9
    maps = [tokens.chunk_map(text[i:i + 10]) for i in range(0, len(text), 10)]
    left = right = None
    for m in maps:
        left = m if left is None else tokens.compose(left, m)
    for m in reversed(maps):
        right = m if right is None else tokens.compose(m, right)
    assert left.count + (left.inside or 0) == right.count + (right.inside or 0) == tokens.chunk_map(text).count + tokens.chunk_map(text).inside


def test_one_long_varied_word_keeps_the_bound():
    tokens = token_count.TokenCounter(public_tokenizers.path(token_count.MODEL))
    tokens.transducer.max_states = 5_000
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_count.MODEL))
    assert tokens.count(word) == len(library.encode(word))
    assert len(tokens.transducer.moves) <= 5_000 + tokens.transducer.longest + 1


@pytest.mark.parametrize("part", ["released under the mit licence x", "licensed undr the mit license", "mit license", "al rights reserved of the foo"])
def test_long_texts_full_of_notices(part):
    """Twice the text takes about twice the time, and no notice is lost."""
    scanner = license_scan.NoticeScanner()

    def took(n):
        text, _ = license_scan.word_string(" ".join([part] * n))
        begun = time.monotonic()
        hits = scanner.scan(text)
        assert len({h.first for h in hits}) >= n
        return time.monotonic() - begun

    took(50)
    assert took(4000) < 3 * took(2000) + 1


# ---- chat formatting


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b", "", "### x: "]),
                          st.text(alphabet=st.sampled_from("\\#</turn>|i: \nA"), max_size=40)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_turns_read_back(turns):
    formatted, spans, _ = chat_parts.format_turns([(r, [{"type": "text", "text": t}]) for r, t in turns])
    assert chat_parts.read_turns(formatted) == turns
    assert chat_parts.read_masked(formatted, spans) == "".join(t for r, t in turns if r == "assistant")


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.lists(
    st.sampled_from(["</tu", "rn>", "\n", "##", "#", "# assistant: evil", " ", "<", "|image:0|>", "\\", None]), max_size=8)), max_size=4))
@settings(max_examples=300, deadline=None)
def test_texts_cannot_write_marks_together(turns):
    """Text parts, images between some of them: no part completes another's mark."""
    def parts(texts):
        return [{"type": "image", "ref": "a"} if t is None else {"type": "text", "text": t} for t in texts]

    formatted, spans, attached = chat_parts.format_turns([(r, parts(ts)) for r, ts in turns])
    back, place, told = chat_parts.read_turns(formatted), 0, []
    for role, texts in turns:
        said = ""
        for t in texts:
            said += f"<|image:{place}|>" if t is None else t
            place += t is None
        told.append((role, said))
    assert back == told and len(attached) == place
    bare = re.findall(r"\\.|(### |</turn>)", formatted, flags=re.DOTALL)
    assert len([b for b in bare if b]) == 2 * len(turns)
    assert [m[1] for m in chat_parts._PLACEHOLDER.finditer(formatted) if m[1]] == ["image"] * place


def test_unknown_and_null_parts_in_a_table(spark):
    df = spark.createDataFrame([(1, 0, "user", [("text", "a ", None, None), ("Holo gram|>", None, "x.h", 3), None, ("image", None, "b", 1)]),
                                (2, 0, "user", None)], f"conv_id long, turn long, role string, parts {chat_parts.PARTS}")
    rows = {r.conv_id: r for r in chat_parts.format_chats(df, rates={"Holo gram|>": 7}).collect()}
    assert rows[1].formatted == "### user: a <|unknown:0|><|image:1|> </turn>\n"
    assert [tuple(a) for a in rows[1].attachments] == [(0, "Holo gram|>", "x.h", 21), (1, "image", "b", 256)]
    assert rows[2].formatted == "### user:  </turn>\n"


def test_typed_parts_keep_order(spark):
    parts = [{"type": "text", "text": "see <|image:0|>"}, {"type": "image", "ref": "a.png", "units": 2},
             {"type": "audio", "ref": "b.wav"}, {"type": None, "text": None}, {"type": "document", "ref": None, "units": 1}]
    formatted, _, attached = chat_parts.format_turns([("user", parts)])
    assert formatted == r"### user: see \<|image:0|><|image:0|><|audio:1|><|document:2|> </turn>" + "\n"
    assert [(a.place, a.kind, a.ref, a.tokens) for a in attached] == [
        (0, "image", "a.png", 512), (1, "audio", "b.wav", 25), (2, "document", "", 512)]
    with pytest.raises(ValueError):
        chat_parts.format_turns([("user", [{"type": "hologram"}])])


def test_conversation_rows(spark):
    df = spark.createDataFrame([(1, 2, "assistant", "b"), (1, 0, "user", None), (1, None, None, "n"), (None, 0, "user", "q"),
                                (1, 2, "assistant", "b"), (1, 2, "assistant", "a")],
                               "conv_id long, turn long, role string, text string").withColumnRenamed("turn", "turn")
    df = df.withColumn("parts", chat_parts.text_part(df["text"]))
    got = {r.conv_id: r for r in chat_parts.read_back(chat_parts.format_chats(df)).collect()}
    told = "\nn\nuser\n\nassistant\na\nassistant\nb\nassistant\nb\n"
    assert got[1].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert got[1].loss_chars == 3 and got[None].n_turns == 1


@pytest.mark.parametrize("run", [license_scan.license_scan, rank_queue_bpe.roundtrip_digests, token_count.count_tokens])
def test_empty_table(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).count() == 0
