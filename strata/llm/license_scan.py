"""License scans: fuzzy search for short notices.

A text becomes its words (ASCII letters lower-cased) with one space around each.  A notice
that may hold up to ``k`` character edits is cut into ``k + 1`` pieces: by the pigeonhole
principle one piece survives unedited, so one Aho-Corasick pass over the pieces finds every
place where the notice can be.  Only these windows go to the ``regex`` library, whose
bounded-error matching (``{e<=k}``, best match) confirms the notice and reports its span; what
is left on either side of a match is searched again, until a window holds no further match.
The time follows the length of the text, also where a long text is full of notices.
A base phrase is a notice with no edits: its one piece is the phrase itself.

One map over the rows, no shuffle.  Null text counts as empty, a null id is kept, repeated
rows give repeated results, other columns of the input are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows


class Notice(NamedTuple):
    label: str
    words: str
    edits: int
    base: bool = False


# The base phrases and their labels.
BASE = (
    Notice("mit", "mit license", 0, True),
    Notice("apache", "apache license", 0, True),
    Notice("gpl", "general public license", 0, True),
)

# Short notices as they stand in files, in words; about one edit per ten characters.
NOTICES = (
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "licensed under the mit license", 3),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 7),
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("gpl-2.0", "gnu general public license version 2", 3),
    Notice("gpl-3.0", "gnu general public license version 3", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 7),
    Notice("mpl-2.0", "mozilla public license version 2 0", 3),
    Notice("cc-by-4.0", "licensed under cc by 4 0", 1),
    Notice("cc-by-sa-4.0", "licensed under cc by sa 4 0", 1),
    Notice("cc-by-nc-4.0", "licensed under cc by nc 4 0", 1),
    Notice("cc0", "dedicated to the public domain under cc0", 3),
    Notice("unlicense", "free and unencumbered software released into the public domain", 6),
    Notice("proprietary", "all rights reserved", 1),
)

# A-Z to a-z, every other ASCII character that is no letter or digit to a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Hit(NamedTuple):
    label: str
    first: int  # word the match starts in
    last: int  # word it ends in
    edits: int
    score: float
    base: bool


def word_string(text: str | None) -> tuple[str, int]:
    """The words with a space before, between and after them, and their number."""
    words = (text or "").encode().translate(_TABLE).split()
    return f" {b' '.join(words).decode()} ", len(words)


def pieces(text: str, n: int) -> list[tuple[int, str]]:
    """``text`` cut into ``n`` parts of nearly equal length, with their offsets."""
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


class NoticeScanner:
    def __init__(self, notices=BASE + NOTICES):
        self.notices = notices
        self.patterns = [regex.compile(f"(?b)(?: {regex.escape(n.words, literal_spaces=True)} ){{e<={n.edits}}}")
                         for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for offset, piece in pieces(f" {n.words} ", n.edits + 1):
                seeds.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def windows(self, words: str) -> Iterator[tuple[int, int, int]]:
        """(notice, from, to) of the places where a seed of the notice stands, merged where they overlap."""
        places: dict[int, list[tuple[int, int]]] = {}
        for end, (length, seeds) in self.automaton.iter(words):
            for i, offset in seeds:
                k, begin = self.notices[i].edits, end + 1 - length - offset
                places.setdefault(i, []).append((max(0, begin - k), begin + len(self.notices[i].words) + 2 + k))
        for i, of in places.items():
            of.sort()
            lo, hi = of[0]
            for begin, end in of[1:]:
                if begin <= hi and not self.notices[i].base:
                    hi = max(hi, end)
                else:
                    yield i, lo, hi
                    lo, hi = begin, end
            yield i, lo, hi

    def matches(self, i: int, words: str, lo: int, hi: int) -> Iterator[regex.Match]:
        """The best match of a notice, then those in what lies to its left and to its right, and so on; the
        space between two notices is part of both.

        No match is longer than the notice and its edits, so the window is searched in stretches that overlap by
        as much; the best of all stretches is the window's.  What it leaves of the stretches that it touches is
        searched again, so the time follows the window's length, not its square."""
        most = len(self.notices[i].words) + 2 + self.notices[i].edits
        found: list = []  # heap of the best match of each stretch that is left
        looked = 0
        taken: list[tuple[int, int]] = []  # places of the matches so far, without the spaces around them

        def look(lo: int, hi: int) -> None:
            nonlocal looked
            m = self.patterns[i].search(words, lo, hi)
            if m:
                looked += 1
                heappush(found, (sum(m.fuzzy_counts), m.start(), m.end(), looked, lo, hi, m))

        def free(lo: int, hi: int) -> list[tuple[int, int]]:
            """What the matches so far leave of a stretch."""
            out, at = [], bisect_right(taken, (lo, lo))
            at -= at > 0 and taken[at - 1][1] > lo
            while at < len(taken) and taken[at][0] < hi:
                out.append((lo, taken[at][0]))
                lo = taken[at][1]
                at += 1
            return [(x, y) for x, y in [*out, (lo, hi)] if x < y]

        for at in range(lo, max(lo + 1, hi - most), 2 * most):
            look(at, min(hi, at + 3 * most))
        while found:
            _, start, end, _, lo, hi, m = heappop(found)
            if any(x <= start and end <= y for x, y in free(lo, hi)):
                yield m
                insort(taken, (start + (words[start] == " "), end - (words[end - 1] == " ")))
            for x, y in free(lo, hi):
                look(x, y)

    def scan(self, words: str) -> list[Hit]:
        hits, blanks = set(), None
        for i, lo, hi in self.windows(words):
            notice = self.notices[i]
            for m in self.matches(i, words, lo, hi):
                if blanks is None:
                    blanks = [b.start() for b in re.finditer(" ", words)]
                start, end, edits = m.start(), m.end(), sum(m.fuzzy_counts)
                first = bisect_right(blanks, start) - 1
                last = max(first, bisect_left(blanks, max(end - 1, start + 1)) - 1)
                hits.add(Hit(notice.label, max(first, 0), last, edits,
                             1 - edits / (len(notice.words) + 2), notice.base))
        return sorted(hits)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, notices array<struct<label:string,first_word:int,last_word:int,edits:int>>")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices=BASE + NOTICES) -> DataFrame:
    """Per row: word count, places of the base phrases, labels, the best score (1 for an exact
    notice, less by the share of edited characters, 0 for none) and all notice spans in words."""

    def make():
        scanner = NoticeScanner(notices)

        def row(doc_id, text):
            words, n = word_string(text)
            hits = scanner.scan(words)
            base = [h for h in hits if h.base]
            starts = [h.first for h in base]
            yield (doc_id, n, len(base), min(starts, default=None), max(starts, default=None),
                   ",".join(sorted({h.label for h in base})), ",".join(sorted({h.label for h in hits})),
                   max((h.score for h in hits), default=0.0),
                   [{"label": h.label, "first_word": h.first, "last_word": h.last, "edits": h.edits} for h in hits])

        return row

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), SCHEMA, make)
