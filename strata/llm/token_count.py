"""Token counts by a finite-state transducer.

A SentencePiece BPE vocabulary is compiled, as the texts ask for it, into a deterministic
transducer over characters.  A state says which token would end at each of the last few
characters (no token is longer than ``longest``) and how many tokens each of these endings
would make; a transition on a character picks the one token that may end there, and carries
the change of the token count as its output.  The token that ends at a position is the one
whose neighbour to the left can stand beside it, i.e. whose pair encodes to itself; such
sequences are exactly the merges' results.  The sum of the outputs along a word is its count.

A long text is cut into chunks, also within words.  A chunk's state map says, for any state in
which the machine may enter it, how many tokens are emitted and in which state it leaves.  Between
characters that no token spans (at least at every start of a run of spaces) the machine starts
anew whatever came before; so the map is what follows the first such place, which no entry
changes, and the part before it.  Of that part it keeps the path from the start state: another
entry is followed only until it meets this path, mostly after a few characters, and has its
counts from there.  Maps compose associatively; a prefix scan, halving the number of maps at each
step, gives the count of the text.

The machine has at most ``max_states`` states and begins anew when they are used up, also within
a word, of which it keeps the last ``longest``.

One map over the rows; word counts are kept in a bounded memo per Python worker.  Null text
counts as empty, repeated rows give repeated results.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Memo, map_rows

MODEL = "piece_bpe_32k.model"
ONE = (1,)
SPACE = "▁"  # the mark that stands for a space inside pieces


class CountTransducer:
    def __init__(self, path: str, max_states: int = 400_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = lambda i: model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i) or model.IsUnused(i)
        self.rank = {model.IdToPiece(i): -model.GetScore(i) for i in range(model.GetPieceSize()) if not special(i)}
        self.known = {c for p in self.rank for c in p}
        self.longest = max(map(len, self.rank))
        #: lengths of the tokens with these last two characters, shortest first
        self.lengths: dict[str, tuple[int, ...]] = {}
        for piece in sorted(self.rank, key=len):
            if len(piece) > 1 and self.lengths.get(piece[-2:], ONE)[-1] < len(piece):
                self.lengths[piece[-2:]] = self.lengths.get(piece[-2:], ONE) + (len(piece),)
        #: characters that stand side by side in some token; between any others, a text falls apart
        self.joined = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece holds a space after other characters: words can't be counted alone")
        self.beside: dict[tuple[str, str], bool] = {}
        self.max_states = max_states
        self.generation = 0
        self.start()

    def start(self) -> None:
        """Only the first state: the start of a word."""
        self.generation += 1
        #: per state: the token that ends there, the count, the state one character before, characters since the start
        self.token, self.count, self.parent, self.depth = [""], [0], [-1], [0]
        self.tail = [""]  # the last characters, as many as a token can have before the next
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.far: dict[tuple, int] = {}

    def merged(self, text: str) -> list[str]:
        """The merges' result for a short text: lowest rank first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            rank, i = min(((self.rank.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if rank == float("inf"):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        pair = left, right
        if pair not in self.beside:
            if len(self.beside) > 1_000_000:
                self.beside.clear()
            self.beside[pair] = self.merged(left + right) == [left, right]
        return self.beside[pair]

    def step(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the change of the count; made when first asked for.  If there are no more states
        to be had, the machine begins anew and goes on from what the next tokens can see of this one."""
        if len(self.moves) >= self.max_states:
            seen = self.snapshot(state)
            self.start()
            state = self.enter(seen)
            if char in self.moves[state]:
                return self.moves[state][char]
        if char not in self.known:  # falls back to its bytes
            self.moves[state][char] = 0, len(char.encode())
            return self.moves[state][char]
        if state and self.anew(self.tail[state][-1], char):
            found = self.moves[0].get(char) or self.step(0, char)
            self.moves[state][char] = found
            return found
        text, depth = self.tail[state] + char, self.depth[state] + 1
        before, back = state, 1
        token, count = "", 0
        for length in self.lengths.get(text[-2:], ONE):
            if length > depth:
                break
            while back < length:
                before, back = self.parent[before], back + 1
            token = text[-length:]
            if token in self.rank or length == 1:
                if length == depth:
                    if self.merged(token) == [token]:
                        count = 1
                        break
                elif self.fits(self.token[before], token):
                    count = self.count[before] + 1
                    break
        if not count:
            raise ValueError(f"no token can end after {text!r}")
        delta = count - self.count[state]
        self.moves[state][char] = found = self.reach(state, token, count, text[1 - self.longest:], depth), delta
        return found

    def reach(self, parent: int, token: str, count: int, tail: str, depth: int) -> int:
        """The new state; far from the start of the word, only what the next tokens can see tells
        states apart, and one that was met before is taken again, so a long word needs few."""
        if depth >= self.longest:
            seen, state = [(token, 0)], parent
            for _ in range(self.longest - 1):
                seen.append((self.token[state], self.count[state] - count))
                state = self.parent[state]
            key = tail, tuple(seen)
            if key in self.far:
                return self.far[key]
            self.far[key] = len(self.token)
        for column, value in ((self.token, token), (self.count, count), (self.parent, parent), (self.depth, depth),
                              (self.tail, tail), (self.moves, {})):
            column.append(value)
        return len(self.token) - 1

    def snapshot(self, state: int) -> list[tuple[str, int, int, str]]:
        """What the next tokens can see of a state: it and those before it, newest first."""
        out = []
        while state > 0 and len(out) < self.longest:
            out.append((self.token[state], self.count[state], self.depth[state], self.tail[state]))
            state = self.parent[state]
        return out

    def enter(self, seen: list[tuple[str, int, int, str]]) -> int:
        """The state of a snapshot, after the machine began anew."""
        state = 0 if not seen or seen[-1][2] == 1 else -1
        for token, count, depth, tail in reversed(seen):
            for column, value in ((self.token, token), (self.count, count), (self.parent, state), (self.depth, depth),
                                  (self.tail, tail), (self.moves, {})):
                column.append(value)
            state = len(self.token) - 1
        return max(state, 0)

    def count_part(self, part: str) -> int:
        """Tokens of a text: the outputs along its path."""
        state = total = 0
        for char in part:
            state, delta = self.moves[state].get(char) or self.step(state, char)
            total += delta
        return total

    def anew(self, last: str, char: str) -> bool:
        """Whether the machine starts anew between two characters, as no token spans them."""
        return last + char not in self.joined


class Place(NamedTuple):
    """Where the machine stands after some text: in a state, of which a snapshot outlives the states."""

    state: int
    generation: int
    seen: list
    last: str


class ChunkMap(NamedTuple):
    """What a chunk does, in whatever state it is entered."""

    head: str  # up to the first place where the machine starts anew; all of it, if there is none
    marks: list[tuple[int, int]]  # state and count after each of the first characters of the head, entered at the start
    generation: int  # of these states
    count: int  # of the head, entered at the start
    inside: int | None  # tokens after the head, to the end
    end: Place  # entered at the start, if the head is all


MARKS = 512


class TokenCounter:
    def __init__(self, path: str, chunk: int = 1 << 16):
        self.transducer = CountTransducer(path)
        stop = "" if "\n" in self.transducer.known else "\n"
        self.units = re.compile(f"{SPACE}+[^{SPACE}{stop}]*|[^{SPACE}{stop}]+" + (f"|{stop}" if stop else ""))
        self.words = Memo(self.transducer.count_part)
        self.chunk = chunk

    def sum_units(self, text: str) -> int:
        return sum(map(self.words.__getitem__, self.units.findall(text)))

    def place(self, state: int, last: str) -> Place:
        return Place(state, self.transducer.generation, self.transducer.snapshot(state), last)

    def chunk_map(self, text: str) -> ChunkMap:
        machine = self.transducer
        border = next((i for i in range(1, len(text)) if machine.anew(text[i - 1], text[i])), len(text))
        head, rest = text[:border], text[border:]
        state = total = 0
        marks, generation, last = [], machine.generation, ""
        for char in head:
            state, delta = machine.moves[state].get(char) or machine.step(state, char)
            total += delta
            last = char
            if len(marks) < MARKS and machine.generation == generation:
                marks.append((state, total))
        if not rest:
            return ChunkMap(head, marks, generation, total, None, self.place(state, last))
        units = self.units.findall(rest)
        inside, state, last = sum(map(self.words.__getitem__, units[:-1])), 0, ""
        for char in units[-1]:
            state, delta = machine.moves[state].get(char) or machine.step(state, char)
            inside += delta
            last = char
        return ChunkMap(head, marks, generation, total, inside, self.place(state, last))

    def follow(self, begin: Place, chunk: ChunkMap) -> tuple[int, Place]:
        """Count and end of a chunk's head, entered at a place."""
        machine, at_end = self.transducer, chunk.end if chunk.inside is None else None
        if machine.anew(begin.last, chunk.head[0]):
            return chunk.count, at_end
        state = begin.state if begin.generation == machine.generation else machine.enter(begin.seen)
        total, last = 0, begin.last
        for i, char in enumerate(chunk.head):
            state, delta = machine.moves[state].get(char) or machine.step(state, char)
            total += delta
            last = char
            if i < len(chunk.marks) and machine.generation == chunk.generation and state == chunk.marks[i][0]:
                return total + chunk.count - chunk.marks[i][1], at_end
        return total, self.place(state, last)

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        count, end = self.follow(a.end, b)
        after = count + (b.inside or 0)
        end = end if b.inside is None else b.end
        if a.inside is not None:
            return a._replace(inside=a.inside + after, end=end)
        if self.transducer.anew(a.end.last, b.head[0]):
            return a._replace(inside=after, end=end)
        return a._replace(head=a.head + b.head, count=a.count + count, inside=b.inside, end=end)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if len(text) <= self.chunk:
            return self.sum_units(text)
        maps = [self.chunk_map(text[i : i + self.chunk]) for i in range(0, len(text), self.chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0].count + (maps[0].inside or 0)


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter per worker and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    path = path or public_tokenizers.path(MODEL)

    def make():
        tokens = counter(path)

        def row(doc_id, text):
            n = tokens.count(text or "")
            yield doc_id, len((text or "").encode()), n, n > limit

        return row

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)),
                    "doc_id long, n_bytes long, n_tokens long, over_limit boolean", make)
