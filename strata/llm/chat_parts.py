"""Chat formatting with typed content parts.

A message is an ordered list of parts, each a text, an image, a sound or a document.  A
visitor with one method per kind flattens them: text is escaped and written, any other part
becomes a placeholder ``<|kind:k|>`` (k counts the conversation's attachments) and its
reference and expanded token count go to the list of attachments.

    ### user: Hello <|image:0|> </turn>
    ### assistant: Hi </turn>

Inside texts a backslash goes before each backslash, each ``###`` that a blank follows (or that
ends the text: the template's blank may follow), ``</turn>`` and ``<|``, so no text can open or
close a turn or pose as a placeholder, and dropping these backslashes gives the text back.  Text
parts that follow each other are joined before this, so none can complete another's mark.  In
roles the colon is escaped too.  In a table a part of an unknown kind is an attachment like the
others, with the placeholder ``<|unknown:k|>``, and a null part says nothing.  The loss mask is the list of spans of the
assistant's contents in the formatted string.

One shuffle by conversation id.  Rows are ordered by turn, then role, then text, so ties and
repeated rows have a defined order; null turn comes first, null role and text count as empty,
rows without an id form one conversation with a null id.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows

KINDS = ("text", "image", "audio", "document")
OPEN, CLOSE = "### ", " </turn>\n"
_CONTROL = re.compile(r"\\|###(?= |\Z)|</turn>|<\|")
_ROLE_CONTROL = re.compile(r"[\\:]|### |</turn>|<\|")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: a turn: its role up to the first bare colon, its content up to the first bare closing mark
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"\\.|<\|([a-z]+):([0-9]+)\|>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def escape_role(role: str) -> str:
    return _ROLE_CONTROL.sub(lambda m: "\\" + m[0], role)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Attachment(NamedTuple):
    place: int
    kind: str
    ref: str
    tokens: int


class Flattener:
    """Visits the parts of one conversation.  ``rates`` says how many tokens a unit of each
    kind expands to (an image's tiles, a sound's seconds, a document's pages)."""

    def __init__(self, rates: dict[str, int], strict: bool = True):
        self.rates, self.strict = rates, strict
        self.attachments: list[Attachment] = []

    def visit(self, part: dict) -> str:
        kind = part.get("type") or "text"
        return (getattr(self, f"visit_{kind}") if kind in KINDS else self.visit_unknown)(part)

    def visit_text(self, part: dict) -> str:
        return escape(part.get("text") or "")

    def attach(self, kind: str, part: dict) -> str:
        place = len(self.attachments)
        self.attachments.append(
            Attachment(place, kind, part.get("ref") or "", self.rates.get(kind, 1) * (part.get("units") or 1)))
        return f"<|{kind}:{place}|>"

    def visit_image(self, part: dict) -> str:
        return self.attach("image", part)

    def visit_audio(self, part: dict) -> str:
        return self.attach("audio", part)

    def visit_document(self, part: dict) -> str:
        return self.attach("document", part)

    def visit_unknown(self, part: dict) -> str:
        if self.strict:
            raise ValueError(f"unknown part type {part['type']!r}")
        place = self.attach(part["type"], part).rpartition(":")[2]
        return f"<|unknown:{place}"

    def flatten(self, parts: list[dict]) -> str:
        """The parts in order, neighbouring texts as one."""
        out: list[str] = []
        for kind, run in groupby(parts, key=lambda p: p.get("type") or "text"):
            if kind == "text":
                out.append(self.visit_text({"text": "".join(p.get("text") or "" for p in run)}))
            else:
                out += map(self.visit, run)
        return "".join(out)


# Tokens per unit unless the caller says otherwise.
RATES = {"image": 256, "audio": 25, "document": 512}


def format_turns(turns: list[tuple[str, list[dict]]], rates=RATES, trained: str = "assistant", strict: bool = True):
    """(formatted string, spans of the trained role's contents, attachments) of (role, parts) pairs.  A part of
    an unknown kind is an error if ``strict``."""
    visitor, out, spans, at = Flattener(rates, strict), [], [], 0
    for role, parts in turns:
        head = f"{OPEN}{escape_role(role)}: "
        body = visitor.flatten(parts)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans, visitor.attachments


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, content) pairs of a formatted string; placeholders stay as they are."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2].removesuffix(" "))))
        at = m.end()
    return turns


def read_masked(formatted: str, spans) -> str:
    """The text under the loss mask, unescaped."""
    return "".join(unescape(formatted[a:b]) for a, b in spans)


SCHEMA = ("conv_id long, n_turns long, formatted string, loss_spans array<struct<start:int,end:int>>, "
          "attachments array<struct<place:int,kind:string,ref:string,tokens:int>>, attached_tokens long")
PARTS = "array<struct<type:string,text:string,ref:string,units:int>>"


def text_part(column) -> F.Column:
    """A column of texts as a column of parts."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(column, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))).cast(PARTS)


def format_chats(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts_col: str = "parts", rates: dict[str, int] | None = None,
                 trained: str = "assistant") -> DataFrame:
    """One row per conversation; ``parts_col`` holds an array of {type, text, ref, units}."""
    rates = {**RATES, **(rates or {})}
    rows = messages.select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                 F.col(parts_col).cast(PARTS).alias("parts")).alias("message"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("message")).alias("messages"))

    def make():
        def row(conv_id, messages):
            formatted, spans, attached = format_turns(
                [(m["role"], [p or {} for p in m["parts"] or []]) for m in messages], rates, trained, strict=False)
            yield (conv_id, len(messages), formatted, [{"start": a, "end": b} for a, b in spans],
                   [a._asdict() for a in attached], sum(a.tokens for a in attached))

        return row

    return map_rows(grouped, SCHEMA, make)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_chats`` wrote, read from its output alone."""

    def make():
        def row(conv_id, text, spans):
            turns = read_turns(text)
            told = "".join(f"{role}\n{said}\n" for role, said in turns)
            masked = read_masked(text, [(s["start"], s["end"]) for s in spans])
            yield (conv_id, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(masked),
                   hashlib.sha256(masked.encode()).hexdigest(), len(text))

        return row

    return map_rows(
        formatted.select("conv_id", "formatted", "loss_spans"),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        make)
