"""Splitting text as the byte-level tokenizers do, before their merges."""

from __future__ import annotations

import re

import public_tokenizers
import regex

_FULL = regex.compile(public_tokenizers.PATTERN)

# The same pattern over Latin-1 texts, with its classes written out: the standard library's
# matcher is several times as fast there.
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_LATIN = re.compile(
    f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def split(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _FULL.findall(text)
    return _LATIN.findall(text)
