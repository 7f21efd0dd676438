"""Byte-level BPE vocabularies, and the split of texts into pre-tokens.

A vocabulary file holds the merges in the order of their ranks, as a list of pairs of
printable stand-ins for bytes. It is read once on the driver and sent to the tasks; its
size is fixed. Special strings inside a text are one token each, as is the library's
default.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from typing import Any

import numpy as np
import regex

from legalops.llm.common import ship

ship(__name__)

# Fixed value: the split of the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# White space with the run of other characters after it. No pre-token reaches from one
# such chunk into the next, so a chunk that was split before need not be split again.
# Python counts four control characters as white space that the split does not.
CHUNK = r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+"

# Chunks longer than this are not remembered.
LONG_CHUNK = 100


# Letters and numbers that Unicode 16 added, which the split takes for such
# though `unicodedata` does not know them yet.
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3),
    (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5FA),
]


# A vocabulary travels as a plain dict:
# byte_ids: the id of each byte; left, right, merged: the pairs, by rank; special: special
# strings and their ids; unknown: a class of characters of newer Unicode versions, letters
# for the `regex` module but for nobody else.
Vocabulary = dict[str, Any]


def _stand_ins() -> dict[str, int]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _newer_letters() -> str:
    """A character class of what `regex` takes for a letter or number and Unicode 16 does not know."""
    ranges: list[list[int]] = []
    found = regex.compile(r"[\p{L}\p{N}]").finditer("".join(map(chr, (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000))))
    for m in found:
        c = ord(m.group())
        if unicodedata.category(m.group()) == "Cn" and not any(a <= c <= b for a, b in UNICODE_16):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else "(?!)"


def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids, stand_ins = content["model"]["vocab"], _stand_ins()
    byte_ids = np.zeros(256, np.int64)
    for ch, byte in stand_ins.items():
        byte_ids[byte] = ids[ch]
    pairs = [p if isinstance(p, list) else p.split(" ") for p in content["model"]["merges"]]
    as_ids = lambda tokens: np.array([ids[t] for t in tokens], np.int64)
    return {
        "byte_ids": byte_ids,
        "left": as_ids(a for a, _ in pairs),
        "right": as_ids(b for _, b in pairs),
        "merged": as_ids(a + b for a, b in pairs),
        "special": {t["content"]: t["id"] for t in content.get("added_tokens", [])},
        "unknown": _newer_letters(),
    }


class Splitter:
    """Cuts texts into special strings, chunks and pre-tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.special = vocabulary["special"]
        self.split = regex.compile(SPLIT)
        self.chunks = re.compile(CHUNK).findall
        self.unknown = re.compile(vocabulary["unknown"])
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def parts(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """Runs of chunks, each with the special id that follows it."""
        at = 0
        for m in self.marks.finditer(text) if self.marks else ():
            yield self.special[m.group()], self.chunks(text[at : m.start()])
            at = m.end()
        yield None, self.chunks(text[at:] if at else text)

    def words(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk."""
        if self.unknown.search(chunk):
            plain = self.unknown.sub("§", chunk)  # neither letter nor number nor space
            return [chunk[m.start() : m.end()] for m in self.split.finditer(plain)]
        return self.split.findall(chunk)
