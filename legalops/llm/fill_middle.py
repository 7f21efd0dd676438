"""Fill-in-middle transformation with content-defined chunks.

A rolling hash over a text's bytes cuts it into chunks at places that the bytes around
them choose, so passages that texts share give the same chunks wherever they stand. Each
chunk has a boundary summary: its words, its code points, and whether it begins and ends
inside a word. Summaries are remembered under the chunk's hash and used again only where
the remembered bytes equal the chunk's. Combining summaries from left to right counts a
text's tokens (words with the white space before them, and white space at the end) and
names the chunk in which a cut lies; only that chunk is read for the place.

The cuts and the form come from a hash of the id, so every run gives the same output.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import free_name, ship

ship(__name__)

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Bytes that decide on a cut, and bytes of a chunk at least, about on average, and at most.
WINDOW, LEAST, MASK_BITS, MOST = 32, 64, 8, 2048
# Bytes hashed at a time, so that a long text needs no long arrays.
PIECE = 1 << 20
# Chunks remembered by one worker; beyond it the older ones go.
REMEMBERED = 50_000
FACTOR = 0x9E3779B97F4A7C15
CONTINUATION = bytes(range(0x80, 0xC0))
SPACE = b" \t\n\v\f\r"


class Roller:
    """Places at which the hash of the WINDOW bytes before them has MASK_BITS leading zeros."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def candidates(self, raw: bytes) -> list[int]:
        """Ends of windows that may end a chunk, rising."""
        found: list[int] = []
        for start in range(0, max(len(raw) - WINDOW + 1, 0), PIECE):
            piece = np.frombuffer(raw, np.uint8, min(PIECE + WINDOW - 1, len(raw) - start), start)
            # Doubling: the hash of 2k bytes is that of the first k times a power, plus the rest.
            h, width, power = self.values[piece], 1, FACTOR
            while width < WINDOW:
                h = h[:-width] * np.uint64(power) + h[width:]
                power = power * power % (1 << 64)
                width *= 2
            at = np.flatnonzero(h >> np.uint64(64 - MASK_BITS) == 0)
            found += (at + (start + WINDOW)).tolist()
        return found

    def cuts(self, raw: bytes) -> list[int]:
        """Where chunks end: the first candidate LEAST bytes on, or MOST bytes on where there is none."""
        if len(raw) <= LEAST:
            return [len(raw)] if raw else []
        places, ends, at = self.candidates(raw), [], 0
        while at < len(raw):
            k = bisect_left(places, at + LEAST)
            at = min(places[k] if k < len(places) else len(raw), at + MOST, len(raw))
            ends.append(at)
        return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Words (or pieces of one), code points begun, whether it begins and ends inside a word."""
    chars = len(chunk) if chunk.isascii() else len(chunk.translate(None, CONTINUATION))
    return len(chunk.split()), chars, chunk[0] not in SPACE, chunk[-1] not in SPACE


class Summaries:
    """Summaries by hash, each with the bytes that it is true of."""

    def __init__(self) -> None:
        self.known: dict[int, tuple[bytes, tuple]] = {}
        self.older: dict[int, tuple[bytes, tuple]] = {}
        self.reused = 0

    def of(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        key = xxhash.xxh3_64_intdigest(chunk)
        held = self.known.get(key) or self.older.get(key)
        if held is None or held[0] != chunk:
            held = (chunk, summary(chunk))
        else:
            self.reused += 1
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        self.known[key] = held
        return held[1]


def word_end(chunk: bytes, k: int) -> int:
    """The place at which the k-th word of a chunk ends."""
    at = 0
    for word in chunk.split(None, k)[:k]:
        at = chunk.index(word, at) + len(word)
    return at


class Counted:
    """A text's chunks, with the words and code points up to the end of each."""

    def __init__(self, raw: bytes, roller: Roller, summaries: Summaries) -> None:
        self.raw = raw
        self.ends = roller.cuts(raw)
        self.starts = [0, *self.ends[:-1]]
        found = [summaries.of(raw[s:e]) for s, e in zip(self.starts, self.ends)]
        # A word that goes on from the chunk before was counted there.
        self.joined = [k > 0 and f[2] and found[k - 1][3] for k, f in enumerate(found)]
        self.words = list(accumulate(f[0] - j for f, j in zip(found, self.joined)))
        self.chars = [0, *accumulate(f[1] for f in found)]
        self.open_end = bool(found) and not found[-1][3]
        self.n = (self.words[-1] if found else 0) + self.open_end

    def cut(self, tokens: int) -> tuple[int, int]:
        """Bytes and code points of the first so many tokens."""
        if tokens == 0:
            return 0, 0
        if tokens == self.n:
            return len(self.raw), self.chars[-1]
        k = bisect_left(self.words, tokens)
        in_chunk = tokens - (self.words[k - 1] if k else 0) + self.joined[k]
        start, end = self.starts[k], self.ends[k]
        at = start + word_end(self.raw[start:end], in_chunk)
        # The word may go on in the chunks that follow.
        while at == end and k + 1 < len(self.ends) and self.joined[k + 1]:
            k += 1
            start, end = self.starts[k], self.ends[k]
            at = start + word_end(self.raw[start:end], 1)
        return at, self.chars[k] + summary(self.raw[start:at])[1] if at > start else self.chars[k]


def transform(raw: bytes, h1: int, h2: int, h3: int, h4: int, roller: Roller, summaries: Summaries) -> tuple:
    """n, form, code points of prefix and middle, and the output, both null where it is the text."""
    counted = Counted(raw, roller, summaries)
    marked = any(m.encode() in raw for m in (PREFIX, SUFFIX, MIDDLE))
    if not raw or marked or h3 % 100 >= 50:
        return counted.n, PLAIN, None, None, None
    first, second = sorted((h1 % (counted.n + 1), h2 % (counted.n + 1)))
    (a, a_chars), (b, b_chars) = counted.cut(first), counted.cut(second)
    prefix, middle, suffix = raw[:a].decode(), raw[a:b].decode(), raw[b:].decode()
    if h4 % 100 < 80:
        form, output = SPM, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = PSM, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return counted.n, form, a_chars, b_chars - a_chars, output


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars and output to every row.

    n counts the tokens of the text; prefix_chars and middle_chars are code points, null
    where the form is plain; output is the text in its form. A null text is empty; an
    empty one, and one that holds a marker, stays plain. A row without an id is drawn as
    one whose id has no digits. Repeated rows come out alike, and an empty table stays
    empty. Rows are kept as they are; columns of the new names are replaced. A text is
    held in memory once or twice, and so is its output.
    """
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]

    @F.pandas_udf("n long, form string, prefix_chars long, middle_chars long, output string")
    def made(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        roller, summaries = Roller(), Summaries()
        for texts, *draws in batches:
            rows = [transform(t.encode(), *h, roller, summaries) for t, *h in zip(texts, *draws)]
            out = pd.DataFrame(rows, columns=names, dtype=object)
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    text = F.coalesce(F.col(text_col), F.lit(""))
    found = free_name(df, "_made")
    df = df.select("*", made(text, *draws).alias(found))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in {*names, found}]
    # Plain outputs are the texts themselves and need not come back from Python.
    output = F.coalesce(F.col(found)["output"], text).alias("output")
    return df.select(*kept, *[F.col(found)[n].alias(n) for n in names[:-1]], output)


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed, from the output and its form alone."""

    def between(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(rest, second, 1)
        rest = F.substr(rest, F.length(a) + len(second) + 1)
        b = F.substring_index(rest, third, 1)
        return a, b, F.substr(rest, F.length(b) + len(third) + 1)

    prefix, suffix, middle = between(PREFIX, SUFFIX, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = between(SUFFIX, PREFIX, MIDDLE)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def fill_in_middle_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `fill_in_middle`, with hashes of the output and of the text restored from it."""
    made = fill_in_middle(df.select(id_col, text_col), id_col, text_col)
    return made.select(
        id_col,
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
