"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token the last token of its encoding is unique. An automaton
over the vocabulary gives, at each position, the tokens that end there. Of those the one
is right whose predecessor, the stored last token of the prefix before it, stays apart
from it: merging the two tokens' bytes would give the same two tokens. Following the
stored tokens backwards from the end gives the ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import ship, with_fields
from legalops.llm.pretokens import LONG_CHUNK, Splitter, Vocabulary, load

ship(__name__)

# Encoded chunks and tested pairs kept by one worker; beyond it they are started afresh. Workers
# stay alive with what they keep, beside what an executor needs for other stages.
REMEMBERED = 250_000
TESTED = 400_000
# Chunks whose ids are joined and decoded at once.
TOGETHER = 50_000
# Ids lie below this, so that a pair of them is one number.
IDS = 1 << 20
NOTHING, NOT_REACHED = -1, -2
NEVER = float("inf")


class Encoder:
    def __init__(self, v: Vocabulary) -> None:
        self.splitter = Splitter(v)
        left, right, merged = (v[k].tolist() for k in ("left", "right", "merged"))
        self.bytes_of = {int(i): bytes([b]) for b, i in enumerate(v["byte_ids"])}
        self.rank = {}
        self.halves = {}
        for r, (a, b, t) in enumerate(zip(left, right, merged)):
            self.rank[a * IDS + b] = r
            self.halves.setdefault(t, (a, b, r))
            self.bytes_of[t] = self.bytes_of[a] + self.bytes_of[b]
        self.edges: tuple[dict, dict] = ({}, {})
        self.apart: dict[int, bool] = {}
        # A token whose halves would not have met encodes to something else and never occurs.
        self.automaton = ahocorasick.Automaton()
        self.whole = {}
        for t, text in self.bytes_of.items():
            if t not in self.halves or self._reached(t):
                self.automaton.add_word(text.decode("latin-1"), (t, len(text)))
                self.whole[text] = t
        self.automaton.make_automaton()
        self.special_bytes = {i: s.encode() for s, i in v["special"].items()}
        self.written = {b"%d" % i: self.special_bytes.get(i) or text for i, text in self.bytes_of.items()}
        self.known = Known(self)

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The token and its parts along one edge, each with the rank at which it is merged away."""
        edge = self.edges[side].get(token)
        if edge is None:
            at, edge = token, [(token, NEVER)]
            while at in self.halves:
                until = self.halves[at][2]
                at = self.halves[at][side]
                edge.append((at, until))
            self.edges[side][token] = edge
        return edge

    def _meets(self, a: int, b: int) -> float:
        """The lowest rank at which something of a would merge with something of b."""
        met, rank, lefts = NEVER, self.rank.get, self._edge(b, 0)
        for x, x_until in self._edge(a, 1):
            x *= IDS
            for y, y_until in lefts:
                r = rank(x + y)
                # Of equal ranks the left place merges first.
                if r is not None and r < met and r < x_until and r <= y_until:
                    met = r
        return met

    def _reached(self, token: int) -> bool:
        a, b, r = self.halves[token]
        return self._meets(a, b) == r

    def _stay_apart(self, a: int, b: int) -> bool:
        if len(self.apart) >= TESTED:
            self.apart.clear()
        apart = self.apart[a * IDS + b] = self._meets(a, b) == NEVER
        return apart

    def ids(self, word: bytes) -> list[int]:
        if word in self.whole:  # the whole word as its own last token
            return [self.whole[word]]
        tested = self.apart.get
        last = [NOT_REACHED] * (len(word) + 1)
        came_from = [0] * (len(word) + 1)
        last[0] = NOTHING
        for end, (token, size) in self.automaton.iter(word.decode("latin-1")):
            end += 1
            if last[end] == NOT_REACHED:
                before = last[end - size]
                if before == NOT_REACHED:
                    continue
                if before != NOTHING:
                    apart = tested(before * IDS + token)
                    if apart is None:
                        apart = self._stay_apart(before, token)
                    if not apart:
                        continue
                last[end] = token
                came_from[end] = end - size
        found, at = [], len(word)
        while at:
            found.append(last[at])
            at = came_from[at]
        found.reverse()
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.special_bytes.get(i) or self.bytes_of[i] for i in ids])

    def chunk_ids(self, chunk: str) -> list[int]:
        return [i for word in self.splitter.words(chunk) for i in self.ids(word.encode())]

    def text(self, text: str) -> tuple[list[int], str]:
        """The ids of a text and the text they decode to."""
        ids: list[int] = []
        for special, chunks in self.splitter.parts(text):
            for chunk in chunks:
                ids += self.chunk_ids(chunk)
            if special is not None:
                ids.append(special)
        return ids, self.decode(ids).decode("utf-8", "replace")

    def digests(self, text: str) -> tuple[int, str, str]:
        n, ids, decoded = 0, [], []
        for special, chunks in self.splitter.parts(text):
            for k in range(0, len(chunks), TOGETHER):
                listed = b",".join(map(self.known.__getitem__, chunks[k : k + TOGETHER]))
                each = listed.split(b",")
                n += len(each)
                ids.append(listed)
                decoded.append(b"".join(map(self.written.__getitem__, each)))
            if special is not None:
                n += 1
                ids.append(b"%d" % special)
                decoded.append(self.decode([special]))
        back = b"".join(decoded).decode("utf-8", "replace").encode()
        return n, sha256(b",".join(ids)).hexdigest(), sha256(back).hexdigest()


class Known(dict):
    """Of each chunk its ids, as ASCII text.

    When REMEMBERED chunks have come, they become the older ones and the older ones go;
    an older one that comes again is kept on.
    """

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        entry = self.older.get(chunk) or self._encode(chunk)
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= REMEMBERED:
                self.older = self.copy()
                self.clear()
            self[chunk] = entry
        return entry

    def _encode(self, chunk: str) -> bytes:
        words = self.encoder.splitter.words(chunk)
        if len(words) > 1:  # a pre-token is a chunk, too
            return b",".join([self[word] for word in words])
        return ",".join(map(str, self.encoder.ids(chunk.encode()))).encode()


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of a vocabulary, built once in a worker: the tasks it runs share what was sent."""
    return vocabulary.get("encoder") or vocabulary.setdefault("encoder", Encoder(vocabulary))


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Add `ids` (array of int) and `decoded` (the text the ids give) to every row.

    A null text is taken as empty: no ids, an empty text. An empty table gives an empty
    table; repeated rows are encoded each. Columns of these names are replaced.
    """
    shipped = df.sparkSession.sparkContext.broadcast(load(path))  # fixed size

    @F.pandas_udf("ids array<int>, decoded string")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shipped.value)
        for texts in batches:
            rows = [encoder.text(t or "") for t in texts]
            yield pd.DataFrame({"ids": [np.array(i, np.int32) for i, _ in rows], "decoded": [d for _, d in rows]})

    return with_fields(df, encoded(F.col(text_col)), ["ids", "decoded"])


def encode_digests(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """As `encode`, but add n_tokens, ids_sha256 and decoded_sha256.

    The ids are hashed as decimal numbers joined by commas, the decoded text as UTF-8.
    Only digests leave the task, and each distinct chunk (white space and what follows it)
    is encoded and decoded once while it is remembered.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    shipped = df.sparkSession.sparkContext.broadcast(load(path))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shipped.value)
        for texts in batches:
            yield pd.DataFrame([encoder.digests(t or "") for t in texts], columns=names)

    return with_fields(df, encoded(F.col(text_col)), names)
