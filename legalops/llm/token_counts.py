"""Token counts by rank-synchronous merging of ragged arrays.

The distinct new pre-tokens of a group of texts lie end to end in one numpy array. In each round
every pre-token finds its lowest-rank pair and merges all places where that pair
occurs; a pre-token without a pair is done and leaves the array. What is left of it is
its number of tokens. A merge only makes pairs of higher rank, so merging a pair's
places together gives what merging them one by one gives.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import ship, with_fields
from legalops.llm.pretokens import LONG_CHUNK, Splitter, Vocabulary, load

ship(__name__)

NEVER = np.int64(1) << 40
# Counts kept by one worker; beyond it the memory is started afresh.
REMEMBERED = 400_000
# Texts are counted together up to about so many characters.
GROUP = 1 << 20


class Merger:
    def __init__(self, v: Vocabulary) -> None:
        key = v["left"] << 20 | v["right"]
        order = np.argsort(key)
        self.keys, self.ranks = key[order], order.astype(np.int64)
        self.merged, self.byte_ids = v["merged"], v["byte_ids"]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def count(self, words: list[bytes]) -> np.ndarray:
        """The number of tokens of each word; words are not empty."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lens)
        rank = np.full(len(ids), NEVER)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self.pair_ranks(ids[inside], ids[inside + 1])
        while len(ids):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lens = np.diff(np.r_[first, len(ids)])
            best = np.minimum.reduceat(rank, first)
            done = best == NEVER
            if done.any():
                counts[owner[first[done]]] = lens[done]
                going = np.repeat(~done, lens)
                ids, owner, rank = ids[going], owner[going], rank[going]
                best, lens = best[~done], lens[~done]
                if not len(ids):
                    break
            chosen = rank == np.repeat(best, lens)
            # Of overlapping places of one pair (a a a), every other one merges, from the left.
            at = np.arange(len(ids))
            opens = chosen & ~np.r_[False, chosen[:-1]]
            chosen &= (at - np.maximum.accumulate(np.where(opens, at, 0))) % 2 == 0
            ids[chosen] = self.merged[rank[chosen]]
            keep = ~np.r_[False, chosen[:-1]]
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            new = np.flatnonzero(chosen[keep])
            # Ranks change at a merged symbol and just before it.
            touched = np.union1d(new, new[new > 0] - 1)
            rank[touched] = NEVER
            touched = touched[touched < len(ids) - 1]
            touched = touched[owner[touched] == owner[touched + 1]]
            rank[touched] = self.pair_ranks(ids[touched], ids[touched + 1])
        return counts


class Counter:
    """Counts texts; the counts of chunks are kept from one group of texts to the next."""

    def __init__(self, v: Vocabulary) -> None:
        self.splitter, self.merger = Splitter(v), Merger(v)
        self.known: dict[str, int] = {}

    def texts(self, texts: Iterable[str]) -> Iterator[int]:
        """The number of tokens of each text, in groups of some GROUP characters."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> list[int]:
        runs = []
        for text in texts:
            marks, chunks = 0, []
            for special, run in self.splitter.parts(text):
                marks += special is not None
                chunks += run
            runs.append((marks, chunks))
        present = set().union(*(chunks for _, chunks in runs))
        if len(self.known) + len(present) > REMEMBERED:
            self.known.clear()
        new = present.difference(self.known)
        self.known.update(self._counts(new))
        counted = [marks + sum(map(self.known.__getitem__, chunks)) for marks, chunks in runs]
        for chunk in new:
            if len(chunk) > LONG_CHUNK:
                del self.known[chunk]
        return counted

    def _counts(self, chunks: set[str]) -> dict[str, int]:
        words = {c: self.splitter.words(c) for c in chunks}
        distinct = list({w for run in words.values() for w in run})
        counts = dict(zip(distinct, self.merger.count([w.encode() for w in distinct]).tolist()))
        return {c: sum(map(counts.__getitem__, run)) for c, run in words.items()}


def count_tokens(df: DataFrame, path: str, text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (n_tokens > limit) to every row.

    A null text counts as empty: 0 bytes, 0 tokens. An empty table gives an empty table.
    Repeated rows are counted each. Columns of the three names are replaced, others stay.
    Memory in a task: the texts of one batch, the chunks of one group of them, and at most
    REMEMBERED counts.
    """
    shipped = df.sparkSession.sparkContext.broadcast(load(path))  # fixed size

    @F.pandas_udf("n_bytes long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = shipped.value.get("counter") or shipped.value.setdefault("counter", Counter(shipped.value))
        for texts in batches:
            whole = [text or "" for text in texts]
            sizes = [len(text.encode()) for text in whole]
            yield pd.DataFrame({"n_bytes": sizes, "n_tokens": list(counter.texts(whole))}, dtype=np.int64)

    made = with_fields(df, counted(F.col(text_col)), ["n_bytes", "n_tokens"])
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
