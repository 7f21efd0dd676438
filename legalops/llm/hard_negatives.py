"""Hard negatives by an inverted multi-index with certified windows.

Vectors are cut in two halves, each half has a codebook, and a pair of codes is a cell.
Rows are range-partitioned by cell and written as shards of like size, so a hot cell is
several shards. A row's score with an anchor is the sum of two half scores; for each code
a half score is at most that of the codeword plus the anchor's length times the code's
radius in the shard. The multi-sequence heap visits a shard's cells by the sum of these
bounds, highest first, and stops when the bound lies below all that the search can still
use. So what it returns is exact, wherever it stops.

Two searches are made. The first finds each anchor's highest rows of its label, the second
the highest rows of other labels in the window at and below each positive's score. The
anchors, a stated set of queries, are asked of every shard: a task holds one shard, and
anchors stream past it. Each shard returns a few rows per anchor, and those are ranked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legalops.functions.scans import BLOCK, in_blocks
from legalops.llm.common import ship, staged

ship(__name__)

# Rows the codebooks are fitted on at most, by hash; every row is put in the index.
SAMPLE_ROWS = 16_384
ROUNDS = 8
# Rows of a cell, about, and codes of a codebook at most.
CELL_ROWS, MOST_CODES = 256, 256
# Rows of a shard: as few as keep all cores at work, but in this range.
LEAST_SHARD, MOST_SHARD = 4096, 65_536
# Whole numbers beyond this would let a sum of products leave a long.
MOST_WHOLE = 1 << 26

Codebooks = dict[int, tuple[np.ndarray, np.ndarray]]


def _means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Codewords of a half by Lloyd's rounds, from k different rows at random."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    x = x[rng.permutation(len(x))]
    _, first = np.unique(x, axis=0, return_index=True)
    means = x[np.sort(first)[:k]].copy()
    for _ in range(ROUNDS):
        own = _nearest(x, means)
        count = np.bincount(own, minlength=len(means))
        total = np.zeros_like(means)
        np.add.at(total, own, x)
        means[count > 0] = total[count > 0] / count[count > 0, None]
    return means


def _nearest(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    return ((means * means).sum(1)[None, :] - 2 * (x @ means.T)).argmin(1)


def _matrix(held: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(held), np.int32).reshape(len(held), dim) if dim else np.zeros((len(held), 0), np.int32)


def fit_codebooks(sample: pd.DataFrame, codes: int) -> Codebooks:
    """Two codebooks for each length of vectors in the sample."""
    books = {}
    for dim, rows in sample.groupby("dim"):
        x, rng = np.array(rows["vector"].tolist(), np.float64).reshape(len(rows), dim), np.random.default_rng([17, int(dim)])
        books[int(dim)] = tuple(_means(half, codes, rng) for half in (x[:, : dim // 2], x[:, dim // 2 :]))
    return books


def _books_of(books: Codebooks, dim: int) -> tuple[np.ndarray, np.ndarray]:
    # A length that the sample does not have gets one cell.
    return books.get(dim) or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def _products(rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products as whole numbers. Doubles are exact below 2**53."""
    return (rows @ anchor).astype(np.int64) if exact else rows.astype(np.int64) @ anchor.astype(np.int64)


class Shard:
    """The rows of one shard that have vectors of one length, by cell."""

    def __init__(self, rows: pd.DataFrame, dim: int, books: tuple[np.ndarray, np.ndarray]) -> None:
        rows = rows.sort_values(["c1", "c2", "id", "label"], kind="stable")
        # Rows equal in id, label and vector count once.
        rows = rows[~rows.duplicated(["c1", "c2", "id", "label", "vector"])]
        self.ids = rows["id"].to_numpy()
        self.labels, names = pd.factorize(rows["label"])
        self.number = {name: k for k, name in enumerate(names)}
        self.x = _matrix(rows["vector"], dim).astype(np.float64)
        self.cut, self.most = dim // 2, float(np.abs(self.x).max(initial=0))
        self.halves = []
        for name, book, half in (("c1", books[0], self.x[:, : self.cut]), ("c2", books[1], self.x[:, self.cut :])):
            own = rows[name].to_numpy()
            codes, at = np.unique(own, return_inverse=True)
            far = np.sqrt(((half - book[own]) ** 2).sum(1))
            radii = np.zeros(len(codes))
            np.maximum.at(radii, at, far)
            self.halves.append((codes, book[codes], radii))
        cells = rows["c1"].to_numpy().astype(np.int64) * MOST_CODES + rows["c2"].to_numpy()
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        self.cells = dict(zip(cells[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cells)])))

    def bounds(self, anchor: np.ndarray) -> list[np.ndarray]:
        """For each half an upper bound of the half score by code, with room for rounding."""
        found = []
        for part, (_, words, radii) in zip((anchor[: self.cut], anchor[self.cut :]), self.halves):
            size = np.sqrt((part * part).sum())
            found.append(words @ part + size * radii * (1 + 1e-9) + 1e-6 * (1 + size))
        return found

    def visit(self, anchor: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Cells by falling bound: the bound and the cell's rows."""
        left, right = self.bounds(anchor)
        a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
        left, right = left[a].tolist(), right[b].tolist()
        rows, columns = (self.halves[0][0][a] * MOST_CODES).tolist(), self.halves[1][0][b].tolist()
        heap = [(-(left[0] + right[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = self.cells.get(rows[i] + columns[j])
            if cell is not None:
                yield -bound, *cell
            if j + 1 < len(right):
                heapq.heappush(heap, (-(left[i] + right[j + 1]), i, j + 1))
            # Each pair is reached once: down the first column, then along its row.
            if j == 0 and i + 1 < len(left):
                heapq.heappush(heap, (-(left[i + 1] + right[0]), i + 1, 0))

    def exact(self, anchor: np.ndarray) -> bool:
        return max(len(anchor), 1) * self.most * float(np.abs(anchor).max(initial=0)) < 2.0**53


def _merge(best: list[tuple[int, int]], scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k first of what was found and what comes, as (score, id), ties by id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = scores >= kth
        scores, ids = scores[at], ids[at]
        order = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[order], ids[order]
    return sorted(best + list(zip(scores.tolist(), ids.tolist())), key=lambda r: (-r[0], r[1]))[:k]


def positives_in(shard: Shard, anchor: np.ndarray, own: int, label: str, k: int) -> list[tuple[int, int]]:
    """The shard's first k rows of the label, other than those with the anchor's id."""
    best: list[tuple[int, int]] = []
    exact, number = shard.exact(anchor), shard.number.get(label, -1)
    for bound, start, end in shard.visit(anchor):
        if len(best) == k and bound < best[-1][0]:
            break
        at = np.flatnonzero((shard.labels[start:end] == number) & (shard.ids[start:end] != own)) + start
        if len(at):
            best = _merge(best, _products(shard.x[at], anchor, exact), shard.ids[at], k)
    return best


def negatives_in(
    shard: Shard, anchor: np.ndarray, label: str, tops: list[int], k: int, low: int, high: int
) -> list[list[tuple[int, int]]]:
    """For each positive score the shard's first k rows of other labels in the window below it."""
    best: dict[int, list[tuple[int, int]]] = {t: [] for t in tops if low * t <= high * t}
    exact, number = shard.exact(anchor), shard.number.get(label, -1)
    for bound, start, end in shard.visit(anchor):
        # What each window can still use, in hundredths.
        least = {t: max(low * t, 100 * b[-1][0]) if len(b) == k else low * t for t, b in best.items()}
        if not least or 100 * bound < min(least.values()):
            break
        at = np.flatnonzero(shard.labels[start:end] != number) + start
        hundreds = 100 * _products(shard.x[at], anchor, exact)
        if not len(at) or hundreds.max() < min(least.values()):
            continue
        for t, need in least.items():
            fits = np.flatnonzero((hundreds >= need) & (hundreds <= high * t))
            if len(fits):
                best[t] = _merge(best[t], hundreds[fits] // 100, shard.ids[at[fits]], k)
    return [best.get(t, []) for t in tops]


def _index(rows: DataFrame) -> tuple[DataFrame, Broadcast, int]:
    """The rows with their cells as written shards (column BLOCK), the codebooks, and the number of shards."""
    context = rows.sparkSession.sparkContext
    total = rows.count()
    codes = int(min(MOST_CODES, max(1, round((total / CELL_ROWS) ** 0.5))))
    sample = rows.orderBy(F.xxhash64("id", "label", "vector")).limit(SAMPLE_ROWS).select("dim", "vector").toPandas()
    books = context.broadcast(fit_codebooks(sample, codes))  # of SAMPLE_ROWS vectors and fewer codes

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                whole = np.array(part["vector"].tolist(), np.int32).reshape(len(part), dim)
                held, x = _books_of(books.value, int(dim)), whole.astype(np.float64)
                codes = [_nearest(h, b).astype(np.int32) for h, b in zip((x[:, : dim // 2], x[:, dim // 2 :]), held)]
                yield part.assign(vector=[v.tobytes() for v in whole], c1=codes[0], c2=codes[1])

    made = rows.mapInPandas(coded, "id long, label string, anchor boolean, dim int, vector binary, c1 int, c2 int")
    size = min(MOST_SHARD, max(LEAST_SHARD, total // (2 * context.defaultParallelism)))
    index = in_blocks(made, ["dim", "c1", "c2"], ["id"], max(1, -(-total // size)))
    return index, books, (index.agg(F.max(BLOCK)).first()[0] or 0) + 1


def _ask(index: DataFrame, anchors: DataFrame, books: Broadcast, shards: int, find, schema: str) -> DataFrame:
    """What `find` gives for each shard and anchor of the shard's length of vectors.

    `anchors` has uid, id, label, dim, vector and tops.
    """
    # No null among long numbers: pandas would turn all of them into doubles.
    zero, none = F.lit(0), F.lit(None)
    held = index.select(BLOCK, zero.alias("side"), zero.cast("long").alias("uid"), "id", "label", "dim", "vector", "c1", "c2", none.cast("array<long>").alias("tops"))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias(BLOCK), F.lit(1).alias("side"), "uid", "id", "label", "dim", "vector",
        zero.alias("c1"), zero.alias("c2"), "tops",
    )
    both = held.unionByName(asked).repartition(2 * shards, BLOCK).sortWithinPartitions(BLOCK, "side", "dim")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in schema.split(", ")]
        block, rows, ready = None, [], {}
        for batch in batches:
            out = []
            for (at, side), part in batch.groupby([BLOCK, "side"]):
                if at != block:
                    block, rows, ready = at, [], {}
                if side == 0:
                    rows.append(part)
                    continue
                if rows:
                    held, rows = pd.concat(rows), []
                    ready = {int(d): Shard(own, int(d), _books_of(books.value, int(d))) for d, own in held.groupby("dim")}
                for uid, own, label, dim, vector, tops in zip(*[part[c] for c in ("uid", "id", "label", "dim", "vector", "tops")]):
                    if dim in ready:
                        anchor = np.frombuffer(vector, np.int32).astype(np.float64) if dim else np.zeros(0)
                        out += [(uid, own, *found) for found in find(ready[dim], anchor, own, label, tops)]
            yield pd.DataFrame(out, columns=names)

    return both.mapInPandas(run, schema)


def mine_hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(scale * x). A score is the inner product with the anchor; of
    equal scores the smaller id comes first. An anchor's positives are its first rows of
    the same label and another id. For each, the first rows of other labels are returned
    whose score s has low * p <= 100 * s <= high * p, p being the positive's score.

    Rows take no part whose id, label or vector is null, whose vector holds a null or a
    value that is not finite or whose whole numbers go beyond MOST_WHOLE, since their
    scores would not fit a long. Vectors of different lengths are not compared. Rows equal
    in id, label and vector count once; others that share an id count each. Where nothing
    fits the window there is no row, and an empty table gives an empty table. Other
    columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    whole = lambda x: F.floor(F.lit(float(scale)) * x)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= MOST_WHOLE / scale)
    usable = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(vector, fine))
    rows = usable.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.size(vector).alias("dim"),
        F.transform(vector, lambda x: whole(x).cast("int")).alias("vector"),
    )
    index, books, shards = _index(staged(rows, "vectors"))
    asked = index.where("anchor").select("id", "label", "dim", "vector").distinct()
    asked = staged(asked.withColumn("uid", F.xxhash64("id", "label", "dim", "vector")), "anchors")

    def first(found: DataFrame, within: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*within).orderBy(F.desc("score"), "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def near(shard: Shard, anchor: np.ndarray, own: int, label: str, tops: None) -> list[tuple]:
        return positives_in(shard, anchor, own, label, positives)

    none = asked.withColumn("tops", F.lit(None).cast("array<long>"))
    found = _ask(index, none, books, shards, near, "uid long, id long, score long, other long")
    best = staged(first(found, ["uid", "id"], positives).select("uid", "id", "rank", "score", "other"), "positives")

    # At most `positives` rows of each anchor.
    tops = best.groupBy("uid", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda r: r["score"]).alias("tops"))

    def below(shard: Shard, anchor: np.ndarray, own: int, label: str, tops: np.ndarray) -> list[tuple]:
        scores = [int(t) for t in tops]
        windows = negatives_in(shard, anchor, label, scores, negatives, low, high)
        return [(k + 1, score, other) for k, rows in enumerate(windows) for score, other in rows]

    found = _ask(index, asked.join(tops, ["uid", "id"]), books, shards, below, "uid long, id long, at int, score long, other long")
    ranked = first(found, ["uid", "id", "at"], negatives)
    placed = best.select("uid", "id", F.col("rank").alias("at"), F.col("score").alias("positive_score"), F.col("other").alias("positive_id"))
    return ranked.join(placed, ["uid", "id", "at"]).select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
