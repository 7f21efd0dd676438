"""Near-duplicate vectors by spherical-cap filters.

The filters are directions of a structured random product code: after a random rotation
a vector is cut in two, each half has a code of random unit directions, and every pair of
them is a filter. A vector is in the filters it exceeds by most; they are listed from the
two halves' inner products in falling order. The codes grow with the number of vectors of
a label, so that the vectors a filter holds, and with them the comparisons of a vector,
stay as many.

Vectors of one label that share a filter meet in that filter's task, twice. First only
the signs of 64 more random directions come, and a vector stays in a filter if another
one there has nearly the same signs. What stays comes again with its vector: the task
confirms the cosine in double precision. A pair counts in the first filter it shares, so
in one task only, and a task returns one row per vector: its number of links there and
the smallest vector it is joined with.

Equal vectors are one class with a weight. A filter with many vectors is cut into chunks,
and each pair of chunks is a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import id_of, row_key, ship, staged
from legalops.llm.components import connected_components

ship(__name__)

# Directions of a half's code for MEASURED vectors of one label; their number goes with the
# square root of the vectors. Two random vectors then share a filter once in some 50 pairs
# of 8,192 vectors, in 600 of 100,000 and in 10,000 of 1.5 million.
CODES, MEASURED, LEAST_CODES = 256, 8192, 32
# Filters a vector is in. Those of one vector share half-codes, so the rate of pairs that
# share none is simulated: see the README.
LIST_SIZE, MORE_PER_DOUBLING = 40, 12
# Of 64 signs so many may differ: at a cosine of 0.98 more do once in some 10**9 pairs.
SIGNS, MOST_SIGNS = 64, 20
CHUNK = 1024
# Inner products worked out at a time.
AT_ONCE = 1 << 21


def codes_for(vectors: int) -> int:
    """Directions of a half's code where a label has so many vectors at most."""
    return max(LEAST_CODES, round(CODES * (vectors / MEASURED) ** 0.5))


def list_size_for(codes: int) -> int:
    return min(codes * codes, LIST_SIZE + max(0, round(MORE_PER_DOUBLING * np.log2(codes / CODES))))


class Filters:
    def __init__(self, dim: int, codes: int, seed: int = 11) -> None:
        rng = np.random.default_rng([seed, dim])
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.cut = dim // 2
        self.planes = rng.standard_normal((dim, SIGNS))
        self.codes = []
        for width in (self.cut, dim - self.cut):
            c = rng.standard_normal((codes, max(width, 1)))[:, :width]
            self.codes.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12))
        self.size = list_size_for(codes)
        # A pair of the i-th and the j-th nearest code has (i + 1) * (j + 1) - 1 pairs before it.
        self.ranks = np.array([(i, j) for i in range(min(self.size, codes)) for j in range(min(self.size // (i + 1), codes))])

    def lists(self, unit: np.ndarray) -> np.ndarray:
        """The numbers of the filters each row exceeds by most, rising."""
        at_once = max(1, AT_ONCE // len(self.codes[0]))
        return np.concatenate([self._lists(unit[k : k + at_once]) for k in range(0, len(unit), at_once)])

    def _lists(self, unit: np.ndarray) -> np.ndarray:
        turned = unit @ self.rotation
        nearest = []
        for half, code in zip((turned[:, : self.cut], turned[:, self.cut :]), self.codes):
            score = half @ code.T
            some = min(self.size, score.shape[1])
            first = np.argpartition(-score, some - 1, axis=1)[:, :some]
            order = np.argsort(-np.take_along_axis(score, first, 1), axis=1, kind="stable")
            first = np.take_along_axis(first, order, 1)
            nearest.append((first, np.take_along_axis(score, first, 1)))
        i, j = self.ranks.T
        (a, x), (b, y) = nearest
        total = x[:, i] + y[:, j]
        made = a[:, i].astype(np.int64) * len(self.codes[1]) + b[:, j]
        best = np.argsort(-total, axis=1, kind="stable")[:, : self.size]
        return np.sort(np.take_along_axis(made, best, 1), axis=1)

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """The sides of SIGNS planes, as the bits of one number."""
        bits = (unit @ self.planes > 0).astype(np.uint8)
        return np.packbits(bits, axis=1).view(np.int64).ravel()


def _thinned(rows: list[tuple], n_left: int) -> list[int]:
    """The keys of one task that have nearly the signs of another one."""
    keys = [r[0] for r in rows]
    signs = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    near = np.bitwise_count(signs[:, None] ^ signs[None, :]) <= MOST_SIGNS
    np.fill_diagonal(near, False)
    if n_left < len(rows):
        near[:n_left, :n_left] = near[n_left:, n_left:] = False
    return [keys[k] for k in np.flatnonzero(near.any(1))]


def _linked(filter_id: int, rows: list[tuple], n_left: int, least: float) -> list[tuple[int, int, int]]:
    """(key, smallest key it is joined with, links) for the linked rows of one task."""
    keys = np.array([r[0] for r in rows])
    weights = np.array([r[1] for r in rows])
    x = np.array([r[2] for r in rows])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])  # exact; squares stay finite
    norms = np.sqrt((x * x).sum(1))
    near = (x @ x.T) / np.outer(norms, norms) >= least
    np.fill_diagonal(near, False)
    if n_left < len(rows):  # two chunks: links within one are found elsewhere
        near[:n_left, :n_left] = near[n_left:, n_left:] = False
    on = np.flatnonzero(near.any(1))
    if not len(on):
        return []
    near, keys, weights = near[np.ix_(on, on)], keys[on], weights[on]
    # A pair that shares an earlier filter counts there.
    earlier = [rows[k][3][rows[k][3] < filter_id] for k in on]
    flat = np.concatenate(earlier)
    if len(flat):
        _, at = np.unique(flat, return_inverse=True)
        inside = np.zeros((len(on), at.max() + 1), np.float32)
        inside[np.repeat(np.arange(len(on)), [len(e) for e in earlier]), at] = 1
        near &= inside @ inside.T == 0
    links = near @ weights
    root, before = np.arange(len(on)), None
    order = np.argsort(keys, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(on))
    root = rank
    while before is None or (root != before).any():
        before = root
        root = np.minimum(root, np.where(near, root, len(on)).min(1))
    return [(int(k), int(keys[order[r]]), int(n)) for k, r, n in zip(keys, root, links) if n]


def _in_tasks(entries: DataFrame, payload: list[str], work: Callable[[list, list[tuple], int], list[tuple]], schema: str) -> DataFrame:
    """What `work` gives for each filter (label, dim, filter) that holds two vectors or more.

    A filter of more than CHUNK vectors is cut into chunks by a hash of the key, and each
    pair of chunks is a task: its rows are those of the first chunk, n_left of them, and
    then those of the second; where a chunk meets itself all are first.
    """
    shared = ["label", "dim", "filter"]
    crowded = entries.groupBy(*shared).agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    crowded = staged(crowded.select(*shared, F.ceil(F.col("n") / CHUNK).alias("chunks")), "crowded")
    chunks = F.coalesce("chunks", F.lit(1))
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1),
        lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")),
    )
    tasks = entries.join(crowded, shared, "left").withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks)).withColumn("task", F.explode(meets))
    tasks = tasks.select(*shared, "task.i", "task.j", (F.col("chunk") > F.col("task.i")).alias("on_right"), *payload)
    tasks = tasks.repartition(*shared, "i", "j").sortWithinPartitions(*shared, "i", "j", "on_right", "rep")
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, held, n_left = None, [], 0

        def done() -> list[tuple]:
            meet = len(held) > 1 and (task[3] == task[4] or 0 < n_left < len(held))
            return work(task, held, n_left) if meet else []

        for batch in batches:
            out: list = []
            for *at, on_right, row in zip(*[batch[c] for c in (*shared, "i", "j", "on_right")], zip(*[batch[c] for c in payload])):
                if at != task:
                    out += done()
                    task, held, n_left = at, [], 0
                n_left += not on_right
                held.append(row)
            yield pd.DataFrame(out, columns=names, dtype="int64")
        yield pd.DataFrame(done(), columns=names, dtype="int64")

    return tasks.mapInPandas(run, schema)


def near_duplicate_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98
) -> DataFrame:
    """One row per row of df: the id, n_links, component_id and kept.

    Two rows are linked if their labels are equal and not null, their vectors are equally
    long and their cosine in double precision is `least` or more. A vector that is null,
    empty, zero or holds a null or a value that is not finite has no link; each such row
    is its own component, as is a row without a label. component_id is the smallest id
    reachable, kept says whether it is the row's own. Rows without an id take part;
    component_id is null where a whole component has none. Repeated rows are linked with
    each other unless they have no links at all. An empty table gives an empty table;
    other columns are not read.
    """
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(row_key(id_col, F.struct(label_col, vector_col)).alias("key"), F.col(label_col).alias("label"), vector.alias("vector"))
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda v: v != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))

    classes = rows.where("usable").groupBy("label", "vector").agg(F.min("key").alias("rep"), F.count("*").alias("copies"))
    classes = staged(classes, "vectors")

    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    codes = codes_for(largest)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters: dict[int, Filters] = {}
        for batch in batches:
            vectors = [np.asarray(v, np.float64) for v in batch["vector"]]
            lists, signs = [None] * len(vectors), [0] * len(vectors)
            for dim in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == dim]
                x = np.array([vectors[k] for k in at])
                x /= np.abs(x).max(1, keepdims=True)  # before squaring
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if dim not in filters:
                    filters[dim] = Filters(dim, codes)
                for k, found, bits in zip(at, filters[dim].lists(x), filters[dim].signs(x).tolist()):
                    lists[k], signs[k] = found, bits
            yield batch.assign(vector=[v.tobytes() for v in vectors], dim=[len(v) for v in vectors], filters=lists, signs=signs)

    kind = classes.schema["label"].dataType.simpleString()
    coded = classes.mapInPandas(listed, f"label {kind}, vector binary, rep long, copies long, dim int, filters array<long>, signs long")
    coded = staged(coded, "filters")

    shared = ["label", "dim", "filter"]
    entries = coded.select("label", "dim", F.explode("filters").alias("filter"), "rep", "signs")
    kept = _in_tasks(entries, ["rep", "signs"], lambda task, held, n_left: [(k, task[2]) for k in _thinned(held, n_left)], "rep long, filter long")
    # A chunk meets several others. Keys are of one label and length.
    kept = kept.groupBy("rep").agg(F.array_sort(F.collect_set("filter")).alias("filters"))  # at most a vector's list
    again = coded.drop("filters", "signs").join(kept, "rep")
    again = again.select("label", "dim", F.explode("filters").alias("filter"), "rep", "copies", "vector", "filters")

    def compare(task: list, held: list[tuple], n_left: int) -> list[tuple]:
        rows = [(rep, copies, np.frombuffer(vec), np.asarray(own)) for rep, copies, vec, own in held]
        return _linked(task[2], rows, n_left, least)

    found = staged(_in_tasks(again, ["rep", "copies", "vector", "filters"], compare, "hi long, lo long, links long"), "found")
    components = connected_components(found.select("hi", "lo"))
    links = found.groupBy("hi").agg(F.sum("links").alias("links"))
    placed = classes.join(links, classes["rep"] == links["hi"], "left").join(components, F.col("rep") == F.col("node"), "left")
    placed = placed.select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component"))

    result = rows.where("usable").join(placed, ["label", "vector"]).select("key", "n_links", "component")
    alone = rows.where("not usable").select("key", F.lit(0).cast("long"), F.col("key"))
    return result.union(alone).select(
        id_of(F.col("key")).alias(id_col),
        "n_links",
        id_of(F.col("component")).alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"),
    )
