"""Near-duplicates by HyperMinHash signatures, exact links and connected components.

A document's set holds a 64-bit hash of each distinct run of `words` words. Its
signature is one pass of HyperMinHash: the hash picks one of BANDS * ROWS buckets, and a
bucket keeps, of its smallest hash, the number of leading zeros and the next bits, in 16
bits. Bands of ROWS registers are hashed, and documents that share a band are candidates.

Equal sets are one class, so copies cost one row each and no pairs. Candidate classes
form clusters; a cluster is cut into blocks, and each pair of blocks is one task that
knows its documents' whole texts. It compares signatures, corrects the estimate for
registers that agree by chance, confirms on the full sets, and returns at most one link
per document: links inside a group that is already joined are not looked for, since the
result is the components.

Documents that merely share a passage meet in some band too, and in a large corpus such
chance meetings would chain everything into one cluster. So members of a band are first
compared by short sketches of their signatures, and only close ones are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legalops.llm.common import id_of, row_key, ship, staged
from legalops.llm.components import connected_components

ship(__name__)

# At a similarity of 0.8 a pair shares none of 40 bands of 6 with probability 5e-6.
BANDS, ROWS = 40, 6
BUCKETS = BANDS * ROWS
ZERO_BITS, MANTISSA_BITS = 6, 10
# A task compares two blocks of at most so many documents and shingles, or of one document.
BLOCK_DOCS, BLOCK_SHINGLES = 2048, 2_000_000
# Standard errors by which an estimate may fall short before a pair is not confirmed.
SLACK = 5.0
REMEMBERED = 300_000
# Registers in a sketch, a byte each, and classes of one band in a task.
SKETCH = 96
CHUNK = 2048
# Up to so many in a band all pairs are compared at once.
FEW = 12


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Shingler:
    """Sets of hashed runs of words, lower-cased in A-Z; fewer words give one run."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.known: dict[bytes, int] = {}

    def set_of(self, text: str | None) -> np.ndarray:
        # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
        tokens = (text or "").encode().lower().split()
        if not tokens:
            return np.zeros(0, np.uint64)
        new = set(tokens).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known, new = {}, set(tokens)
            self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        h = np.fromiter(map(self.known.__getitem__, tokens), np.uint64, len(tokens))
        run = min(self.words, len(h))
        total = np.full(len(h) - run + 1, run, np.uint64)
        for k in range(run):
            total = total * np.uint64(0x2545F4914F6CDD1D) + h[k : len(h) - run + 1 + k]
        return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket; 0 where no shingle fell."""
    registers = np.zeros(BUCKETS, np.uint16)
    h = _mix(shingles ^ np.uint64(0x6A09E667F3BCC909))
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    value = _mix(h)
    smallest = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(smallest, bucket, value)
    used = np.flatnonzero(np.bincount(bucket, minlength=BUCKETS))
    v = smallest[used]
    zeros = np.minimum(63 - np.floor(np.log2(np.maximum(v, np.uint64(1)).astype(np.float64))), (1 << ZERO_BITS) - 2)
    zeros = np.maximum(zeros, 0).astype(np.uint64)
    mantissa = (v << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    registers[used] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    return registers


def band_keys(registers: np.ndarray) -> list[int]:
    """A key for each band that holds any shingle."""
    keys = []
    for b, band in enumerate(registers.reshape(BANDS, ROWS)):
        if band.any():
            keys.append(xxhash.xxh3_64_intdigest(band.tobytes(), seed=b) - (1 << 63))
    return keys


def sketch(registers: np.ndarray) -> np.ndarray:
    """Some of the registers in a byte each; 0 stays 0."""
    r = registers[:SKETCH].astype(np.uint32)
    return np.where(r > 0, (r * np.uint32(40503) >> np.uint32(7)) % np.uint32(255) + np.uint32(1), 0).astype(np.uint8)


def alike(a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Which rows of sketches may well be of sets as similar as `least` per cent."""
    used = (a > 0) | (b > 0)
    both = used.sum(-1)
    estimate = ((a == b) & used).sum(-1) / np.maximum(both, 1)
    target = least / 100
    return estimate >= target - SLACK * np.sqrt(target * (1 - target) / np.maximum(both, 1))


def join_alike(keys: np.ndarray, sketches: np.ndarray, n_left: int, least: int) -> list[tuple[int, int]]:
    """A spanning set of the alike pairs of one band's classes, or across two chunks of them."""
    group, joined = np.arange(len(keys)), []
    across = n_left < len(keys)
    for i in range(n_left):
        others = np.arange(n_left, len(keys)) if across else np.arange(i + 1, len(keys))
        others = others[group[others] != group[i]]
        for j in others[alike(sketches[others], sketches[i], least)]:
            if group[j] != group[i]:
                joined.append((int(keys[i]), int(keys[j])))
                group[group == group[j]] = group[i]
    return joined


def chance(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """How often a register of two unrelated sets agrees.

    The smallest of s hashes in a bucket is close to exponential with rate s. Two such
    minima agree by chance if they fall in one cell; a cell of the register at value v is
    v * 2^-MANTISSA_BITS wide or less, which gives at most 2^-MANTISSA_BITS * 2ab/(a+b)^2.
    """
    a, b = np.maximum(size_a, 1.0), np.maximum(size_b, 1.0)
    return 2.0**-MANTISSA_BITS * 2 * a * b / (a + b) ** 2


def link_blocks(left: list, right: list | None, least: int) -> list[tuple[int, int]]:
    """A spanning set of the links between two blocks, or inside one.

    A block is a list of (key, set, registers). Links are confirmed on the full sets:
    100 * shared >= least * united. A document is compared with those it is not joined
    with yet.
    """
    rows = left + (right or [])
    n = len(left)
    if len(rows) < 2:
        return []
    regs = np.array([r for _, _, r in rows])
    used = regs > 0
    sizes = np.array([len(s) for _, s, _ in rows])
    group = np.arange(len(rows))
    links = []
    target = least / 100
    for i in range(n):
        others = np.arange(n, len(rows)) if right is not None else np.arange(i + 1, n)
        others = others[(group[others] != group[i])]
        big, small = np.maximum(sizes[others], sizes[i]), np.minimum(sizes[others], sizes[i])
        others = others[100 * small >= least * big]
        if not len(others):
            continue
        both = (used[others] | used[i]).sum(1)
        agree = ((regs[others] == regs[i]) & used[i]).sum(1)
        c = chance(sizes[others] / BUCKETS, sizes[i] / BUCKETS)
        estimate = (agree / both - c) / (1 - c)
        near = estimate >= target - SLACK * np.sqrt(target * (1 - target) / both)
        order = np.argsort(-estimate[near], kind="stable")
        for j in others[near][order]:
            if group[j] == group[i]:
                continue
            shared = len(np.intersect1d(rows[i][1], rows[j][1], assume_unique=True))
            if 100 * shared >= least * (sizes[i] + sizes[j] - shared):
                links.append((rows[i][0], rows[j][0]))
                group[group == group[j]] = group[i]
    return links


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: int = 80
) -> DataFrame:
    """One row per row of df: the id, n_shingles, component_id and kept.

    Rows are linked if their sets of runs of `words` words share `least` per cent or more
    of their union. component_id is the smallest id reachable by links. kept is true for
    the row with that id. Null and empty texts and texts of white space have no set
    (n_shingles 0) and are linked with nothing; each is its own component. A row without
    an id takes part; component_id is null where no row of its component has an id, and
    then the rows that equal the component's first are kept. Repeated rows give repeated
    results; rows that share an id count as linked. An empty table gives an empty table;
    other columns are not read.
    """
    placed = _placed(df.select(row_key(id_col, F.col(text_col)).alias("key"), F.col(text_col).alias("text")), words, least)
    return placed.select(
        id_of(F.col("key")).alias(id_col),
        "n_shingles",
        id_of(F.col("root")).alias("component_id"),
        (F.col("key") == F.col("root")).alias("kept"),
    )


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: int = 80
) -> DataFrame:
    """The rows whose id `near_duplicates` keeps, with all their columns as they were.

    Rows that share an id stay or go together; they go if none of them is kept.
    """
    key = row_key(id_col, F.col(text_col))
    placed = _placed(df.select(key.alias("key"), F.col(text_col).alias("text")), words, least)
    gone = placed.groupBy("key").agg(F.max(F.col("key") == F.col("root")).alias("kept")).where("not kept")
    rows = df.select(F.struct("*").alias("row"), key.alias("key"))
    return rows.join(gone.select("key"), "key", "left_anti").select("row.*")


def _placed(docs: DataFrame, words: int, least: int) -> DataFrame:
    """key, n_shingles and the root of its component for each row of (key, text)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        for batch in batches:
            made = []
            for key, text in zip(batch["key"], batch["text"]):
                s = shingler.set_of(text)
                if len(s):
                    registers = signature(s)
                    made.append((key, len(s), xxhash.xxh3_128_digest(s.tobytes()), sketch(registers).tobytes(), band_keys(registers)))
                else:
                    made.append((key, 0, None, None, None))
            yield pd.DataFrame(made, columns=["key", "n_shingles", "digest", "sketch", "bands"])

    signed = staged(
        docs.mapInPandas(sign, "key long, n_shingles long, digest binary, sketch binary, bands array<long>"), "signed"
    )

    # One class for each set. What else follows from the set, so any row's will do.
    classes = signed.where(F.col("n_shingles") > 0).groupBy("digest").agg(
        F.min("key").alias("rep"), *[F.first(c).alias(c) for c in ("n_shingles", "sketch", "bands")]
    )
    classes = staged(classes, "classes")
    clusters = connected_components(_alike(classes, least))  # node, root; nodes with a candidate only
    links = _confirmed(docs, classes, clusters, words, least)
    components = connected_components(links)

    same_set = signed.join(classes.select("digest", "rep"), "digest", "left")
    found = same_set.select("key", "n_shingles", F.coalesce("rep", "key").alias("node"))
    found = found.join(components, "node", "left")
    return found.select("key", "n_shingles", F.coalesce("root", "node").alias("root"))


def _alike(classes: DataFrame, least: int) -> DataFrame:
    """Pairs (hi, lo) of classes that share a band and whose sketches are alike, or a chain of such."""
    banded = classes.select("rep", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK)
    member = banded.join(shared.select("band", chunks.alias("chunks")), "band").join(classes.select("rep", "sketch"), "rep")
    member = member.withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")))
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda k: F.struct(F.least("chunk", k).alias("i"), F.greatest("chunk", k).alias("j")),
    )
    tasks = (
        member.select("band", "rep", "sketch", "chunk", F.explode(meets).alias("task"))
        .select("band", "task.i", "task.j", (F.col("chunk") > F.col("task.i")).alias("on_right"), "rep", "sketch")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j", "on_right", "rep")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            task = batch[["band", "i", "j"]].to_numpy()
            starts = np.flatnonzero(np.r_[True, (task[1:] != task[:-1]).any(1)])
            # The last task may go on in the next batch.
            rest = batch.iloc[starts[-1] :]
            yield pairs(batch, starts)
        if rest is not None and len(rest):
            yield pairs(rest.reset_index(drop=True), np.array([0, len(rest)]))

    def pairs(batch: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
        """The alike pairs of whole tasks, each from one bound to the next."""
        keys = batch["rep"].to_numpy()
        sketches = np.frombuffer(b"".join(batch["sketch"]), np.uint8).reshape(len(batch), SKETCH)
        right, same = batch["on_right"].to_numpy(), (batch["i"] == batch["j"]).to_numpy()
        found = []
        sizes = np.diff(bounds)
        few = same[bounds[:-1]] & (sizes <= FEW)
        for m in range(2, FEW + 1):
            at = bounds[:-1][few & (sizes == m)]
            a, b = np.triu_indices(m, 1)
            left, other = (at[:, None] + a).ravel(), (at[:, None] + b).ravel()
            near = alike(sketches[left], sketches[other], least)
            found += zip(keys[left[near]].tolist(), keys[other[near]].tolist())
        for at, size in zip(bounds[:-1][~few], sizes[~few]):
            if size > 1:
                own = slice(at, at + size)
                found += join_alike(keys[own], sketches[own], int(size - right[own].sum()), least)
        return pd.DataFrame(found, columns=["hi", "lo"], dtype="int64")

    return tasks.mapInPandas(compare, "hi long, lo long")


def _confirmed(docs: DataFrame, classes: DataFrame, clusters: DataFrame, words: int, least: int) -> DataFrame:
    """Links between candidate classes, confirmed on the sets of their whole texts."""
    members = clusters.join(classes.select(F.col("rep").alias("node"), "digest", "n_shingles"), "node")
    so_far = Window.partitionBy("root").orderBy("node", "digest").rowsBetween(Window.unboundedPreceding, 0)
    block = F.greatest(
        F.floor((F.count("*").over(so_far) - 1) / BLOCK_DOCS),
        F.floor(F.sum("n_shingles").over(so_far) / BLOCK_SHINGLES),
    )
    placed = members.withColumn("block", block)
    blocks = placed.groupBy("root").agg((F.max("block") + 1).alias("blocks"))
    placed = placed.join(blocks, "root").select("root", "node", "digest", "block", "blocks")

    # Every pair of blocks of a cluster is a task; a block meets itself in one of them.
    meets = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")),
    )
    tasks = (
        placed.join(docs, F.col("node") == F.col("key"))
        .select("root", "node", "digest", "block", "text", F.explode(meets).alias("task"))
        .select("root", "task.i", "task.j", (F.col("block") > F.col("task.i")).alias("on_right"), "node", "digest", "text")
        .repartition("root", "i", "j")
        .sortWithinPartitions("root", "i", "j", "on_right", "node", "digest")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words)
        task, left, right, seen, links = None, [], [], set(), []
        for batch in batches:
            columns = [batch[c] for c in ("root", "i", "j", "on_right", "node", "digest", "text")]
            for root, i, j, on_right, node, digest, text in zip(*columns):
                if (root, i, j) != task:
                    links += link_blocks(left, right if task and task[1] < task[2] else None, least)
                    task, left, right, seen = (root, i, j), [], [], set()
                shingles = shingler.set_of(text)
                # Repeated rows come once; of rows that share an id, the class's own.
                if (node, digest) in seen or xxhash.xxh3_128_digest(shingles.tobytes()) != digest:
                    continue
                seen.add((node, digest))
                (right if on_right else left).append((node, shingles, signature(shingles)))
            yield pd.DataFrame(links, columns=["hi", "lo"], dtype="int64")
            links = []
        links = link_blocks(left, right if task and task[1] < task[2] else None, least)
        yield pd.DataFrame(links, columns=["hi", "lo"], dtype="int64")

    return tasks.mapInPandas(compare, "hi long, lo long")
