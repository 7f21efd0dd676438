"""Toxicity by a support vector machine on a subsequence string kernel.

A text is read as windows of up to WIDTH letters and digits: each word, and each run of
words put together, with the white space and punctuation in and between them left out.
The kernel of two windows counts the subsequences of three characters they share, within
SPAN characters and weighed down for each character a gap adds; so an insult with an
inserted character, a gap, or spread over several words still shares most of its weight.

The machine is trained on windows of the labelled texts with the text's label as target,
as in multiple-instance learning: a clean text's windows are clean, and of a toxic text
the window that the machine finds most toxic is taken, in several rounds. Landmark
windows give the Nyström features. A text scores by its most toxic window, and a logistic
curve through the labelled texts turns that into a probability.

Since all subsequences of the landmarks are known, the trained machine folds into one
weight per subsequence, a table of fixed size that is sent to the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import ship, staged, with_fields

ship(__name__)

# Labelled rows the model is fitted on at most.
TRAIN_ROWS = 20_000
# Words by which the first windows of toxic texts are found.
SUSPECTS = 20_000
LANDMARKS_TOXIC, LANDMARKS_CLEAN = 64, 64
# Rounds of training; each learns from the highest windows under the machine before it.
ROUNDS = 2
# Windows taken of a toxic text at most.
PER_TEXT = 4
# Hashes by which near copies in the sample are told.
SIGNATURE = 4
SPAN, DECAY = 7, 0.6
# Letters of a window at most; longer words are cut into pieces.
WIDTH, PIECE = 16, 8
SYMBOLS, MARK = 64, 27
# Characters that are scored together.
TOGETHER = 200_000
# Weight of the length of the separating vector in training.
RIDGE = 5e-4
# A text without three letters scores as this margin, others no lower.
NOTHING = -3.0

GAPS = [(a, b) for a in range(1, SPAN - 1) for b in range(a + 1, SPAN)]


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


# Filled on first use; a plain dictionary travels by value with the functions that read it.
_held: dict[str, np.ndarray] = {}


def _symbols() -> np.ndarray:
    """The symbol of each character: a letter of its own for a to z, MARK for what is no letter or digit."""
    if "symbols" not in _held:
        _held["symbols"] = _made_symbols()
    return _held["symbols"]


def _made_symbols() -> np.ndarray:
    chars = np.arange(0x110000)
    made = np.where((chars >= 97) & (chars <= 122), chars - 96, MARK + 1 + chars % (SYMBOLS - MARK - 1))
    known = 0x3100  # above it, all but private and presentation forms and emoji count as letters
    other = np.array([not chr(k).isalnum() for k in range(known)])
    made[:known][other] = MARK
    made[0xD800:0xF900] = made[0xFE00:0xFE30] = MARK
    made[0xFEFF] = MARK
    made[0x1F000:0x20000] = MARK
    return made.astype(np.uint8)


def stream(text: str | None) -> np.ndarray:
    """The symbols of a lower-cased text, with one MARK for each run of other characters and at both ends."""
    chars = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _symbols()[chars]
    kept = found != MARK
    kept[1:] |= found[:-1] != MARK
    kept[0] = True
    return found[kept]


def words_of(text: str | None) -> set[bytes]:
    """The distinct words of a text as symbols."""
    return {w for w in stream(text).tobytes().split(bytes([MARK])) if len(w) >= 3}


def rows_of(windows: list[bytes]) -> np.ndarray:
    """Windows as rows of symbols, 0 past the end."""
    flat = b"".join(w[:WIDTH].ljust(WIDTH, b"\0") for w in windows)
    return np.frombuffer(flat, np.uint8).reshape(len(windows), WIDTH).astype(np.int32)


def codes(rows: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """For each way to leave gaps its weight and the subsequences of every place, 0 for none."""
    width = rows.shape[1]
    for a, b in GAPS:
        x, y, z = rows[:, : width - b], rows[:, a : width - b + a], rows[:, b:]
        yield DECAY ** (b - 2), np.where(z > 0, (x * SYMBOLS + y) * SYMBOLS + z, 0)


def norms(rows: np.ndarray) -> np.ndarray:
    """The length of a window's feature vector, had it no subsequence twice."""
    lens = (rows > 0).sum(1)
    total = sum(np.maximum(lens - b, 0) * DECAY ** (2 * (b - 2)) for _, b in GAPS)
    return np.sqrt(np.maximum(total, 1e-9))


def table_of(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weighted sum of windows' normalised features, by subsequence."""
    table = np.zeros(SYMBOLS**3)
    scale = weights / norms(rows)
    for weight, code in codes(rows):
        table += np.bincount(code.ravel(), np.repeat(weight * scale, code.shape[1]), SYMBOLS**3)
    table[0] = 0
    return table


def against(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The kernel of windows with what a table sums up."""
    total = np.zeros(len(rows))
    for weight, code in codes(rows):
        total += weight * table[code].sum(1)
    return total / norms(rows)


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """The kernel of each window with each landmark."""
    held = np.unique(np.concatenate([code.ravel() for _, code in codes(landmarks)]))
    place = np.zeros(SYMBOLS**3, np.int64)
    place[held] = np.arange(len(held))
    place[0] = 0  # held begins with 0, for no subsequence
    tables = np.zeros((len(held), len(landmarks)), np.float32)
    scale = 1 / norms(landmarks)
    for weight, code in codes(landmarks):
        np.add.at(tables, (place[code], np.arange(len(landmarks))[:, None]), (weight * scale)[:, None])
    tables[place[0]] = 0
    total = np.zeros((len(rows), len(landmarks)), np.float32)
    for weight, code in codes(rows):
        at = place[code]
        for column in at.T:
            some = np.flatnonzero(column)
            total[some] += weight * tables[column[some]]
    return total / norms(rows)[:, None]


class Scorer:
    """Margins of texts under a trained machine."""

    def __init__(self, table: np.ndarray, bias: float) -> None:
        self.table, self.bias = table.astype(np.float32), bias
        self.scale = 1 / norms(np.tri(WIDTH + 1, WIDTH, -1))  # by length

    def windows(self, streams: Iterable[np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
        """For some streams at a time, which are drawn then: their letters, and each window's stream, start, length and margin."""
        some: list[np.ndarray] = []
        first = size = 0
        for one in streams:
            if some and size + len(one) > TOGETHER:
                yield self._windows(some, first)
                first, size, some = first + len(some), 0, []
            some.append(one)
            size += len(one)
        if some:
            yield self._windows(some, first)

    def _windows(self, streams: list[np.ndarray], first: int) -> tuple[np.ndarray, ...]:
        marked = np.concatenate(streams)
        inside = marked != MARK
        letters = marked[inside]
        before = np.r_[0, np.cumsum(inside)]
        # Words, long ones in pieces.
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = before[change[::2]], before[change[1::2]]
        n = np.where(end - start > WIDTH, -(-(end - start) // PIECE), 1)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        end = np.where(k + 1 < np.repeat(n, n), np.repeat(start, n) + (k + 1) * PIECE, np.repeat(end, n))
        start = np.repeat(start, n) + k * PIECE
        offsets = before[np.cumsum([0] + [len(s) for s in streams[:-1]])]
        text = np.searchsorted(offsets, start, "right") - 1

        # Running sums of the weights of the subsequences that begin at each place, by extent.
        padded = np.r_[letters, np.zeros(SPAN, np.uint8)].astype(np.int32)
        size, sums = len(letters), {}
        pairs = [((padded[:size] * SYMBOLS) + padded[a : a + size]) * SYMBOLS for a in range(1, SPAN - 1)]
        for b in range(2, SPAN):
            z = padded[b : b + size]
            part = sum(self.table[pairs[a - 1] + z] for a in range(1, b))
            sums[b] = np.r_[0, np.cumsum(DECAY ** (b - 2) * part, dtype=np.float64)]

        found = []
        at = np.arange(len(start))
        for more in range(WIDTH):
            at = at[at + more < len(start)]
            at = at[(text[at + more] == text[at]) & (end[at + more] - start[at] <= WIDTH)]
            s, e = start[at], end[at + more]
            some = e - s >= 3
            t, s, e = text[at][some], s[some], e[some]
            total = sum(c[np.maximum(e - b, s)] - c[s] for b, c in sums.items())
            found.append((t + first, s, e - s, total * self.scale[e - s] + self.bias))
        return letters, *[np.concatenate(x) for x in zip(*found)]

    def margins(self, texts: list[str | None]) -> list[float]:
        best = np.full(len(texts), NOTHING)
        for _, text, _, _, margin in self.windows(map(stream, texts)):
            np.maximum.at(best, text, margin)
        return best.tolist()


def signature(text: str | None) -> list[int]:
    """The smallest hashes of a text's runs of three words, one for each seed."""
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    return [min(xxhash.xxh3_64_intdigest(r, seed=k) for r in runs) - (1 << 63) for k in range(SIGNATURE)]


def _without_copies(texts: DataFrame) -> DataFrame:
    """Texts of the sample that share no smallest hash, so that copies do not vouch for their words."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "toxic": batch["toxic"], "hash": [signature(t) for t in batch["text"]]})

    kept = staged(texts.mapInPandas(sign, "id long, toxic int, hash array<long>"), "signatures")
    for k in range(SIGNATURE):
        first = kept.groupBy("toxic", F.col("hash")[k].alias("h")).agg(F.min(F.struct("id", "hash")).alias("first"))
        kept = first.select("first.id", "toxic", "first.hash")
    # At most TRAIN_ROWS.
    return texts.join(F.broadcast(kept.select("id", "toxic").distinct()), ["id", "toxic"], "left_semi")


def _varied(window: bytes, rng: np.random.Generator) -> list[bytes]:
    """The window with a letter put in, replaced and doubled."""
    k = int(rng.integers(1, max(2, len(window) - 1)))
    other = bytes([int(rng.integers(1, 27))])
    return [window[:k] + other + window[k:], window[:k] + other + window[k + 1 :], window[:k] + window[k - 1 :]]


def train(toxic: list[bytes], clean: list[bytes]) -> tuple[np.ndarray, float]:
    """The folded weights and the bias of a machine that tells windows of toxic texts from clean ones."""
    rng = np.random.default_rng(5)
    positive = toxic + [v for w in toxic for v in _varied(w, rng)]
    x, y = rows_of(positive + clean), np.r_[np.ones(len(positive)), -np.ones(len(clean))].astype(np.float32)

    # Landmarks: the commonest toxic windows, then each time the one least like those taken; clean ones.
    often = rows_of([w for w, _ in sorted(Counter(toxic).items(), key=lambda i: (-i[1], i[0]))[: 4 * LANDMARKS_TOXIC]])
    taken = list(range(min(LANDMARKS_TOXIC // 2, len(often))))
    best = kernel(often, often[taken]).max(1)
    while len(taken) < min(LANDMARKS_TOXIC, len(often)):
        taken.append(int(best.argmin()))
        best = np.maximum(best, against(table_of(often[taken[-1:]], np.ones(1)), often))
    others = [clean[k] for k in rng.permutation(len(clean))[:LANDMARKS_CLEAN]]
    landmarks = np.r_[often[taken], rows_of(others)]
    between = kernel(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    half = vectors @ np.diag(np.maximum(values, 1e-3) ** -0.5) @ vectors.T
    a = np.c_[kernel(x, landmarks) @ half.astype(np.float32), np.ones(len(y), np.float32)]

    # Squared hinge loss, both classes weighing the same, by Newton steps.
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()).astype(np.float32)
    ridge = np.r_[np.full(a.shape[1] - 1, RIDGE), 1e-9]
    loss = lambda t: float((weight * np.maximum(0, 1 - y * (a @ t.astype(np.float32))) ** 2).sum() + (ridge * t * t).sum())
    theta = np.zeros(a.shape[1])
    now = loss(theta)
    for _ in range(30):
        gap = np.maximum(0, 1 - y * (a @ theta.astype(np.float32)))
        inside = a[gap > 0] * np.sqrt(weight[gap > 0])[:, None]
        gradient = -(a.T @ (weight * y * gap)) + ridge * theta
        move = np.linalg.solve((inside.T @ inside).astype(np.float64) + np.diag(ridge + 1e-9), gradient)
        step = 1.0
        while step > 1e-3 and loss(theta - step * move) > now:
            step /= 2
        theta = theta - step * move
        before, now = now, loss(theta)
        if before - now < 1e-5 * before:
            break
    return table_of(landmarks, half @ theta[:-1]).astype(np.float32), float(theta[-1])


def fit_curve(margins: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of labels over margins, classes weighing the same."""
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        gradient = np.array([(weight * (p - toxic) * margins).sum() + 1e-4 * slope, (weight * (p - toxic)).sum()])
        h = weight * p * (1 - p)
        hessian = np.array([[(h * margins**2).sum() + 1e-4, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hessian, gradient)
        slope, offset = slope - float(np.clip(move[0], -2, 2)), offset - float(np.clip(move[1], -2, 2))
    return slope, offset


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple | None:
    """(folded weights, bias, slope, offset), or None where the sample lacks one of the classes."""
    spark = docs.sparkSession
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    sample = usable.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).distinct()
    sample = staged(sample.orderBy(F.xxhash64("id", "toxic")).limit(TRAIN_ROWS), "sample")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # The sample is bounded by TRAIN_ROWS, and so are the texts: an id's smallest stands for it.
    texts = texts.join(F.broadcast(sample), "id").groupBy("id", "toxic").agg(F.min("text").alias("text"))
    texts = staged(texts, "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen[toxic].update(words_of(text))
            words = list(seen[0] | seen[1])
            yield pd.DataFrame({"word": words, "clean": [seen[0][w] for w in words], "toxic": [seen[1][w] for w in words]})

    single = _without_copies(texts)
    words = single.mapInPandas(count, "word binary, clean long, toxic long")
    words = words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in single.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    # Likelihood ratio of a word in toxic texts against chance. It says where to look first.
    share = n[1] / (n[0] + n[1])
    seen = F.col("clean") + F.col("toxic")
    rate = F.col("toxic") / seen
    part = lambda k, p, q: F.when(k > 0, 2 * k * F.log(p / q)).otherwise(0.0)
    ratio = part(F.col("toxic"), rate, share) + part(F.col("clean"), 1 - rate, 1 - share)
    suspects = words.where(rate > share).select("word", ratio.alias("ratio")).orderBy(F.desc("ratio"), "word").limit(SUSPECTS)
    suspects = {bytes(r["word"]): r["ratio"] for r in suspects.collect()}
    toxic, clean = _windows(texts, suspects=suspects)
    if not toxic or not clean:
        return None
    for _ in range(ROUNDS):
        toxic, hard = _windows(texts, machine=train(toxic, clean))
        clean = clean + hard
    table, bias = train(toxic, clean)

    shipped = spark.sparkContext.broadcast((table, bias))  # fixed size

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(*shipped.value)
        for batch in batches:
            yield pd.DataFrame({"margin": scorer.margins(batch["text"].tolist()), "toxic": batch["toxic"]})

    found = texts.mapInPandas(margins, "margin double, toxic int").toPandas()  # TRAIN_ROWS at most
    slope, offset = fit_curve(found["margin"].to_numpy(), found["toxic"].to_numpy() == 1)
    return table, bias, slope, offset


def _drawn(ids: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A number for each window that depends on its text's id and its place in the text alone."""
    if not len(text):
        return np.zeros(0)
    first = np.full(text.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, text, start)
    mixed = ids.astype(np.uint64)
    for part in (start - first[text], length):
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(11)) / 2.0**53


def _windows(texts: DataFrame, suspects: dict[bytes, float] | None = None, machine: tuple | None = None) -> tuple[list[bytes], list[bytes]]:
    """Windows of the toxic and of the clean texts, of each text that has three letters.

    Of a clean text it is the one with the highest margin, before there is a machine any;
    of a toxic one those apart from each other, PER_TEXT at most, whose margin is half the
    highest or more, before there is a machine its most suspect words.
    """
    shipped = texts.sparkSession.sparkContext.broadcast((suspects or {}, machine))  # SUSPECTS words, or fixed size

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        suspects, machine = shipped.value
        scorer = Scorer(*machine or (np.zeros(SYMBOLS**3), 0.0))
        for batch in batches:
            ids, labels, rows = batch["id"].tolist(), batch["toxic"].tolist(), []
            for letters, text, start, length, margin in scorer.windows(map(stream, batch["text"])):
                if not machine:
                    margin = _drawn(np.array(ids)[text], text, start, length)
                order = np.lexsort((-margin, text))
                for own in np.split(order, np.flatnonzero(np.diff(text[order])) + 1):
                    if not len(own):
                        continue
                    k = int(text[own[0]])
                    own = own[: 10 * PER_TEXT if labels[k] and machine else 1]
                    own = own[(margin[own] >= margin[own[0]] / 2) | (own == own[0])]
                    taken: list[tuple[int, int]] = []
                    for s, e in zip(start[own].tolist(), (start[own] + length[own]).tolist()):
                        if len(taken) < PER_TEXT and all(s >= b or e <= a for a, b in taken):
                            taken.append((s, e))
                    found = {letters[s:e].tobytes() for s, e in taken}
                    if labels[k] and suspects:
                        known = [w for w in words_of(batch["text"].iloc[k]) if w in suspects]
                        best = max((suspects[w] for w in known), default=0)
                        found = {w for w in known if suspects[w] >= best / 2} or found
                    rows += [(ids[k], labels[k], w) for w in found]
            yield pd.DataFrame(rows, columns=["id", "toxic", "window"])

    made = texts.mapInPandas(pick, "id long, toxic int, window binary").toPandas()  # some windows for each of TRAIN_ROWS texts
    made["window"] = made["window"].map(bytes)
    made = made.sort_values(["toxic", "id", "window"])
    return tuple(made.loc[made["toxic"] == k, "window"].tolist() for k in (1, 0))


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """docs with held_out, score and predicted, in place of columns of these names.

    The model is fitted on up to TRAIN_ROWS labelled rows (by hash of the id) whose crc32
    of the id modulo 5 is not 0; held_out marks the others, labelled or not, and is null
    without an id. score is between 0 and 1; null texts, empty ones and those without
    three letters get that of a very clean text. predicted is 1 from 0.5 on.
    Where the labels hold one class only, or none, every score is 0. Labels that are not 0
    or 1 are passed over. Repeated rows get equal scores; an empty table stays empty.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    names = ["score", "predicted"]
    if model is None:
        made = docs.drop("held_out", *names).withColumn("score", F.lit(0.0)).withColumn("predicted", F.lit(0))
        return made.withColumn("held_out", held_out(id_col))
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    @F.pandas_udf("score double, predicted int")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table, bias, slope, offset = shipped.value
        scorer = Scorer(table, bias)
        for texts in batches:
            margins = np.array(scorer.margins(texts.tolist()), np.float64)
            p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
            yield pd.DataFrame({"score": p, "predicted": (p >= 0.5).astype(np.int32)})

    return with_fields(docs, scored(F.col(text_col)), names).withColumn("held_out", held_out(id_col))
