"""Quality by hierarchical empirical Bayes.

A document's own evidence is a naive Bayes log-odds over binned features of its text,
with bins counted on the labelled documents. Hosts and paths add what their other
documents say: each counts as its label where it has one to learn from, else as the
chance that its text is good. A host's rate of good documents is shrunk toward the global
rate, and a path's toward its host's, each by a prior whose strength follows from how much
the rates vary; where they vary no more than chance has it, the rate above stands. A site
with few documents thus stays near the rate above it. The score combines the evidence with
the path's rate in place of the global one. A document's own share is taken out of both
sums before, so nothing counts twice.

Everything is built from grouped aggregates; a hot host or path is summed before the
shuffle.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import SPACE, id_of, row_key, staged

# Upper ends of the features' bins.
BINS = {
    "distinct": [0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "letters": [0.3, 0.5, 0.6, 0.65, 0.7, 0.75, 0.78, 0.8, 0.82, 0.84, 0.86, 0.9],
    "capitals": [0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.2, 0.5],
    "symbols": [0.001, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.2],
    "word_length": [2.0, 3.0, 4.0, 4.5, 5.0, 5.5, 6.0, 7.0, 9.0, 12.0],
    "words": [1.0, 5.0, 10.0, 20.0, 50.0, 200.0, 1000.0, 5000.0],
    "repeats": [0.001, 0.01, 0.03, 0.1, 0.3, 0.6],
}
# Pseudo-counts that a prior has at least, however much the rates vary.
LEAST_STRENGTH = 1.0
# Sites of fewer documents say nothing about how much rates vary.
LEAST_DOCUMENTS = 5


def held_out_of(number: Column) -> Column:
    """Whether a row of this id is kept from the labels that are learned."""
    return F.crc32(number.cast("string").cast("binary")) % 5 == 0


def features(text: Column) -> dict[str, Column]:
    """Shares and sizes that good prose keeps within bounds; 0 for texts without words."""
    words = F.array_remove(F.split(text, SPACE, -1), "")
    n, chars = F.size(words), F.greatest(F.length(text), F.lit(1))
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    left = lambda pattern: F.length(F.regexp_replace(text, pattern, ""))
    return {
        "distinct": over(F.size(F.array_distinct(words)), n),
        "letters": left(r"\P{L}+") / chars,
        "capitals": left(r"\P{Lu}+") / chars,
        "symbols": left(r"[\p{L}\p{N}\s.,;:'\"?!()-]+") / chars,
        "word_length": over(left(SPACE), n),
        "words": n.cast("double"),
        "repeats": F.regexp_count(text, F.lit(r"(?<![^\s])([^\s]++)\s\1(?![^\s])")) / F.greatest(n, F.lit(1)),
    }


def _over(value: Column, ends: list[float]) -> Column:
    """How many of the bins' ends lie under the value."""
    return sum(((value > e).cast("int") for e in ends[1:]), (value > ends[0]).cast("int"))


def _bins() -> Column:
    """One number per feature, distinct between features, from columns of their values."""
    numbers, base = [], 0
    for name, ends in BINS.items():
        numbers.append((_over(F.col(name), ends) + base).cast("int"))
        base += len(ends) + 1
    return F.array(*numbers)


def _strength(rate: float, spread: float | None) -> float | None:
    """Pseudo-counts of a beta prior with this mean and the observed variance of the rates.

    None where they do not vary: the prior is certain then.
    """
    if not spread or spread <= 0 or not 0 < rate < 1:
        return None
    return max(LEAST_STRENGTH, rate * (1 - rate) / spread - 1)


def _spread(sites: DataFrame, toward: Column) -> float | None:
    """The strength of the prior that sites (good, n) have toward a rate, from one scan of them."""
    raw = F.col("good") / F.col("n")
    seen = sites.where(F.col("n") >= LEAST_DOCUMENTS).agg(
        F.avg(raw).alias("mean"), F.var_samp(raw - toward).alias("spread"), F.avg(raw * (1 - raw) / F.col("n")).alias("noise")
    ).first()
    if seen["mean"] is None:
        return None
    return _strength(seen["mean"], (seen["spread"] or 0.0) - (seen["noise"] or 0.0))


def _shrunk(good: Column, n: Column, toward: Column, strength: float | None) -> Column:
    return toward if strength is None else (good + strength * toward) / (n + strength)


def score(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str,
    path_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """The id, held_out, evidence, host_rate, path_rate, score and predicted for each row.

    Labels count only where crc32 of the id modulo 5 is not 0; others are held out.
    evidence is the text's log-odds, score the probability of quality 1, predicted 1 from
    0.5 on. host_rate and path_rate are those of the site's other documents. Null hosts and
    paths are sites of their own; a null text is empty. Without labels of both classes the
    evidence is 0. Repeated rows each count for their site; an empty table gives an empty
    table. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    site = lambda c: F.struct(F.col(c).isNull().alias("none"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("name"))
    # The features are columns, so that each is computed once for all its bins.
    key = row_key(id_col, F.struct(id_col, text_col, host_col, path_col)).alias("key")
    held = docs.select(key, site(host_col).alias("host"), site(path_col).alias("path"), *[v.alias(n) for n, v in features(text).items()])
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out_of(F.col(id_col)))
    usable = usable.groupBy(F.col(id_col).cast("long").alias("key")).agg(F.max(label_col).cast("int").alias("good"))
    held = staged(held.select("key", "host", "path", _bins().alias("bins")).join(usable, "key", "left"), "features")

    known = held.where("good IS NOT NULL")
    per_bin = known.select("good", F.explode("bins").alias("bin")).groupBy("bin").agg(
        F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")
    )
    counts = {r["bin"]: (r["good"], r["bad"]) for r in per_bin.collect()}  # one row per bin
    total = [sum(c[k] for c in counts.values()) / len(BINS) for k in (0, 1)]
    n_bins = sum(len(b) + 1 for b in BINS.values())
    both = min(total) > 0
    odds = [0.0] * n_bins
    if both:
        for b in range(n_bins):
            good, bad = counts.get(b, (0, 0))
            odds[b] = log((good + 1) / (total[0] + n_bins)) - log((bad + 1) / (total[1] + n_bins))
    prior = log(total[0] / total[1]) if both else 0.0
    table = F.array(*[F.lit(o) for o in odds])
    sum_of = F.aggregate("bins", F.lit(0.0), lambda a, b: a + F.get(table, b))
    logistic = lambda x: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), x))))
    judged = held.select("key", "host", "path", sum_of.alias("own"), "good").withColumn("p", logistic(F.col("own") + prior))
    # What a document says for its site.
    judged = judged.withColumn("says", F.coalesce(F.col("good").cast("double"), F.col("p"))).drop("good", "p")

    paths = staged(judged.groupBy("host", "path").agg(F.sum("says").alias("good"), F.count("*").alias("n")), "paths")
    hosts = staged(paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")), "hosts")
    whole = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    whole = min(1 - 1e-6, max(1e-6, whole)) if whole is not None else 0.5
    host_strength = _spread(hosts, F.lit(whole))
    hosts = hosts.select("host", F.col("good").alias("host_good"), F.col("n").alias("host_n"))
    sites = staged(paths.join(hosts, "host"), "sites")
    path_strength = _spread(sites, _shrunk(F.col("host_good"), F.col("host_n"), F.lit(whole), host_strength))

    logit = lambda x: F.log(x / (1 - x))
    others = lambda good, n, toward, strength: _shrunk(F.greatest(F.lit(0.0), F.col(good) - F.col("says")), F.col(n) - 1, toward, strength)
    made = judged.join(sites, ["host", "path"]).withColumn("host_rate", others("host_good", "host_n", F.lit(whole), host_strength))
    made = made.withColumn("path_rate", others("good", "n", F.col("host_rate"), path_strength))
    inside = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col("path_rate")))
    made = made.withColumn("score", logistic(F.col("own") + prior + logit(inside) - logit(F.lit(whole))))
    id_ = id_of(F.col("key"))
    return made.select(
        id_.alias(id_col),
        held_out_of(id_).alias("held_out"),
        F.col("own").alias("evidence"),
        "host_rate",
        "path_rate",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
