"""URL filters: rules by host and path, and a logistic regression for the rest.

The regression's features are hashed character n-grams of host and path, taken by a
regular expression that looks ahead from every place, and hashed apart for the two parts.
It is fitted on a small table of labelled URLs: the features are made by the same
expressions, at most LABELLED_ROWS rows reach the driver, and stochastic gradient steps
in a fixed order give one weight per bucket. The weights go back into the plan as one
constant array, so that judging URLs is a projection without any shuffle.

Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SIZES = (3, 4, 5)
BUCKETS = 8192
# Labelled rows the model is fitted on at most, by hash of the URL.
LABELLED_ROWS = 2000
ROUNDS, RATE, RIDGE = 40, 1.0, 1e-4
# How much a URL to block counts beside one to allow, of which labelled tables have more.
BLOCK_WEIGHT = 4.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The labelled table that is taken where none is given: names put together from words.
BLOCKED_WORDS = (
    "casino bets poker slots jackpot lottery roulette pills pharma viagra meds cheap free win prize bonus ads adserver "
    "track tracker click banner popup spam farm seo-links linkfarm porn xxx adult cams escort torrent warez crack keygen "
    "replica payday loans malware phish"
)
ALLOWED_WORDS = (
    "library university museum weather school history science garden travel kitchen recipes journal archive research "
    "council health hospital football music theatre books writers gallery insurance court police station railway "
    "airline hotel market furniture tools software docs developer forum encyclopedia photos maps nature birds ocean "
    "climate energy solar nation education thesis other where there another interest general mother father tradition"
)
# Common English syllables: names that are no words are made of these, and most are harmless.
SYLLABLES = "the in er an re on at en nd ti es or te of ed is it al ar st to nt ha se ou le th ing tion".split()
SITES = ("", "www.", "m.", "blog.")
ENDINGS = ("example.com", "example.org", "example.net")
PATHS = ("/", "/en/{n}", "/fr/{n}.html", "/de/{n}/", "/es/{n}?page=2", "/index.html", "/en/{n}#top", "/about/{n}")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url and label (1 for one to block).

    A name is a word, or two of its list; harmless ones are also put together from
    syllables, so that a name like no word is rather let through. Both lists get the same sites, endings and 40
    paths in turn, so that these tell little.
    """
    rows = []
    for label, words in ((1, BLOCKED_WORDS.split()), (0, ALLOWED_WORDS.split())):
        n = len(words)
        pairs = [(w, words[(7 * k + 3) % n], "-") for k, w in enumerate(words)]
        names = words + [a + s + b for a, b, s in pairs if a != b] + [a + words[(11 * k + 5) % n] for k, a in enumerate(words)]
        if not label:
            m = len(SYLLABLES)
            names += [a + SYLLABLES[(d * k + d) % m] + ("", SYLLABLES[(k + 4 * d) % m])[k % 2] for d in range(1, 9) for k, a in enumerate(SYLLABLES)]
        for k, name in enumerate(names):
            turn = k % 40
            path = PATHS[(turn * 5 + turn // 8) % len(PATHS)].format(n=(turn * 389 + 17) % 997)
            rows.append((f"http://{SITES[k % 4]}{name}.{ENDINGS[k % 3]}{path}", label))
    return spark.createDataFrame(rows, "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty for a URL that is null or has no ://."""
    url = F.coalesce(url, F.lit(""))
    found = F.locate("://", url)
    rest = F.when(found > 0, F.substr(url, found + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*+", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*+(/[^?#]*+)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the rules that fit, as a struct of rule and verdict; null where none does.

    A rule is a host and a path, put together, and its verdict. It fits its host and all
    hosts that end in a dot and it, where the path begins with its path. Of rules of one
    length the first in the order of code points counts. This is for a policy of some
    hundred rules: each costs a comparison for every URL.
    """
    picked = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        own = rule.split("/", 1)[0]
        at, inside = own.translate(str.maketrans(UPPER, LOWER)), rule[len(own) :]
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(inside)
        picked = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(picked)
    return picked


def _grams(part: Column, tag: str) -> Column:
    """The distinct buckets of a part's n-grams, its ends marked; none for an empty part."""
    marked = F.concat(F.lit("^"), part, F.lit("$"))
    # Looking ahead moves on by one place a match and so gives overlapping n-grams.
    found = [F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in SIZES]
    hashed = F.transform(F.concat(*found), lambda g: F.pmod(F.xxhash64(F.lit(tag), g), F.lit(BUCKETS)).cast("int"))
    return F.when(part == "", F.array().cast("array<int>")).otherwise(F.array_distinct(hashed))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> tuple[list[float], float]:
    """A weight for each bucket and the bias, from rows whose label is 0 or 1.

    Each part's features have the length 1 together. Without rows of both labels all
    weights are 0 and the bias says which label there is, allow where there is none.
    """
    host, path = host_and_path(F.col(url_col))
    usable = labelled.where(F.col(label_col).isin(0, 1) & F.col(url_col).isNotNull())
    taken = usable.select(F.col(url_col).alias("url"), F.col(label_col).cast("int").alias("label")).distinct()
    taken = taken.orderBy(F.xxhash64("url", "label"), "url", "label").limit(LABELLED_ROWS)
    host, path = host_and_path(F.col("url"))
    rows = taken.select("label", _grams(host, "host").alias("host"), _grams(path, "path").alias("path")).collect()

    n = [sum(r["label"] == k for r in rows) for k in (0, 1)]
    if not all(n):
        return [0.0] * BUCKETS, 1.0 if n[1] else -1.0
    examples = [(r["label"], [(b, len(part) ** -0.5) for part in (r["host"], r["path"]) for b in part]) for r in rows]
    weights, bias = [0.0] * BUCKETS, 0.0
    for k in range(ROUNDS):
        rate = RATE / (1 + k / 10)
        for label, features in examples:
            margin = bias + sum(weights[b] * x for b, x in features)
            step = rate * (BLOCK_WEIGHT if label else 1.0) * (label - 1 / (1 + math.exp(-max(-30.0, min(30.0, margin)))))
            bias += 0.1 * step
            for b, x in features:
                weights[b] += step * x
        weights = [w * (1 - RIDGE * rate) for w in weights]
    return [round(w, 5) for w in weights], round(bias, 5)


def block_score(host: Column, path: Column, model: tuple[list[float], float]) -> Column:
    """The chance that a URL is one to block; 0 where host and path are empty."""
    weights, bias = model
    # One constant of fixed size, which the optimizer folds into an array.
    table = F.split(F.lit(",".join(format(w, "g") for w in weights)), ",").cast("array<double>")

    def evidence(part: Column, tag: str) -> Column:
        total = lambda grams: F.aggregate(grams, F.lit(0.0), lambda a, b: a + F.get(table, b))
        return _with(_grams(part, tag), lambda grams: F.when(F.size(grams) > 0, total(grams) / F.sqrt(F.size(grams))).otherwise(0.0))

    margin = F.lit(bias) + evidence(host, "host") + evidence(path, "path")
    return F.when((host == "") & (path == ""), F.lit(0.0)).otherwise(1 / (1 + F.exp(-margin)))


def judge_urls(
    df: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    labelled: DataFrame | None = None,
    url_col: str = "url",
) -> DataFrame:
    """Add host, path, rule, verdict and block_score to every row, replacing such columns.

    verdict is allow or block: that of the longest rule that fits, else block where
    block_score is 0.5 or more. rule is null where none fits. A URL that is null or has no
    :// has an empty host and path, fits no rule with a host and is allowed. Repeated rows
    are judged alike, an empty table stays empty, and a URL may be of any length.
    `labelled` has url and label (1 for one to block); `labelled_urls` where not given.
    """
    model = fit(labelled if labelled is not None else labelled_urls(df.sparkSession))
    names = ["host", "path", "rule", "verdict", "block_score"]
    parts, held = "_parts", "_rule"
    while parts in df.columns or held in df.columns:
        parts, held = parts + "_", held + "_"
    host, path = host_and_path(F.col(url_col))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    judged = df.select("*", F.struct(host.alias("host"), path.alias("path")).alias(parts))
    host, path = F.col(parts)["host"], F.col(parts)["path"]
    judged = judged.select(*kept, parts, matching_rule(host, path, rules).alias(held), block_score(host, path, model).alias("block_score"))
    own = F.when(F.col("block_score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        *kept,
        host.alias("host"),
        path.alias("path"),
        F.col(held)["rule"].alias("rule"),
        F.coalesce(F.col(held)["verdict"], own).alias("verdict"),
        "block_score",
    )
