"""Personal data by weak supervision, with built-in functions only.

Base spans are those the plain patterns find and their checks accept; they always stay.
Looser patterns propose more. On every span three labelers vote yes, no or nothing: the
strict pattern, a gazetteer (top-level domains, card issuers, number plans, reserved
address blocks) and the words before it. Expectation-maximisation over the counts of
vote patterns estimates how reliable each labeler is, per kind; its posteriors are the
soft labels of a naive Bayes classifier over votes, shape and the hashed word before,
and the classifier decides on the proposed spans.

Texts are read once, for the spans, which are staged. Both models are fitted on one
grouped count whose size is fixed by the numbers of kinds, votes, shapes and hash values.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import staged

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the base patterns: what each part may not contain follows it, so
# they match the same texts, and the guard in front only skips starts inside a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What else may be meant for the same.
LOOSE = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]++(?:[\x20]?[(\[{]at[)\]}][\x20]?[A-Z0-9-]++"
    r"(?:[\x20]?(?:[(\[{]dot[)\]}]|\.)[\x20]?[A-Z0-9-]++)++|\x20at\x20[A-Z0-9-]++(?:\x20dot\x20[A-Z0-9-]++)++)",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![0-9-])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# A cheap test that a text may hold the kind.
MAYBE_BASE = {"email": "@", "ip": "[0-9][.]", "card": "[0-9]", "phone": r"\+[0-9]"}
MAYBE_LOOSE = {"email": r"(?i)[(\[{\x20]at[)\]}\x20]", "ip": "[0-9A-Fa-f]:[0-9A-Fa-f]", "card": "[0-9]{4}", "phone": "[0-9]{3}"}

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
STRICT = {
    # Possessive too: a group that may give back would cost the Java stack one frame for each label.
    "email": r"^(?!.*(?:[@.]-|-\.))[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}$",
    "ip": rf"^(?:{OCTET}\.){{3}}{OCTET}$|^(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}$",
    "card": r"^[0-9]{4}(?:[\x20-]?[0-9]{4}){3}$|^3[0-9]{3}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}$",
    "phone": r"^\+?[0-9]{0,3}[\x20.-]?\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$",
}
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at)$",
    "ip": r"^(?!0+\.|127\.|169\.254\.|22[4-9]\.|2[3-5][0-9]\.)[0-9A-Fa-f]",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^(?:\+(?:1|33|34|39|4[0-9])\b|\(?[2-9])",
}
BEFORE_YES = {
    "email": r"(?i)mail|contact|write|reach",
    "ip": r"(?i)\bip\b|host|server|addr|login|ping",
    "card": r"(?i)card|visa|credit|debit|pay",
    "phone": r"(?i)tel|phone|call|fax|mobil|contact",
}
BEFORE_NO = r"(?i)version|isbn|order|invoice|item|page|token|hash|build|serial"

YES, NO, NONE = 1, 2, 0
VOTES = 3
WORDS, SHAPES = 64, 8
CONTEXT_CHARS = 32
# Values added up at a time.
SCANNED = 256


def _found(text: Column, pattern: str, maybe: str) -> Column:
    """Spans of all matches, leftmost and not overlapping, as structs of s, e, t and before.

    What lies between the matches and the matches themselves, laid end to end, give the
    code points at which each begins. `before` is the end of what lies between a match
    and the start of the match before it: reading it from the whole text by its place
    would cost a walk through the text for each match.
    """
    none = F.array().cast("array<struct<s:int,e:int,t:string,before:string>>")
    laid = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(gap.alias("gap"), match.alias("t")),
    )

    def placed(laid: Column) -> Column:
        sizes = F.transform(laid, lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["t"]), F.lit(0)))
        said = F.transform(laid, lambda x, k: F.concat(F.coalesce(F.get(laid, k - 1)["t"], F.lit("")), x["gap"]))
        spans = F.zip_with(
            F.zip_with(laid, said, lambda x, said: F.struct(x.alias("x"), F.right(said, F.lit(CONTEXT_CHARS)).alias("before"))),
            _before(sizes, lambda a, b: a + b),
            lambda y, at: F.struct(
                (at + F.length(y["x"]["gap"])).alias("s"),
                (at + F.length(y["x"]["gap"]) + F.length(y["x"]["t"])).alias("e"),
                y["x"]["t"].alias("t"),
                y["before"].alias("before"),
            ),
        )
        return F.filter(spans, lambda x: x["t"].isNotNull())

    return F.when(text.rlike(maybe), _with(laid, placed)).otherwise(none)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often `use` names it."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each whole number of an array what those before it come to, 0 for the first.

    An array that grows inside `aggregate` is copied at every step, so it is grown in
    blocks of SCANNED values, and what the blocks come to is carried on.
    """
    state = lambda at, out: F.struct(at.alias("at"), out.alias("out"))
    zero = state(F.lit(0), F.array().cast("array<int>"))

    def run(items: Column, value: Callable[[Column], Column]) -> Column:
        step = lambda done, x: state(combine(done["at"], value(x)), F.concat(done["out"], F.array(done["at"])))
        return F.aggregate(items, zero, step)

    def joined(blocks: Column) -> Column:
        carried = run(blocks, lambda block: block["at"])["out"]
        moved = F.zip_with(blocks, carried, lambda block, at: F.transform(block["out"], lambda x: combine(x, at)))
        return F.flatten(moved)

    def scanned(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / SCANNED).cast("int")
        firsts = F.when(F.size(values) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return _with(F.transform(firsts, lambda k: run(F.slice(values, k * SCANNED + 1, SCANNED), lambda x: x)), joined)

    return _with(values, scanned)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weighed(digit: Column, k: Column) -> Column:
        doubled = digit.cast("int") * 2
        return F.when(k % 2 == 0, digit.cast("int")).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    each = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), weighed)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$")
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _voted(span: Column, kind: str, base: bool) -> Column:
    before = span["before"]
    said = F.when(before.rlike(BEFORE_YES[kind]), YES).when(before.rlike(BEFORE_NO), NO).otherwise(NONE)
    vote = lambda yes: F.when(yes, YES).otherwise(NO)
    words = F.lower(F.regexp_extract(before, r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        span["s"].alias("s"),
        span["e"].alias("e"),
        F.lit(base).alias("base"),
        vote(span["t"].rlike(STRICT[kind])).alias("strict"),
        vote(span["t"].rlike(GAZETTEER[kind])).alias("known"),
        said.alias("said"),
        F.pmod(F.xxhash64(words), F.lit(WORDS)).cast("int").alias("word"),
        F.least(F.floor((span["e"] - span["s"]) / 4), F.lit(SHAPES - 1)).cast("int").alias("shape"),
    )


def _spans(text: Column) -> Column:
    """All base and proposed spans of a text with the votes on them."""
    return F.concat(*[F.concat(*_spans_of(kind, text)) for kind in KINDS])


def _spans_of(kind: str, text: Column) -> list[Column]:
    base = F.filter(_found(text, BASE[kind], MAYBE_BASE[kind]), lambda x: _passes(kind, x["t"]))
    loose = _found(text, LOOSE[kind], MAYBE_LOOSE[kind])
    return [
        F.transform(base, lambda x: _voted(x, kind, True)),
        F.transform(loose, lambda x: _voted(x, kind, False)),
    ]


def fit_votes(counts: dict[tuple, float], rounds: int = 25) -> dict[tuple, float]:
    """How likely a span of (kind, votes) is personal data, by expectation-maximisation.

    Each labeler has, for each kind, a chance of each vote on true and on false spans.
    Votes start from the majority, and every chance from one pseudo-count.
    """
    belief = {}
    for kind, *votes in counts:
        yes, no = votes.count(YES), votes.count(NO)
        belief[kind, *votes] = (yes + 1) / (yes + no + 2)
    for _ in range(rounds):
        seen: dict = defaultdict(lambda: 1.0)
        total: dict = defaultdict(lambda: 3.0)
        for (kind, *votes), n in counts.items():
            for truth, p in ((1, belief[kind, *votes]), (0, 1 - belief[kind, *votes])):
                for labeler, vote in enumerate(votes):
                    seen[kind, truth, labeler, vote] += n * p
                total[kind, truth] += n * p
        for kind, *votes in counts:
            odds = math.log(total[kind, 1] / total[kind, 0])
            for labeler, vote in enumerate(votes):
                if vote != NONE:
                    odds += math.log(seen[kind, 1, labeler, vote] / total[kind, 1])
                    odds -= math.log(seen[kind, 0, labeler, vote] / total[kind, 0])
            belief[kind, *votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def fit_classifier(rows: list, belief: dict[tuple, float]) -> list[float]:
    """Log-odds of naive Bayes: for each kind the prior, then votes, words and shapes."""
    width = 1 + VOTES**3 + WORDS + SHAPES
    true, false = [0.0] * (width * len(KINDS)), [0.0] * (width * len(KINDS))
    for r in rows:
        p = belief[r.kind, r.strict, r.known, r.said]
        at = r.kind * width
        votes = (r.strict * VOTES + r.known) * VOTES + r.said
        for f in (at, at + 1 + votes, at + 1 + VOTES**3 + r.word, at + 1 + VOTES**3 + WORDS + r.shape):
            true[f] += r.n * p
            false[f] += r.n * (1 - p)
    weights = []
    for kind in range(len(KINDS)):
        at = kind * width
        t, f = true[at] + 1, false[at] + 1
        weights.append(math.log(t / f))
        weights += [math.log((true[k] + 1) / (t + 1)) - math.log((false[k] + 1) / (f + 1)) for k in range(at + 1, at + width)]
    return weights


def _accepted(x: Column, weights: list[float]) -> Column:
    width = 1 + VOTES**3 + WORDS + SHAPES
    table = F.array(*[F.lit(w) for w in weights])
    at = x["kind"] * width
    votes = (x["strict"] * VOTES + x["known"]) * VOTES + x["said"]
    features = (at, at + 1 + votes, at + 1 + VOTES**3 + x["word"], at + 1 + VOTES**3 + WORDS + x["shape"])
    odds = sum((F.get(table, f) for f in features[1:]), F.get(table, features[0]))
    return odds >= 0


def _apart(found: Column, kind: int) -> Column:
    """The proposed spans of a kind that overlap no base span of it.

    Base spans do not overlap each other, nor do proposed ones. In the order of their
    starts, a proposed span can meet only what the base spans before it reach, or the base
    span that comes next.
    """

    def alone(spans: Column) -> Column:
        ends = F.transform(spans, lambda x: F.when(x["base"], x["e"]).otherwise(0))
        kept = F.zip_with(
            F.transform(spans, lambda x, k: F.struct(x.alias("x"), F.get(spans, k + 1).alias("next"))),
            _before(ends, lambda a, b: F.greatest(a, b)),
            lambda at, reached: F.struct(
                at["x"].alias("x"),
                (~at["x"]["base"] & (reached <= at["x"]["s"]) & ~F.coalesce(at["next"]["base"] & (at["next"]["s"] < at["x"]["e"]), F.lit(False))).alias("alone"),
            ),
        )
        return F.transform(F.filter(kept, lambda at: at["alone"]), lambda at: at["x"])

    own = F.filter(found, lambda x: x["kind"] == kind)
    # Structs sort by kind, start and end; of equal stretches the base span must come first.
    by_start = F.transform(own, lambda x: F.struct(x["s"].alias("s"), (~x["base"]).alias("late"), x.alias("x")))
    ordered = F.transform(F.array_sort(by_start), lambda y: y["x"])
    proposed = F.exists(found, lambda x: (x["kind"] == kind) & ~x["base"])
    return F.when(proposed, _with(ordered, alone)).otherwise(F.filter(found, lambda x: F.lit(False)))


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, `base` and `spans` for each row: arrays of kind, s and e, in that order.

    kind is a place in KINDS; s and e are code points, e exclusive. base holds what the
    base patterns find and their checks accept, spans that and what the classifier
    accepts beside it: proposed spans that overlap no base span of their kind. A null
    text is empty and has no spans; repeated rows are repeated; where the table has no
    span at all nothing is fitted. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = staged(df.select(F.col(id_col).alias("id"), _spans(text).alias("found")), "spans")

    votes = held.select(F.explode("found").alias("x")).select("x.*")
    rows = votes.groupBy("kind", "strict", "known", "said", "word", "shape").agg(F.count("*").alias("n")).collect()
    counts: dict = defaultdict(float)
    for r in rows:  # at most 4 kinds * 27 votes * 64 words * 8 shapes
        counts[r.kind, r.strict, r.known, r.said] += r.n
    weights = fit_classifier(rows, fit_votes(counts))

    found = F.col("found")
    base = F.filter(found, lambda x: x["base"])
    more = F.concat(*[F.filter(_apart(found, kind), lambda x: _accepted(x, weights)) for kind in range(len(KINDS))])
    plain = lambda spans: F.array_sort(
        F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    )
    return held.select(F.col("id").alias(id_col), plain(base).alias("base"), plain(F.concat(base, more)).alias("spans"))


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def personal_data_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As `find_personal_data`, as counts of base spans, their hash and all spans as text."""
    found = find_personal_data(df, id_col, text_col)
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        id_col,
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
