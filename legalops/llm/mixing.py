"""Mixing sources to target weights by Sainte-Laguë apportionment.

The words of the mix are counted in blocks of equal size. Sources get blocks by the
highest quotients of their targets (target / 1, / 3, / 5, ...), and so do the shards of a
source by their sizes. A shard's documents form one stream in a seeded order, which is
cut into blocks; the shard's quota takes blocks from the front, again from the start if
it is larger than the shard. Shards have about SHARD_WORDS words, so a hot source is
many shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legalops.llm.common import WORD, staged

BLOCK_WORDS = 32
SHARD_WORDS = 1_000_000
MOST_REPEATS = 3


def sainte_lague(df: DataFrame, within: list[str], order: list[str], votes: str, seats: str) -> DataFrame:
    """Add `quota`: how many of `seats` each row gets, among the rows that agree on `within`.

    The highest quotients votes / (2k - 1) win; ties go by `order`, which names a row.
    Rounding votes at the mean divisor comes within one seat per row of the right number,
    so only quotients near it are ranked, not one for each seat.
    """
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    total = F.sum(votes).over(group)
    df = df.withColumn("_share", F.when(total > 0, F.col(votes) / total).otherwise(0.0))
    df = df.withColumn("_near", F.floor(F.col("_share") * F.col(seats) + 0.5))
    df = df.withColumn("_short", F.col(seats) - F.sum("_near").over(group))
    df = df.withColumn("_short", F.when(total > 0, F.col("_short")).otherwise(0))
    tries = F.ceil(F.col("_share") * (F.abs("_short") + F.count("*").over(group))) + 2
    df = df.withColumn("_tries", F.when(F.col("_short") != 0, tries).otherwise(0))

    tried = df.where("_tries > 0").select(*within, *order, votes, "_near", "_short", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_tries"))).alias("_k"))
    seat = F.when(F.col("_short") > 0, F.col("_near") + F.col("_k")).otherwise(F.col("_near") - F.col("_k") + 1)
    tried = tried.withColumn("_seat", seat).where("_seat >= 1")
    quotient = F.col(votes) / (2 * F.col("_seat") - 1)
    # To add: the highest first. To take away: the lowest first.
    ranked = group.orderBy(F.when(F.col("_short") > 0, -quotient).otherwise(quotient), *order, "_seat")
    moved = tried.withColumn("_rank", F.row_number().over(ranked)).where("_rank <= abs(_short)")
    moved = moved.groupBy(*within, *order).agg(F.sum(F.signum("_short").cast("long")).alias("_moved"))
    keys = [*within, *order]
    return (
        df.join(moved, keys, "left")
        .withColumn("quota", (F.col("_near") + F.coalesce("_moved", F.lit(0))).cast("long"))
        .drop("_share", "_near", "_short", "_tries", "_moved")
    )


def source_targets(sizes: DataFrame) -> DataFrame:
    """_source_key, _source_size, _target: what each source should give, in words.

    Sources in the order of code points, null last, weigh 1, 2, 3, repeating. A source gives
    at most MOST_REPEATS times its size; what is over goes to the others by weight. Filling
    sources in the order of size by weight, the level of the others rises until it is right
    and falls after that, so the right level is the highest.
    """
    sources = sizes.groupBy("_source_key").agg(F.sum("_size").alias("_source_size"))
    everything = Window.partitionBy(F.lit(0))  # one row per source
    weight = (F.row_number().over(everything.orderBy("_source_key")) - 1) % 3 + 1
    sources = sources.withColumn("_weight", weight)
    cap = MOST_REPEATS * F.col("_source_size")
    before = everything.orderBy(cap / F.col("_weight"), "_source_key").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("_source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    sources = sources.withColumn("_level", left / weights)
    level = F.max("_level").over(everything)
    target = F.least(cap.cast("double"), level * F.col("_weight"))
    return sources.select("_source_key", "_source_size", target.alias("_target"))


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = F.col(source_col).cast("string")
    return df.select(
        "*",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.struct(source.isNull().alias("none"), F.coalesce(source, F.lit("")).alias("name")).alias("_source_key"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("_order"),
    )


def _placed(sized: DataFrame, id_col: str) -> DataFrame:
    """Each row with its source's size and target, and its place in its shard's stream."""
    targets = source_targets(sized)
    everything = Window.partitionBy(F.lit(0))
    blocks = F.round(F.sum("_target").over(everything) / BLOCK_WORDS).cast("long")
    sources = sainte_lague(targets.withColumn("_blocks", blocks), [], ["_source_key"], "_target", "_blocks")
    shards_of = F.greatest(F.lit(1), F.ceil(F.col("_source_size") / SHARD_WORDS))
    sources = staged(sources.select("_source_key", "_source_size", "_target", F.col("quota").alias("_blocks"), shards_of.alias("_shards")), "sources")

    rows = sized.join(sources, "_source_key").withColumn("_shard", F.pmod("_order", "_shards"))
    shards = rows.groupBy("_source_key", "_shard").agg(F.sum("_size").alias("_shard_size"), F.max("_blocks").alias("_blocks"))
    shards = sainte_lague(shards, ["_source_key"], ["_shard"], "_shard_size", "_blocks")
    words = F.least(F.col("quota") * BLOCK_WORDS, MOST_REPEATS * F.col("_shard_size"))
    shards = staged(shards.select("_source_key", "_shard", "_shard_size", words.alias("_words")), "shards")

    stream = Window.partitionBy("_source_key", "_shard").orderBy("_order", id_col, "_size")
    rows = rows.join(shards, ["_source_key", "_shard"])
    rows = rows.withColumn("_before", F.sum("_size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    rounds = F.when(F.col("_shard_size") > 0, F.floor(F.col("_words") / F.col("_shard_size"))).otherwise(0)
    rows = rows.withColumn("_rounds", rounds.cast("long"))
    return rows.withColumn("_rest", F.col("_words") - F.col("_rounds") * F.col("_shard_size"))


def mix_words(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7
) -> DataFrame:
    """One row per row of df: the id, size, source_size, target and taken.

    size counts the words of the text (null: 0). target is the source's, in words; taken
    is what the mix takes of the row, repeats counted, at most three times its size. The
    last block of a shard may end inside a document. Rows without a source form one
    source, the last; a source without words has target 0. Repeated rows each count. The
    choice depends on the seed, the ids and the texts only. An empty table gives an empty
    table; other columns are not read.
    """
    sized = _sized(df.select(id_col, text_col, source_col), id_col, text_col, source_col, seed)
    sized = staged(sized.drop(text_col, source_col), "sizes")
    rest = F.greatest(F.lit(0), F.least(F.col("_rest") - F.col("_before"), F.col("_size")))
    return _placed(sized, id_col).select(
        id_col,
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_rounds") * F.col("_size") + rest).cast("long").alias("taken"),
    )


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7
) -> DataFrame:
    """The mix itself: rows of df, as often as they are taken, whole, with all their columns.

    As `mix_words`, but a document in which a shard's last block begins or ends is taken
    whole, so a source may get that much more than its target. Documents without words
    are taken once for each full round and where they lie before the last block's end.
    """
    sized = _sized(df, id_col, text_col, source_col, seed)
    copies: Column = F.col("_rounds") + (F.col("_before") < F.col("_rest")).cast("long")
    placed = _placed(sized, id_col).withColumn("_copies", copies)
    taken = placed.where("_copies > 0").select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    return taken.drop("_copy")
