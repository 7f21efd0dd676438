"""Connected components of a table of links.

Each round points every node at the smallest node it sees, first from the side of its
larger neighbours, then of its smaller ones, until all links point at roots. Rounds are
written to the shared folder, and so are the nodes' smallest neighbours, an aggregate that
is reduced before its shuffle. A hot node's links then meet its one row in a join of two
written tables: Spark broadcasts the nodes where they are few, and else splits the
partition of a hot node, which it does not do next to an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legalops.llm.common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) for each node with a link.

    `links` has columns hi and lo of one orderable type, in any order; loops and
    repeated links do no harm. No links, no rows.
    """
    hi, lo = F.greatest("hi", "lo"), F.least("hi", "lo")
    now = staged(links.where("hi <> lo").select(hi.alias("hi"), lo.alias("lo")).distinct(), "links")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        up = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        up = staged(up.distinct(), "up")
        root = staged(up.groupBy("hi").agg(F.min("lo").alias("m")), "root")
        down = up.join(root, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = staged(down.union(root.select("hi", F.col("m").alias("lo"))).distinct(), "links")
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.union(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _fingerprint(links: DataFrame) -> tuple:
    digest = F.xxhash64("hi", "lo")
    return tuple(links.agg(F.count("*"), F.bit_xor(digest), F.sum(digest % 1_000_003)).first())
