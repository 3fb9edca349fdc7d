"""Connected components of a link table, without gathering links anywhere.

Alternating large-star and small-star rounds: in a large-star every node hands its larger neighbours to the smallest one
it knows, in a small-star the smaller ones.  The number of links never grows, rounds are logarithmic in practice, and a
round is only partial aggregations and equi-joins, which adaptive execution splits where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _stamp(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: same ordered type, no nulls, u <> v); root is the smallest node."""
    now = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _stamp(now)
    while seen[0]:
        now = cut(_small_star(_large_star(now)))
        was, seen = seen, _stamp(now)
        if was == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
