"""Global ranks without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hashed_rank(df: DataFrame, hashed: Column, keys: list[str], name: str) -> DataFrame:
    """``name``: the rank of each row, from 1, in the order of ``hashed`` (lower-case hex text), then ``keys``.

    Rows are ranked within the 4096 prefixes of the hash; the counts of smaller prefixes are added.  Only these counts
    pass through one task.
    """
    marked = df.withColumn("__h", hashed).withColumn("__p", F.substring("__h", 1, 3))
    counts = marked.groupBy("__p").agg(F.count("*").alias("__n"))
    before = counts.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__h", *keys))
    return marked.join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + rank).drop("__h", "__p", "__before")  # at most 4096 prefixes


#: Groups of ranges whose counts are added up in one task.
GROUPS = 4096


def ordered_rank(df: DataFrame, key: str, order: list[str], name: str, width: int = 1024) -> DataFrame:
    """``name``: the rank of each row, from 1, by the whole number ``key``, then ``order``; null keys last.

    Rows are ranked within ranges of ``width`` keys.  The counts of the ranges before are added in two levels: within one of at
    most ``GROUPS`` groups of ranges, and over these; so no task sees a row per range, however sparse the keys are.  One
    key's rows are ranked in one task.
    """
    whole = F.floor(F.col(key) / width)
    least, most = df.agg(F.min(whole), F.max(whole)).first()
    span = 1 if least is None else (most - least) // (GROUPS - 1) + 1
    marked = df.withColumn("__p", F.coalesce(whole, F.lit((1 << 63) - 1)))
    group = F.when(F.col("__p") == (1 << 63) - 1, F.lit(GROUPS)).otherwise(F.floor((F.col("__p") - F.lit(0 if least is None else least)) / span))
    counts = marked.groupBy("__p").agg(F.count("*").alias("__n")).withColumn("__g", group)
    groups = counts.groupBy("__g").agg(F.sum("__n").alias("__m"))
    ahead = groups.select("__g", (F.sum("__m").over(Window.orderBy("__g")) - F.col("__m")).alias("__ahead"))  # a row per group
    inner = F.sum("__n").over(Window.partitionBy("__g").orderBy("__p")) - F.col("__n")
    before = counts.withColumn("__inner", inner).join(F.broadcast(ahead), "__g").select("__p", (F.col("__ahead") + F.col("__inner")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__p").orderBy(F.col(key).asc_nulls_last(), *order))
    return marked.join(before, "__p").withColumn(name, F.col("__before") + rank).drop("__p", "__before")
