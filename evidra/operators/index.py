"""A search index of vectors that stays: lists of vectors around pivots, in folders of their own, in numbered versions.

``build`` chooses the pivots and writes the rows into the list (a folder) of their nearest one; ``append`` adds rows to the
lists of the same pivots without touching what is there.  ``search`` reads the pivots and a summary of the lists, decides which lists
its queries visit, and reads the files of these only.  Scores are exact, and with ``probes`` None so is the result: lists
are left out only if no vector of theirs can be among the best.  With ``probes``, that many nearest lists are read.

Pivots and summaries (a row per pivot and batch) are bounded by ``metric.PIVOTS`` and pass through the driver; rows and
queries do not.  An index that has grown far beyond its pivots is built anew from its own rows (``rebuild``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import metric as D
from . import versions
from .similarity import _few


def _rows(df: DataFrame, key: str, vector: str, unit: bool, pivots) -> DataFrame:
    """Placed rows: id, v, cell, r, and what else the caller has (``data``)."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (key, vector)]
    data = F.struct(*rest) if rest else F.lit(None).cast("struct<none:int>")
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.lit(0).cast("long").alias("g"), F.col(vector).cast("array<double>").alias("v"), data.alias("data"))
    return D.placed(rows, pivots, unit).repartition("cell")


def _summary(written: dict[str, DataFrame]) -> DataFrame:
    """Of the lists as they were written, two columns of which are read."""
    return D.summary(written["lists"]).coalesce(1)


def build(df: DataFrame, path: str, key: str, vector: str, unit: bool = True) -> int:
    """An index of ``df`` (``key`` long, ``vector``, further columns) at ``path``; ``unit``: of directions, else of points."""
    spark = df.sparkSession
    pivots = D.pivots_of(D.shaped(df, key, vector), unit)
    rows = _rows(df, key, vector, unit, pivots)
    told = spark.createDataFrame([(k, p.tolist(), unit) for k, p in enumerate(pivots)], "n int, pivot array<double>, unit boolean")
    return versions.write({"pivots": told.coalesce(1), "lists": rows, "cells": _summary}, path, folders={"lists": ["cell"]})


def _pivots(spark: SparkSession, path: str):
    import numpy as np

    rows = versions.read(spark, path, "pivots").orderBy("n").collect()
    if not rows:
        raise ValueError(f"the index at {path} was built without vectors; build it again")
    return np.array([r.pivot for r in rows]), rows[0].unit


def append(df: DataFrame, path: str, key: str, vector: str) -> int:
    """More rows in the lists of the pivots that there are; no file of the index is rewritten."""
    pivots, unit = _pivots(df.sparkSession, path)
    return versions.append({"lists": _rows(df, key, vector, unit, pivots), "cells": _summary}, path)


def rows_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """All rows of an index: id, v and the further columns."""
    lists = versions.read(spark, path, "lists", version)
    return lists.select("id", "v", "data.*")


def rebuild(spark: SparkSession, path: str) -> int:
    """The same rows around as many pivots as they need now."""
    _, unit = _pivots(spark, path)
    return build(rows_of(spark, path), path, "id", "v", unit)


def statistics(spark: SparkSession, path: str) -> DataFrame:
    """n_rows, n_lists, and the rows of the largest list."""
    per = versions.read(spark, path, "cells").groupBy("cell").agg(F.sum("n").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_lists"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def search(spark: SparkSession, path: str, queries: DataFrame, key: str, vector: str, k: int = 10, probes: int | None = None, data: bool = True) -> DataFrame:
    """(query_id, rank, vec_id, score and, with ``data``, the further columns): the ``k`` best rows of each query, ties to the smaller id.

    The score is the cosine (0 to 1) in an index of directions, else the distance.
    """
    pivots, unit = _pivots(spark, path)
    version = versions.newest(spark, path)
    cells = D.cells_from(pivots, versions.read(spark, path, "cells", version).groupBy("cell").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect())
    lists = versions.read(spark, path, "lists", version)

    def read(visiting: DataFrame) -> DataFrame:
        wanted = [r.to for r in visiting.select("to").distinct().collect()]  # numbers of lists
        return lists.where(F.col("cell").isin(wanted)).select("id", "g", "v", "cell", "r")

    found = D.search(D.shaped(queries, key, vector), read, cells, k, unit, False, False, None, probes)
    if not data:
        return found
    found = D._settled(found)
    some = found.select(F.col("vec_id").alias("id")).distinct()
    return found.join(lists.select("id", "data").join(_few(some), "id", "left_semi").withColumnRenamed("id", "vec_id"), "vec_id").select("query_id", "rank", "vec_id", "score", "data.*")
