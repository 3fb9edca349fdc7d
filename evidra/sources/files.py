"""Labelled examples, reviewed CSV files, training results, logs, snapshots."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import versions
from . import splits


def examples(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of ``{"examples": [...]}`` files; ``schema``: that of one example."""
    return spark.read.schema(f"examples array<struct<{schema}>>").json(path, multiLine=True).select(F.explode("examples").alias("e")).select("e.*")


def reviewed(spark: SparkSession, path: str) -> DataFrame:
    """Reviewed rows (chunk_text, claims array, maintainer) with neither an empty chunk nor empty claims."""
    rows = splits.csv(spark, path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    given = rows.where((X.trimmed(F.col("chunk_text")) != "") & (X.trimmed(F.col("Claims")) != ""))
    return given.select("chunk_text", X.claims_cell(F.col("Claims")).alias("claims"), F.col("Maintainer").alias("maintainer"))


def csv_profile(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows, ragged rows and non-empty values per column."""
    rows = splits.csv(spark, path, columns, "_corrupt")
    return rows.agg(F.count("*").alias("n_rows"), F.count("_corrupt").alias("n_ragged"), *[F.count_if(X.trimmed(F.col(c)) != "").alias(f"n_{c}") for c in columns])


def _by_metric(metric: str):
    """What a result is ranked by: the optimized value of the metric, else how much it improved, else the optimized score; 0 without any.

    An improvement that is a plain number counts for the metrics "score" and "improvement" only.
    """

    def value(path: str):
        return F.try_variant_get("j", path, "double")

    plain = [value("$.improvement")] if metric in ("score", "improvement") else []
    return F.coalesce(value(f"$.optimized.{metric}"), value(f"$.improvement.{metric}"), *plain, value("$.optimized.score"), value("$.optimized"), F.lit(0.0))


def results(spark: SparkSession, *paths: str, most: int = 50, metric: str = "score") -> DataFrame:
    """Training results, newest first; scores may be numbers or objects with ``score``; unreadable files are left out.

    ``sort_key`` is what ``leaderboard`` ranks by.
    """
    if not metric.isidentifier():
        raise ValueError(f"{metric!r} is no name of a metric")
    raw = spark.read.text(list(paths), wholetext=True).select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("j")).where("j is not null")

    def number(name: str):
        return F.coalesce(F.try_variant_get("j", f"$.{name}", "double"), F.try_variant_get("j", f"$.{name}.score", "double"), F.try_variant_get("j", f"$.{name}.accuracy", "double"))

    rows = raw.select("file", F.try_variant_get("j", "$.model_name", "string").alias("model_name"), F.try_variant_get("j", "$.timestamp", "string").alias("timestamp"), number("baseline").alias("baseline"), number("optimized").alias("optimized"), number("improvement").alias("improvement"), _by_metric(metric).alias("sort_key"))
    return rows.orderBy(F.col("timestamp").desc_nulls_last(), "file").limit(most)


def leaderboard(found: DataFrame, since: str | None = None, most: int = 20) -> DataFrame:
    """Results ranked by their ``sort_key``."""
    rows = found.where(F.to_timestamp("timestamp") >= F.to_timestamp(F.lit(since))) if since else found
    top = rows.orderBy(F.col("sort_key").desc_nulls_last(), "file").limit(most)
    from pyspark.sql.window import Window

    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("sort_key").desc_nulls_last(), "file")))


def log_blocks(spark: SparkSession, path: str, start: str, end: str, most: int = 3) -> DataFrame:
    """The first blocks between two markers of each log file."""
    return splits.blocks(spark, path, start, end, most)


def write_result(spark: SparkSession, result: dict, path: str) -> None:
    """One training result as a JSON file in the folder ``path``."""
    spark.createDataFrame([(json.dumps(result),)], "value string").coalesce(1).write.mode("append").text(path)


def snapshot(df: DataFrame, path: str) -> int:
    """Writes a new version beside the older ones, and gives its number."""
    return versions.write({"snapshot": df}, path)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version."""
    return versions.read(spark, path, "snapshot")
