"""Classification metrics as conditional counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import hashed_rank


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Cells, accuracy, precision, recall and the two error rates; zeros where there is nothing to divide by."""
    cells = df.agg(
        F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.select(
        "tp", "fp", "fn", "tn",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(fp, fp + tn).alias("false_positive_rate"), _ratio(fn, fn + tp).alias("false_negative_rate"),
    )


def entailment(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Accuracy over four relations; precision and recall of SUPPORTS; SUPPORTS said of what is only RELATED."""
    said, true = predicted == "SUPPORTS", actual == "SUPPORTS"
    cells = df.agg(
        F.count("*").alias("n"), F.count_if(predicted == actual).alias("right"), F.count_if(said & true).alias("tp"), F.count_if(said).alias("said"),
        F.count_if(true).alias("true"), F.count_if(said & (actual == "RELATED")).alias("wrong"), F.count_if(actual == "RELATED").alias("related"),
    )
    return cells.select(
        "n", _ratio(F.col("right"), F.col("n")).alias("accuracy"), _ratio(F.col("tp"), F.col("said")).alias("supports_precision"),
        _ratio(F.col("tp"), F.col("true")).alias("supports_recall"), _ratio(F.col("wrong"), F.col("related")).alias("false_positive_rate"),
    )


def penalty(predicted: Column, actual: Column) -> Column:
    """1 for a right relation, -2 for SUPPORTS said of RELATED, else 0."""
    return F.when(predicted == actual, 1).when((predicted == "SUPPORTS") & (actual == "RELATED"), -2).otherwise(0)


def split(df: DataFrame, key: str, seed: str, share: float = 0.7) -> DataFrame:
    """``part`` train or val: the first ``floor(share * n)`` rows in an order hashed from seed and key are train."""
    limit = F.floor(F.lit(share) * df.agg(F.count("*")).scalar())
    ranked = hashed_rank(df, F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), [key], "__rank")
    return ranked.withColumn("part", F.when(F.col("__rank") <= limit, "train").otherwise("val")).drop("__rank")
