"""Python steps over rows that may fail: each row's result or its error, so one bad row fails itself only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of an error that are kept.
ERROR_CHARS = 500


def captured(df: DataFrame, column: str, schema: str, step: Callable) -> DataFrame:
    """``df`` with ``made``, the list of dicts (of ``schema``) that ``step`` gives for ``column``, or ``error``: its kind and text.

    Whatever the step raises is the row's error; a result that does not have the schema is one as well.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    shape = T.ArrayType(T._parse_datatype_string(schema))
    kind = to_arrow_type(shape)
    base = df.drop("made", "error")
    names = [*base.columns, "made", "error"]

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            made, errors = [], []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                try:
                    rows = list(step(value))
                    pa.array([rows], kind)
                    made.append(rows)
                    errors.append(None)
                except Exception as e:  # the row's own failure, whatever it is
                    made.append(None)
                    errors.append(f"{type(e).__name__}: {e}"[:ERROR_CHARS])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, kind), pa.array(errors, pa.string())], names=names)

    told = T.StructType([*base.schema.fields, T.StructField("made", shape), T.StructField("error", T.StringType())])
    return base.select("*", F.col(column).alias("value of the step")).mapInArrow(run, told)


def tried(df: DataFrame, key: str, column: str, schema: str, step: Callable) -> tuple[DataFrame, DataFrame]:
    """Rows that ``step`` makes (``key`` and ``schema``), and (``key``, ``error``) of the rows that it fails on; computed once."""
    from .similarity import checkpoint_folder

    checkpoint_folder(df.sparkSession)
    both = captured(df.select(key, column), column, schema, step).select(key, "made", "error").checkpoint()
    return both.where("error is null").select(key, F.explode("made").alias("m")).select(key, "m.*"), both.where("error is not null").select(key, "error")


def batch(episodes: DataFrame, key: str, text: str, schema: str, step: Callable, continue_on_error: bool = True) -> tuple[DataFrame, DataFrame]:
    """``step`` over the texts of all episodes: what it makes, and a row per episode (status, reason, checked).

    An episode without a text, or on which the step fails, is ``failed`` with the reason; one that gives nothing is ``skipped``.
    The others are as they would be without them.  With ``continue_on_error`` off, the first failure is raised.
    """
    from .reporting import attempted

    good, blank = attempted(episodes, text)
    made, errors = tried(good, key, text, schema, step)
    failed = errors.unionByName(blank.select(key, "error"))
    if not continue_on_error and (first := failed.orderBy(key).first()) is not None:
        raise ValueError(f"{key} {first[key]!r}: {first['error']}")
    counts = made.groupBy(key).agg(F.count("*").alias("checked"))
    counted, lost = counts.withColumnRenamed(key, "__c"), failed.withColumnRenamed(key, "__f")
    told = episodes.select(key).join(counted, F.col(key).eqNullSafe(F.col("__c")), "left").join(lost, F.col(key).eqNullSafe(F.col("__f")), "left")
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("checked").isNull(), "skipped").otherwise("ok")
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("checked").isNull(), "no claims")
    return made, told.select(key, status.alias("status"), reason.alias("reason"), F.coalesce("checked", F.lit(0)).alias("checked"))
