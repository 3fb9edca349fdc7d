"""Text files whose records run over lines and over the borders of file splits: log blocks and quoted CSV, read in many tasks.

Lines are read with their place: the file, where the split begins, and the line's turn in it.  What a line means depends on
all lines before it (is a block open, is a quote open), so each split is summed up, the few sums of a file's splits are
combined in their order, and each split is then read with what it begins with.  No task reads a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, turn, value) of all lines, with ``turn`` ascending within a split."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("turn"), "value")


def _in_order() -> Window:
    return Window.partitionBy("file", "split").orderBy("turn", "piece")


def _earlier() -> Window:
    return Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)


def _with_carried(rows: DataFrame, sums: DataFrame) -> DataFrame:
    """``rows`` with what the earlier splits of their file (one row each in ``sums``) add up to."""
    return rows.join(sums.withColumnsRenamed({"file": "__file", "split": "__split"}), (F.col("file") == F.col("__file")) & (F.col("split") == F.col("__split"))).drop("__file", "__split")


def blocks(spark: SparkSession, path: str, start: str, end: str, most: int = 3) -> DataFrame:
    """(file, n, block): the first ``most`` stretches of each file from a ``start`` to the next ``end``; both are patterns within a line.

    A ``start`` in an open block is text of it, an ``end`` outside is nothing; a block that is never closed is none.
    """
    mark = "\x00"
    cut = F.split(F.regexp_replace(F.regexp_replace("value", f"({start})", f"{mark}S$1{mark}"), f"({end})", f"{mark}E$1{mark}"), mark, -1)
    # Pieces of a line: text, or a mark with what it stands for; the last piece of a line is followed by a line end.
    pieces = lines(spark, path).select("file", "split", "turn", F.size(cut).alias("of"), F.posexplode(cut).alias("piece", "text")).where((F.col("piece") % 2 == 0) | (F.col("text") != ""))
    marked = pieces.withColumn("kind", F.when(F.col("piece") % 2 == 1, F.substring("text", 1, 1))).withColumn("last", F.col("piece") == F.col("of") - 1)
    marked = marked.withColumn("text", F.when(F.col("kind").isNotNull(), F.expr("substring(text, 2)")).otherwise(F.col("text")))
    before = F.last("kind", True).over(_in_order().rowsBetween(Window.unboundedPreceding, -1))
    seen = marked.withColumn("was", before)
    opened = F.count_if((F.col("kind") == "S") & (F.col("was") == "E"))
    own = seen.groupBy("file", "split").agg(F.min_by("kind", F.when(F.col("kind").isNotNull(), F.struct("turn", "piece"))).alias("first"), F.max_by("kind", F.when(F.col("kind").isNotNull(), F.struct("turn", "piece"))).alias("final"), opened.alias("opened"))
    told = own.withColumn("state", F.coalesce(F.last("final", True).over(_earlier()), F.lit("E")))
    told = told.withColumn("mine", F.col("opened") + F.when((F.col("first") == "S") & (F.col("state") == "E"), 1).otherwise(0))
    sums = told.select("file", "split", "state", F.coalesce(F.sum("mine").over(_earlier()), F.lit(0)).alias("done"))
    placed = _with_carried(seen, sums).withColumn("was", F.coalesce("was", "state"))
    opens = (F.coalesce(F.col("kind"), F.lit("")) == "S") & (F.col("was") == "E")
    numbered = placed.withColumn("opens", opens).withColumn("n", F.col("done") + F.sum(F.col("opens").cast("long")).over(_in_order().rowsBetween(Window.unboundedPreceding, 0)))
    closes = (F.col("kind") == "E") & (F.col("was") == "S")
    inside = (F.col("was") == "S") & ~F.coalesce(closes, F.lit(False))
    kept = numbered.where((F.col("n") <= most) & (inside | F.col("opens") | F.coalesce(closes, F.lit(False))))
    text = F.concat(F.when(inside & ~F.col("opens"), F.col("text")).otherwise(""), F.when(F.col("last") & ~F.coalesce(closes, F.lit(False)), "\n").otherwise(""))
    listed = kept.groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("split", "turn", "piece", text.alias("t")))).alias("all"), F.bool_or(F.coalesce(closes, F.lit(False))).alias("closed"))
    return listed.where("closed").select("file", (F.col("n") - 1).cast("int").alias("n"), F.array_join(F.transform("all", lambda x: x["t"]), "").alias("block"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, turn, record, odd): whole records of CSV files; one that begins in a split may end in a later one.

    A line belongs to the record before it if an odd number of quotes came earlier in its file.  Blank lines between
    records are none; ``odd`` marks a record whose quote is never closed, at the end of a file.
    """
    rows = lines(spark, path).withColumn("piece", F.lit(0)).withColumn("quotes", F.length("value") - F.length(F.translate("value", '"', "")))
    totals = rows.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    carried = totals.select("file", "split", (F.coalesce(F.sum("quotes").over(_earlier()), F.lit(0)) % 2).alias("open"))
    before = F.coalesce(F.sum("quotes").over(_in_order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = _with_carried(rows, carried).withColumn("begins", (F.col("open") + before) % 2 == 0)
    # A record is named by where it begins; lines before the first beginning of a split belong to the last one of an earlier split.
    own = F.when(F.col("begins"), F.struct("split", "turn"))
    last = placed.groupBy("file", "split").agg(F.max(own).alias("final"))
    ahead = last.select("file", "split", F.last("final", True).over(_earlier()).alias("ahead"))
    named = _with_carried(placed, ahead).withColumn("at", F.coalesce(F.last(own, True).over(_in_order().rowsBetween(Window.unboundedPreceding, 0)), F.col("ahead")))
    whole = named.groupBy("file", "at").agg(F.sort_array(F.collect_list(F.struct("split", "turn", "value"))).alias("all"), (F.sum("quotes") % 2 == 1).alias("odd"))
    record = F.regexp_replace(F.array_join(F.transform("all", lambda x: x["value"]), "\n"), "\r$", "")
    return whole.select("file", F.col("at.split").alias("split"), F.col("at.turn").alias("turn"), record.alias("record"), "odd").where("record <> ''")


def csv(spark: SparkSession, path: str, columns: list[str] | None = None, corrupt: str | None = None) -> DataFrame:
    """Text columns of CSV files with a header each, quoted by ``"`` and escaped by doubling it; quoted values may hold line ends.

    ``columns`` name the values, by default as the header of the first file does.  Records that are short have nulls, what is
    too much is left out; ``corrupt`` names a further column with the record where the numbers differ or a quote stays open.
    """
    records = csv_records(spark, path)
    first = records.groupBy("file").agg(F.min(F.struct("split", "turn")).alias("head"))
    joined = records.join(first.withColumnRenamed("file", "__file"), F.col("file") == F.col("__file"))
    is_head = (F.col("split") == F.col("head.split")) & (F.col("turn") == F.col("head.turn"))
    if columns is None:
        head = joined.where(is_head).orderBy("file").first()
        columns = [] if head is None else fields_of(head["record"].lstrip("﻿"))
    shape = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(columns) + 1)])
    made = F.from_csv("record", shape.simpleString()[7:-1].replace(":", " "), {"escape": '"', "quote": '"', "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"})
    rows = joined.where(~is_head).select("record", made.alias("v"), _n_fields(F.col("record")).alias("n"), "odd")
    found = [F.col(f"v.c{k}").alias(c) for k, c in enumerate(columns)]
    ragged = [F.when((F.col("n") != len(columns)) | F.col("odd"), F.col("record")).alias(corrupt)] if corrupt else []
    return rows.select(*found, *ragged)


def _n_fields(record: Column) -> Column:
    """Values of a record: commas outside quotes, and one."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*+"', "")
    return F.length(bare) - F.length(F.translate(bare, ",", "")) + 1


def fields_of(record: str) -> list[str]:
    """The values of one record."""
    import csv as reader

    return next(reader.reader([record]), [])
