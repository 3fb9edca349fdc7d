"""Answers of a scorer, remembered from run to run: joined before scoring, so only new inputs are scored.

The memo is a table in numbered versions (see ``versions``): the inputs, their answers, and when they were given.  Answers are
good for a time and may be checked; of more than a given number, the oldest go first.  A run adds its new answers as files of
their own, and writes the memo anew only if something has to go.  Of runs at once, who commits second reads again, so no
answer is lost.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import versions
from .scorers import Scorer


@dataclass
class Remembered:
    """Rows with their answers, and what the memo did for them."""

    rows: DataFrame
    requests: int
    #: Distinct inputs that were scored; all other requests were hits.
    misses: int
    #: Answers that were too old or did not pass the check, that had to go for newer ones, and that are stored now.
    expired: int
    evicted: int
    stored: int

    def statistics(self) -> DataFrame:
        hits = self.requests - self.misses
        row = (self.requests, hits, self.misses, hits / self.requests if self.requests else 0.0, self.expired, self.evicted, self.stored)
        return self.rows.sparkSession.createDataFrame([row], "requests long, hits long, misses long, hit_rate double, expired long, evicted long, stored long")


def key_of(columns: list[str]) -> Column:
    """The key of some inputs; nulls are inputs too."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def youngest(answers: DataFrame, most: int) -> DataFrame:
    """The ``most`` youngest answers (``key``, ``at``); of those of one time, the smallest keys.

    Answers are counted by time and the first two digits of their key; only these counts pass through one task, and ranks
    are needed within them only.
    """
    marked = answers.withColumn("__p", F.substring("key", 1, 2))
    counts = marked.groupBy("at", "__p").agg(F.count("*").alias("__n"))
    before = counts.select(F.col("at").alias("__at"), F.col("__p").alias("__q"), (F.sum("__n").over(Window.orderBy(F.desc("at"), "__p")) - F.col("__n")).alias("__before"))
    placed = marked.join(before, (F.col("at") == F.col("__at")) & (F.col("__p") == F.col("__q"))).where(F.col("__before") < most)
    own = F.row_number().over(Window.partitionBy("at", "__p").orderBy("key"))
    return placed.withColumn("__own", own).where(F.col("__before") + F.col("__own") <= most).select(*answers.columns)


def _once(df: DataFrame) -> DataFrame:
    from .similarity import checkpoint_folder

    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def answers(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """All stored answers: key, at, inputs and outputs; none if there is no memo."""
    if "memo" not in versions.tables(spark, path, version):
        return None
    return versions.read(spark, path, "memo", version)


def remembered(df: DataFrame, inputs: list[str], scorer: Scorer, path: str, hours: float = 24.0, most: int = 1_000_000, valid: Column | None = None, now: float | None = None) -> Remembered:
    """``scorer`` over the distinct ``inputs`` of ``df`` that the memo at ``path`` does not answer; its answers joined to all rows.

    Answers are good for ``hours``, and only if ``valid`` (a condition on the scorer's outputs) holds.  ``now``: seconds since 1970,
    by default the driver's clock; only ages are taken from it, never which version is newest.
    """
    spark = df.sparkSession
    at = int((time.time() if now is None else now) * 1000)
    wanted = _once(df.select(*inputs).groupBy(*inputs).agg(F.count("*").alias("__n")).withColumn("key", key_of(inputs)))
    seen = versions.newest(spark, path)
    known = answers(spark, path, seen)
    good = None
    if known is not None:
        sound = F.col("at") > at - int(hours * 3_600_000)
        good = known.where(sound & F.coalesce(valid, F.lit(False)) if valid is not None else sound)
    missing = wanted if good is None else wanted.join(good.select("key"), "key", "left_anti")
    scored = _once(scorer(missing.select(*inputs)).withColumn("key", key_of(inputs)).withColumn("at", F.lit(at)))
    names = [c for c in scored.columns if c not in (*inputs, "key", "at")]
    shape = ["key", "at", *inputs, *names]
    fresh = scored.select(*shape)
    all_answers = fresh if good is None else good.select(*shape).unionByName(fresh).dropDuplicates(["key"])
    made = df.withColumn("key", key_of(inputs)).join(all_answers.select("key", *names), "key", "left").select(*df.columns, *names)
    rows = _once(made)  # before the memo lets go of anything that these rows need
    requests, misses = wanted.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0], fresh.count()
    expired = evicted = stored = 0

    def store(version: int) -> int:
        nonlocal expired, evicted, stored
        old = answers(spark, path, version)
        kept = None if old is None else old.where((F.col("at") > at - int(hours * 3_600_000)) & (F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True)))
        add = fresh if kept is None else fresh.join(kept.select("key"), "key", "left_anti").select(*shape)
        n_old, n_kept, n_add = (0 if x is None else x.count() for x in (old, kept, add))
        expired, evicted = n_old - n_kept, max(0, n_kept + n_add - most)
        stored = n_kept + n_add - evicted
        if old is None or expired or evicted:
            whole = add if kept is None else kept.select(*shape).unionByName(add)
            return versions.write({"memo": youngest(whole, most) if evicted else whole}, path, version)
        return versions.append({"memo": add}, path, version) if n_add else version

    versions.transact(spark, path, store)
    return Remembered(rows, requests, misses, expired, evicted, stored)
