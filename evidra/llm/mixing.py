"""Mixing sources to target weights by Poisson replication.

A source gets a target repetition rate: its target weight times the size of the mix, over what it has.  Each document
draws its number of copies by inverting the Poisson distribution of that mean at a number hashed from seed and id, so a
draw depends on nothing but the row, whatever the partitioning or a retry.  Documents are exploded by their counts and
put into a global order by another hash.  Means above one step are split into equal Poisson steps, whose sum has the
same distribution.  A rate above ``MOST_RATE`` copies of each document is an error that names the source.

Everything is DataFrame expressions.  The rates (a row per source) are computed first and join back on the source: by
broadcast if they are few, so that no text moves; else by a shuffle in which adaptive execution splits a hot source.  The order is a range exchange on hashes of id and copy, even
where one source, or one id, holds most rows.

Defined results: an empty table gives an empty mix; a text of any length counts with all its characters; equal shuffle
keys, which only rows of one id have, go by ``copy``; a null source is a source of its own; a null text has size 0; a source whose texts are all empty, or that
the weights leave out, gets rate 0; null ids draw alike, and so do rows that repeat an id; input columns named like an
output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import guarded, replacing, sized, table

SEED = 17
#: Largest mean inverted in one step, and the largest count that a step can give (beyond it lies less than 2**-52).
STEP_MEAN, STEP_COUNTS = 4, 40
#: Largest rate; the steps and copies of one row then fit in an array.
MOST_RATE = 1_000_000
OUTPUTS = ("copy", "shuffle_key")


def unit(*parts: Column) -> Column:
    """Uniform in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, ... ``STEP_COUNTS``."""
    start = F.exp(-mean)
    empty = F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("all"))

    def grow(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["all"], F.array(acc["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEP_COUNTS)), empty, grow, lambda acc: acc["all"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, size: float | None = None, text: str = "text", source: str = "source") -> DataFrame:
    """One row per source: its mean, the steps to draw it in, and the distribution of a step.

    ``weights``: target share of each source; by default all sources with any text get the same.  ``size``: characters
    of the mix; by default as many as there are.
    """
    have = docs.groupBy(F.col(source).alias("__source")).agg(F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("chars"))
    if weights is None:
        weighted = have.withColumn("w", F.when(F.col("chars") > 0, F.lit(1.0)).otherwise(0.0))
    else:
        target = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, w double")
        weighted = have.join(target, have["__source"].eqNullSafe(target["s"]), "left").select("__source", "chars", F.coalesce("w", F.lit(0.0)).alias("w"))
    totals = weighted.agg(F.sum("chars").cast("double").alias("chars"), F.sum(F.when(F.col("chars") > 0, F.col("w"))).alias("w"))
    total = F.lit(float(size)) if size is not None else totals.select("chars").scalar()
    mean = F.when((F.col("chars") > 0) & (F.col("w") > 0), F.col("w") / totals.select("w").scalar() * total / F.col("chars")).otherwise(F.lit(0.0))
    told = F.concat(F.lit("the rate of source "), F.coalesce("__source", F.lit("null")), F.lit(" is "), F.col("__rate").cast("string"), F.lit(f", above {MOST_RATE} copies of each document"))
    within = F.when(F.col("__rate") > MOST_RATE, F.raise_error(told).cast("double")).otherwise(F.col("__rate"))
    stepped = weighted.select("__source", mean.alias("__rate")).select("__source", within.alias("__mean")).withColumn("__steps", F.greatest(F.ceil(F.col("__mean") / STEP_MEAN), F.lit(1)).cast("int"))
    return stepped.withColumn("__upto", distribution(F.col("__mean") / F.col("__steps")))


def copies(key: Column, seed: int = SEED) -> Column:
    """Number of copies: for each step, how many cumulative probabilities lie at or below its hashed number."""
    tag = F.coalesce(key.cast("string"), F.lit("null"))

    def draw(step: Column) -> Column:
        u = unit(F.lit(str(seed)), tag, step.cast("string"))
        return F.element_at(F.transform(F.array(u), lambda x: F.size(F.filter(F.col("__upto"), lambda c: c <= x))), 1)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.col("__steps")), draw), F.lit(0), lambda a, b: a + b)


@guarded
def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, size: float | None = None, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source", ordered: bool = True) -> DataFrame:
    """``docs`` with each row as often as drawn, its ``copy`` number from 1, and the ``shuffle_key`` that orders the mix."""
    base = replacing(docs, *OUTPUTS)
    rate = sized(rates(docs, weights, size, text, source))
    drawn = base.join(rate, F.col(f"`{source}`").eqNullSafe(F.col("__source")), "left").withColumn("__n", copies(F.col(f"`{key}`"), seed)).where("__n > 0")
    each = drawn.select(*[F.col(f"`{c}`") for c in base.columns], F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("copy"))
    tag = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))
    out = each.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"order{seed}"), tag, F.col("copy").cast("string"))))
    return out.orderBy("shuffle_key", "copy") if ordered else out


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def oracle(documents: str = "documents", columns: str = "doc_id, text, lang, source, n_chars") -> str:
    """DuckDB SQL for the default mix of the rows of ``documents``."""
    return f"""
WITH RECURSIVE have AS (SELECT source, sum(coalesce(length(text), 0)) AS chars FROM {documents} GROUP BY source),
tot AS (SELECT CAST(sum(chars) AS DOUBLE) AS chars, CAST(sum(CASE WHEN chars > 0 THEN 1 END) AS DOUBLE) AS w FROM have),
rate AS (SELECT source, CASE WHEN have.chars > 0 THEN 1.0::DOUBLE / tot.w * tot.chars / have.chars ELSE 0.0::DOUBLE END AS mean FROM have, tot),
step AS (SELECT source, mean, CAST(greatest(ceil(mean / {STEP_MEAN}), 1) AS INTEGER) AS steps FROM rate),
upto AS (SELECT source, mean / steps AS m, 0 AS k, exp(-(mean / steps)) AS p, exp(-(mean / steps)) AS c FROM step
  UNION ALL SELECT source, m, k + 1, p * m / (k + 1), c + p * m / (k + 1) FROM upto WHERE k < {STEP_COUNTS}),
law AS (SELECT source, list(c ORDER BY k) AS cs FROM upto GROUP BY source),
drawn AS (SELECT d.*, list_sum([len(list_filter(law.cs, lambda c: c <= CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || s), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE)) FOR s IN range(1, step.steps + 1)]) AS n
  FROM {documents} d JOIN step ON d.source IS NOT DISTINCT FROM step.source JOIN law ON d.source IS NOT DISTINCT FROM law.source),
each AS (SELECT {columns}, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INTEGER) AS copy FROM drawn WHERE n > 0)
SELECT *, md5('order{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || copy) AS shuffle_key FROM each"""


QUERIES = {"op9_mixing": op9_mixing}
ORACLE_SQL = {"op9_mixing": oracle()}
