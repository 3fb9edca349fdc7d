"""Summaries and checks around a run: batch results, funnels, caches, split claims, judged scores, reviewed chunks, formats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from . import scorers as M
from .claims import sentence_windows, top_by
from .similarity import checkpoint_folder


def batch_summary(results: DataFrame) -> DataFrame:
    """One row over per-episode results (status ok, failed or skipped; checked; flagged; seconds): counts, sums, mean time of those that succeeded."""
    ok = F.col("status") == "ok"
    return results.agg(
        F.count("*").alias("total"), F.count_if(ok).alias("successful"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.coalesce(F.sum(F.when(ok, F.col("checked"))), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.when(ok, F.col("flagged"))), F.lit(0)).alias("flagged"),
        F.coalesce(F.avg(F.when(ok, F.col("seconds"))), F.lit(0.0)).alias("mean_seconds"),
    )


def reasons(results: DataFrame, status: str = "skipped") -> DataFrame:
    """How often each reason was given for a status."""
    return results.where(F.col("status") == status).groupBy("reason").agg(F.count("*").alias("n"))


def attempted(episodes: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Episodes that can be worked on, and an error row (with ``error``) for each that cannot."""
    blank = F.coalesce(X.trimmed(F.col(text)) == "", F.lit(True))
    return episodes.where(~blank), episodes.where(blank).withColumn("error", F.lit("no transcript text"))


def run_batch(episodes: DataFrame, step: Callable[[DataFrame], DataFrame], key: str, text: str = "text", continue_on_error: bool = True) -> tuple[DataFrame, DataFrame]:
    """``step`` over all episodes at once, and their results (status, reason): no claims means skipped, no text failed.

    Raises before any work if an episode cannot be worked on and ``continue_on_error`` is off.
    """
    good, bad = attempted(episodes, text)
    if not continue_on_error and (first := bad.first()) is not None:
        raise ValueError(f"{key} {first[key]!r}: {first['error']}")
    checkpoint_folder(episodes.sparkSession)
    made = step(good).checkpoint()  # for its rows and for their numbers
    counts = made.groupBy(key).agg(F.count("*").alias("checked"))
    done = good.select(key).join(counts, key, "left").select(key, F.when(F.col("checked").isNull(), "skipped").otherwise("ok").alias("status"), F.when(F.col("checked").isNull(), "no claims").alias("reason"), F.coalesce("checked", F.lit(0)).alias("checked"))
    return made, done.unionByName(bad.select(key, F.lit("failed").alias("status"), F.col("error").alias("reason"), F.lit(0).cast("long").alias("checked")))


def run_one(episodes: DataFrame, step: Callable[[DataFrame], DataFrame], key: str, value) -> DataFrame:
    """``step`` over the episode of one id; ids start at 1."""
    if value < 1:
        raise ValueError("ids are positive")
    return step(episodes.where(F.col(key) == value))


def funnel_averages(per_episode: DataFrame, counters: list[str]) -> DataFrame:
    """Sum and mean of each counter over episodes."""
    return per_episode.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}") for c in counters], *[F.coalesce(F.avg(c), F.lit(0.0)).alias(f"avg_{c}") for c in counters])


def distinct_positions(quotes: DataFrame, group: str, start: str, end: str) -> DataFrame:
    """Distinct (start, end) per group."""
    return quotes.groupBy(group).agg(F.count_distinct(start, end).alias("n_positions"))


def cache_keys(*parts: Column) -> Column:
    """The key under which a scorer's answer is remembered."""
    return F.md5(F.concat_ws("\x01", *parts))


def cache_statistics(inputs: DataFrame, *columns: str) -> DataFrame:
    """What a memo of all inputs would save: each distinct one is scored once, the others are hits."""
    seen = inputs.groupBy(*columns).agg(F.count("*").alias("n"))
    rows = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("requests"), F.count("*").alias("misses"))
    hits = F.col("requests") - F.col("misses")
    return rows.select("requests", hits.alias("hits"), "misses", F.coalesce(F.try_divide(hits.cast("double"), F.col("requests")), F.lit(0.0)).alias("hit_rate"))


def search_index(segments: DataFrame, text: str = "text", embed: M.Scorer = M.embed) -> DataFrame:
    """Windows of sentences with their vectors."""
    return embed(sentence_windows(segments, text).withColumnRenamed("window_text", "text"))


def index_statistics(windows: DataFrame, text: str = "window_text") -> DataFrame:
    return windows.agg(F.count("*").alias("n_windows"), F.coalesce(F.sum(F.length(text)), F.lit(0)).alias("total_chars"))


def split_probes(claims: DataFrame, text: str, order: list[str], most: int = 100) -> DataFrame:
    """Claims that a cut at an apostrophe may have left: those that begin with "s ", and those under 15 characters; the first ``most`` of each."""
    kinds = F.array_compact(F.array(F.when(F.col(text).like("s %"), "starts_with_s"), F.when(F.length(text) < 15, "very_short")))
    return top_by(claims.withColumn("probe", F.explode(kinds)), ["probe"], [F.col(c) for c in order], most)


def has_split(items: Column) -> Column:
    """Whether a list has an item that begins with "s "."""
    return F.coalesce(F.exists(items, lambda x: x.startswith("s ")), F.lit(False))


def with_required(answer: Column, schema: str, keys: list[str]) -> Column:
    """A fenced or plain JSON object as a struct; null unless it has all ``keys``."""
    made = F.from_json(X.fenced(answer), schema)
    every = F.lit(True)
    for k in keys:
        every = every & made[k].isNotNull()
    return F.when(every, made)


def guests(answer: Column) -> Column:
    """Guests (name, urls) of a JSON answer; null if it is none or any of them lacks its name or its list of urls."""
    found = with_required(answer, "guests array<struct<name:string,urls:array<string>>>", ["guests"])["guests"]
    return F.when(F.forall(found, lambda g: g["name"].isNotNull() & g["urls"].isNotNull()), found)


def judged(claims: DataFrame, text: str, judge: Callable[[Column], Column] = lambda c: X.quality_issue(c).isNull()) -> DataFrame:
    """``verdict`` by rules where they decide, else by the judge (``asked``)."""
    issue, borderline = X.obvious_issue(F.col(text)).isNotNull(), X.needs_judge(F.col(text))
    return claims.withColumn("asked", borderline).withColumn("verdict", F.when(issue, False).when(borderline, judge(F.col(text))).otherwise(True))


def hybrid_scores(claims: DataFrame, key: str, text: str) -> DataFrame:
    """Share of good claims per key, and how many of them the judge was asked about."""
    return judged(claims, text).groupBy(key).agg(F.count("*").alias("n_claims"), F.count_if("asked").alias("judge_calls"), F.avg(F.col("verdict").cast("double")).alias("score"))


def judge_scores(claims: DataFrame, key: str, text: str, judge: Callable[[Column], Column] = lambda c: X.quality_issue(c).isNull()) -> DataFrame:
    """Share of claims per key that the judge calls good; each distinct claim is judged once."""
    verdicts = M.once(claims, [text], lambda df: df.withColumn("verdict", judge(F.col(text))))
    return verdicts.groupBy(key).agg(F.count("*").alias("n_claims"), F.avg(F.col("verdict").cast("double")).alias("score"))


def ad_points(predicted: Column, actual: Column) -> Column:
    """1 for a right advertisement label, else 0."""
    return (predicted == actual).cast("int")


def reviewed_chunks(rows: DataFrame, chunk: str, order: str, claims: str) -> DataFrame:
    """Claims of identical chunk texts together, in the order of the rows; a chunk's claims must fit a row."""
    ordered = F.sort_array(F.collect_list(F.struct(order, claims)))
    return rows.groupBy(chunk).agg(F.flatten(F.transform(ordered, lambda x: x[claims])).alias("claims"), F.min(order).alias("first"))


def reviewed_totals(rows: DataFrame, chunk: str, claims: str) -> DataFrame:
    """Rows and claims in all, and mean, least and most claims per chunk."""
    per = rows.groupBy(chunk).agg(F.sum(F.size(claims)).alias("n"), F.count("*").alias("rows"))
    return per.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_claims"), F.count("*").alias("n_chunks"), F.avg("n").alias("avg_claims"), F.min("n").alias("min_claims"), F.max("n").alias("max_claims"))


def reviewed_by(rows: DataFrame, who: str, claims: str) -> DataFrame:
    """Rows and claims of each maintainer."""
    return rows.groupBy(who).agg(F.count("*").alias("n_rows"), F.sum(F.size(claims)).alias("n_claims"))


def duration(seconds: Column) -> Column:
    """``45s``, ``3m 5s``, ``2h 10m``."""
    whole = F.floor(seconds).cast("long")
    part = lambda x: x.cast("string")
    return (
        F.when(whole < 60, F.concat(part(whole), F.lit("s")))
        .when(whole < 3600, F.concat(part(F.floor(whole / 60)), F.lit("m "), part(whole % 60), F.lit("s")))
        .otherwise(F.concat(part(F.floor(whole / 3600)), F.lit("h "), part(F.floor(whole % 3600 / 60)), F.lit("m")))
    )


def comparison(before: Column, after: Column) -> Column:
    """``0.500 → 0.250 (-0.250)``."""
    return F.format_string("%.3f → %.3f (%s%.3f)", before, after, F.when(after >= before, F.lit("+")).otherwise(""), after - before)


def run_folder(spark: SparkSession, kind: str) -> str:
    """The folder of a training run, named by its time."""
    return "models/" + spark.range(1).select(F.concat(F.lit(f"{kind}_"), F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss"))).first()[0]


def podcast_name(podcast: Column) -> Column:
    return F.concat(F.lit("Podcast "), podcast.cast("string"))


def prompt(items: DataFrame, batch: str, order: str, fields: list[str]) -> DataFrame:
    """The items of each batch as one JSON list in order."""
    listed = F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("item"))))
    return items.groupBy(batch).agg(F.to_json(F.transform(listed, lambda x: x["item"])).alias("prompt"))
