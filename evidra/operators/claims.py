"""Claims from texts: sentences, the filter funnel, caps and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X


def sentence_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """A row per sentence: ``pos`` from 0 and ``sentence``; without the text."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(X.sentences(F.col(text))).alias("pos", "sentence"))


def sentence_windows(df: DataFrame, text: str = "text", size: int = 2, overlap: int = 1) -> DataFrame:
    """Sliding windows of sentences; the last may be short."""
    rest = [c for c in df.columns if c != text]
    step = size - overlap
    parts = df.select(*rest, X.sentences(F.col(text)).alias("s")).where(F.size("s") > 0)
    made = F.transform(F.sequence(F.lit(0), F.size("s") - 1, F.lit(step)), lambda i: F.array_join(F.slice(F.col("s"), i + 1, F.lit(size)), " "))
    return parts.select(*rest, F.posexplode(made).alias("window_no", "window_text"))


def top_by(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; the partial group limit prunes before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= k).drop("__n")


def judged_claims(sentences: DataFrame, reject_lower: bool = True) -> DataFrame:
    """``reason`` per sentence: blank, lower, short, long, vague or valid, in the order of the funnel."""
    lower = F.when(X.starts_lower(F.col("sentence")), "lower") if reject_lower else F.when(F.lit(False), "lower")
    return sentences.withColumn("reason", F.when(X.trimmed(F.col("sentence")) == "", "blank").otherwise(F.coalesce(lower, X.claim_reason(F.col("sentence")))))


def capped(claims: DataFrame, key: str, cap: int = 10) -> DataFrame:
    """The ``cap`` longest claims of each group, earlier ones first on ties."""
    return top_by(claims, [key], [F.length("sentence").desc(), F.col("pos")], cap)


def valid_claims(df: DataFrame, key: str, text: str = "text", cap: int = 10) -> DataFrame:
    return capped(judged_claims(sentence_rows(df, text)).where("reason = 'valid'"), key, cap)


def claims_from_answers(answers: DataFrame, key: str, answer: str = "answer", error: str | None = None, cap: int = 10) -> DataFrame:
    """(key, pos, sentence) of a model's answers: the claims of each list, split ones joined again, those that are valid, the longest.

    An answer that holds no list, an ``error`` or no answer at all gives no claims.
    """
    listed = F.coalesce(X.repaired_claims(F.filter(F.transform(X.json_list(X.fenced(F.col(answer))), X.trimmed), lambda x: x != "")), F.array().cast("array<string>"))
    items = F.when(F.col(error).isNull(), listed).otherwise(F.array().cast("array<string>")) if error else listed
    rows = answers.select(key, F.posexplode(items).alias("pos", "sentence"))
    return capped(judged_claims(rows).where("reason = 'valid'"), key, cap).select(key, "pos", "sentence")
