"""Choosing episodes and keeping their state: latest per group, anti and semi selection, counts, updates, links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .claims import top_by
from .ranking import hashed_rank


def latest(episodes: DataFrame, group: str, when: str, key: str, n: int) -> DataFrame:
    """The ``n`` newest rows of each group, undated ones last, smaller keys first on ties."""
    return top_by(episodes, [group], [F.col(when).desc_nulls_last(), F.col(key)], n)


def unprocessed(episodes: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """Episodes without any claim."""
    return episodes.join(claims.select(key), key, "left_anti")


def to_validate(episodes: DataFrame, claims: DataFrame, key: str, verified: Column) -> DataFrame:
    """Episodes with a claim not verified yet."""
    return episodes.join(claims.where(~verified).select(key), key, "left_semi")


def processing_stats(episodes: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    """Total, processed and unprocessed episodes, and claims, in one pass."""
    counts = claims.groupBy(key).agg(F.count("*").alias("n"))
    return episodes.select(key).join(counts, key, "left").agg(
        F.count("*").alias("total"), F.count("n").alias("processed"), F.count_if(F.col("n").isNull()).alias("unprocessed"), F.coalesce(F.sum("n"), F.lit(0)).alias("claims")
    )


def counts_with_zeros(ids: DataFrame, claims: DataFrame, key: str) -> DataFrame:
    return ids.join(claims.groupBy(key).agg(F.count("*").alias("n_claims")), key, "left").select(key, F.coalesce("n_claims", F.lit(0)).cast("long").alias("n_claims"))


def eligible(claims: DataFrame, key: str, least: int = 5) -> DataFrame:
    return claims.groupBy(key).agg(F.count("*").alias("n_claims")).where(F.col("n_claims") >= least)


def in_state(claims: DataFrame, flagged: bool | None = None, verified: bool | None = None) -> DataFrame:
    """Claims that are flagged and verified, or not, as asked; None leaves a state open."""
    for name, wanted in (("is_flagged", flagged), ("is_verified", verified)):
        if wanted is not None:
            claims = claims.where(F.coalesce(F.col(name), F.lit(False)) == wanted)
    return claims


def validated(claims: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """``is_flagged`` and ``is_verified`` after validation: every claim sent is verified, an answer missing means valid,
    answers for unknown claims are dropped."""
    answers = results.groupBy(key).agg(F.min("is_valid").alias("__valid"))  # of several answers, the strictest
    joined = claims.join(answers, key, "left")
    flagged = F.coalesce(F.col("is_flagged"), F.lit(False)) | ~F.coalesce("__valid", F.lit(True))
    return joined.withColumn("is_flagged", flagged).withColumn("is_verified", F.lit(True)).drop("__valid")


def get_or_create(quotes: DataFrame, stored: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Quotes with the id that their keys have already, or a new one numbered after all of them."""
    top = stored.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top")).select("top").scalar()
    fresh = quotes.select(*keys).distinct().join(stored.select(*keys), keys, "left_anti")
    ranked = hashed_rank(fresh, F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), keys, "__rank")
    numbered = ranked.select(*keys, (top + F.col("__rank")).alias(id_col))
    return quotes.join(stored.select(*keys, id_col).unionByName(numbered), keys)


def new_links(links: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Links that do not exist yet, each once."""
    return links.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti")


def merge_links(links: DataFrame, stored: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, int]:
    """All links after a merge, those that it added, and how many these are; what is stored already stays as it is."""
    from .similarity import checkpoint_folder

    checkpoint_folder(links.sparkSession)
    added = new_links(links, stored, keys).checkpoint()
    return stored.unionByName(added), added, added.count()
