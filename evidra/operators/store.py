"""Tables of episodes, chunks, claims, quotes and links: ids in input order, lookups, writes from one lineage, updates.

A write makes a version of its own; readers of a table see the newest one.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .ranking import ordered_rank


def jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int, **options: str) -> DataFrame:
    """A database table, read in ``parts`` ranges of a numeric column."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=options)


def reachable(spark: SparkSession) -> bool:
    """Whether the session answers."""
    try:
        return spark.sql("SELECT 1").first()[0] == 1
    except Exception:  # whatever is wrong, there is no answer
        return False


def until_ready(probe: Callable[[], bool], tries: int = 5, wait: float = 2.0) -> None:
    """Polls a model's readiness before a job starts; raises if it never is."""
    for attempt in range(tries):
        if probe():
            return
        if attempt < tries - 1:
            time.sleep(wait)
    raise TimeoutError(f"not ready after {tries} tries")


def with_transcripts(episodes: DataFrame, transcripts: list[str], podcast: str | None = None, podcasts: list | None = None) -> DataFrame:
    """Episodes with a transcript that is not null; of certain podcasts, if these are named."""
    given = F.lit(False)
    for c in transcripts:
        given = given | F.col(c).isNotNull()
    found = episodes.where(given)
    return found.where(F.col(podcast).isin(podcasts)) if podcasts else found


def lookup(requested: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Each requested id with its row, and whether there is one (``found``)."""
    return requested.select(key).distinct().join(table.withColumn("found", F.lit(True)), key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def one(table: DataFrame, key: str, value, transcripts: list[str] | None = None):
    """The row of an id; LookupError if there is none, ValueError if it has none of the ``transcripts``."""
    row = table.where(F.col(key) == value).first()
    if row is None:
        raise LookupError(f"no {key} {value!r}")
    if transcripts and all(row[c] is None for c in transcripts):
        raise ValueError(f"{key} {value!r} has no transcript")
    return row


def missing(requested: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Requested ids that a table has no row for, each once."""
    return requested.select(key).distinct().join(table.select(key), key, "left_anti")


def numbered(chunks: DataFrame, key: str, order: str, name: str = "chunk_id", after: Column | int = 0) -> DataFrame:
    """Chunks with ids in the order of text and chunk, after those given already."""
    return ordered_rank(chunks, key, [order], name).withColumn(name, F.col(name) + (after if isinstance(after, Column) else F.lit(after)))


def with_chunk_ids(claims: DataFrame, chunks: DataFrame, keys: list[str], name: str = "chunk_id") -> DataFrame:
    """Claims that name their chunk by text and ordinal, with its id; null where the chunk is unknown."""
    return claims.join(chunks.select(*keys, name), keys, "left")


def merged_chunk_ids(claims: DataFrame, chunks: DataFrame, claim: str, text: str, ordinals: str, order: str, name: str = "chunk_id") -> DataFrame:
    """(claim, ids): the ids of all chunks whose ordinals a merged claim lists, 0 among them."""
    each = claims.select(claim, text, F.explode(ordinals).alias(order))
    return each.join(chunks.select(text, order, name), [text, order]).groupBy(claim).agg(F.sort_array(F.collect_set(name)).alias("merged_chunk_ids"))


def updated(table: DataFrame, changes: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """A table with ``column`` replaced where ``changes`` has the id (of several, the largest value), and the ids that the table lacks."""
    new = changes.groupBy(key).agg(F.max(column).alias("__new"))
    joined = table.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")
    return joined, missing(changes, table, key)


def would_change(table: DataFrame, ids: DataFrame, key: str, changes: Column) -> DataFrame:
    """What an update by ids would change, without doing it: one row with their number."""
    return table.where(changes).join(ids.select(key).distinct(), key, "left_semi").agg(F.count("*").alias("n"))


def commit(tables: dict[str, DataFrame], path: str) -> int:
    """Writes all tables below ``path`` as one new version (see ``versions``), and gives its number."""
    return versions.write(tables, path)


def current(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of the newest version."""
    return versions.read(spark, path, name)


def save(claims: DataFrame, quotes: DataFrame, links: DataFrame, path: str) -> int:
    """Claims (embeddings still null), quotes and links of one run, as one version."""
    bare = claims.withColumn("embedding", F.lit(None).cast("array<float>")) if "embedding" not in claims.columns else claims
    return commit({"claims": bare, "quotes": quotes, "links": links.dropDuplicates(["claim_id", "quote_id"])}, path)


def latest_with_repeats(requests: DataFrame, latest: DataFrame, group: str) -> DataFrame:
    """The rows of each requested group, as often as it was requested."""
    return requests.select(group).join(latest, group)


def has_rows(requested: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Whether each requested id has any row."""
    known = table.select(key).distinct().withColumn("__any", F.lit(True))
    return requested.select(key).distinct().join(known, key, "left").select(key, F.coalesce("__any", F.lit(False)).alias("has_rows"))


def lists_by(df: DataFrame, key: str, order: str, value: str, name: str) -> DataFrame:
    """Values of each key as a list in order; a key must fit a row."""
    return df.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), F.col(value).alias("value")))), lambda x: x["value"]).alias(name))

