"""A corpus pipeline: each stage works on what the stage before it kept, and ends up as a table.

Quality rules, near-duplicates, personal data, mixing, token ids.  All stages but the last return the columns of
documents.  SQL cannot express the near-duplicate, personal-data and tokenizer stages, so there is no oracle; the tests
hold each stage against brute force or, for quality and mixing, against the SQL of its operator.

Defined results of every stage, as of the operator that it calls: null texts, languages, sources and ids are values of their
own; empty and very long texts count whole; repeated rows are rows each, of which near-duplicates keep one; ties go to the
smallest id; an empty table stays empty; further columns are kept, whatever their names (the last stage replaces columns
named ``ids``, ``n_tokens`` or ``roundtrip_ok``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidra.llm import bpe, mixing, pii, quality, simhash
from evidra.llm.common import stored, unused

#: Jaccard similarity of five-word shingles from which two texts are near-duplicates.
SIMILARITY = 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive quality rules keep."""
    return quality.quality_filter(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that op5_simhash forms (3-word fingerprints within 2 bits); not a stage of the pipeline."""
    return simhash.deduplicated(docs)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    return simhash.deduplicated(docs, similarity=SIMILARITY)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by the name of its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same, in a global shuffled order."""
    own = [c for c in docs.columns if c in mixing.OUTPUTS]  # columns named like an output of the operator stay the document's
    away = dict(zip(own, unused(docs, *[f"own_{c}" for c in own]), strict=True))
    made = mixing.mixed(docs.withColumnsRenamed(away)).drop(*mixing.OUTPUTS)
    return made.withColumnsRenamed({v: k for k, v in away.items()})


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their number and whether they decode to it."""
    path, pattern = bpe.vocabulary()
    return bpe.encode(docs, path, pattern, checked="roundtrip_ok").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_dissimilar),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
