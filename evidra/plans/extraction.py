"""Whole pipelines over all episodes at once: one plan instead of a loop.

Episodes: (episode_id, text).  Full: segments, chunks, claims, deduplication by vectors and reranking, ads, the nearest
windows as quotes, reranking, folding, entailment, confidence.  Short: claims of the whole text at a fixed confidence.
Model steps are arguments (see ``evidra.operators.scorers``).  What several later steps read is computed once and its
lineage cut, so Python steps never run again for each of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import claims as C
from ..operators import evidence as E
from ..operators import scorers as M
from ..operators import sequences as Q
from ..operators import similarity as V


@dataclass(frozen=True)
class Settings:
    chunk_size: int = 16_000
    chunk_overlap: int = 1000
    chunk_margin: int = 500
    claims_per_chunk: int = 10
    claim_similarity: float = 0.85
    claim_relevance: float = 0.9
    ad_confidence: float = 0.7
    candidates: int = 30
    quotes_per_claim: int = 10
    least_relevance: float = 0.85
    least_confidence: float = 0.3
    short_confidence: float = 0.8


def once(df: DataFrame) -> DataFrame:
    """``df`` computed now, its lineage cut."""
    V.checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def claims_of(episodes: DataFrame, kind: str, s: Settings, embed=M.embed, rerank=M.rerank) -> DataFrame:
    """episode_id, claim_id, claim, embedding, chunk_no: valid claims of each chunk, alike ones of an episode once (the longest).

    Two claims are alike if their vectors are and the reranker agrees.
    """
    joined = Q.full_text(Q.parsed(episodes, kind), "episode_id")
    chunks = Q.chunks(joined, "full_text", s.chunk_size, s.chunk_overlap, s.chunk_margin)
    rows = chunks.select(F.concat_ws(":", "episode_id", "chunk_no").alias("key"), "episode_id", "chunk_no", F.col("chunk_text").alias("text"))
    found = C.valid_claims(rows, "key", "text", s.claims_per_chunk)
    named = once(embed(found.select("episode_id", "chunk_no", F.col("sentence").alias("claim"), F.xxhash64("key", "pos").alias("claim_id")), "claim"))
    close = V.similar_in_group(named, "episode_id", "claim_id", "embedding", s.claim_similarity)
    left, right = (named.select(F.col("claim_id").alias(f"{side}_id"), F.col("claim").alias(name)) for side, name in (("left", "claim"), ("right", "quote")))
    pairs = rerank(close.join(left, "left_id").join(right, "right_id")).where(F.col("relevance") >= s.claim_relevance)
    grouped = V.link_components(named.select(F.col("claim_id").alias("node")), pairs.select(F.col("left_id").alias("u"), F.col("right_id").alias("v")))
    members = named.join(grouped, named.claim_id == grouped.node).withColumn("confidence", F.lit(1.0))
    merged = E.merged_groups(members, "component", "claim_id", "claim", "confidence", "chunk_no")
    best = merged.select(F.col("representative").alias("claim_id"), F.col("chunks").alias("merged_chunks"))
    return once(named.join(best, "claim_id"))


def quotes_of(episodes: DataFrame, kind: str, embed=M.embed) -> DataFrame:
    """Windows of sentences that may serve as quotes, with their vectors."""
    windows = C.sentence_windows(Q.parsed(episodes, kind).select("episode_id", "seg_no", "speaker", "seconds", F.col("raw_start"), F.col("clean_text").alias("text")))
    quotes = windows.select("episode_id", F.xxhash64("episode_id", "seg_no", "window_no").alias("quote_id"), F.col("window_text").alias("quote"), "speaker", F.col("seconds").cast("long").alias("ts"), F.col("raw_start").cast("long").alias("start_pos"))
    quotes = quotes.withColumn("end_pos", F.col("start_pos") + F.length("quote")).where((X.quote_reason(F.col("quote")) == "valid") & ~X.is_question(F.col("quote")))
    return embed(quotes, "quote")


def full(episodes: DataFrame, kind: str = "numbered", settings: Settings | None = None, rerank=M.rerank, ads=M.classify_ads, entail=M.entail, embed=M.embed) -> dict[str, DataFrame]:
    """``claims`` (with confidence) and ``links`` (claim, quote, scores)."""
    s = settings or Settings()
    claims = ads(claims_of(episodes, kind, s, embed, rerank)).where(~(F.col("is_ad") & (F.col("ad_confidence") >= s.ad_confidence)))
    vectors = once(quotes_of(episodes, kind, embed))
    near = V.nearest_in_group(claims, vectors, "episode_id", "quote_id", "claim_id", "embedding", s.candidates)
    quotes = vectors.drop("embedding")
    pairs = near.select(F.col("query_id").alias("claim_id"), F.col("vec_id").alias("quote_id")).join(claims.select("claim_id", "claim"), "claim_id").join(quotes, "quote_id")
    ranked = rerank(pairs).where(F.col("relevance") >= s.least_relevance)
    ranked = once(C.top_by(ranked, ["claim_id"], [F.col("relevance").desc(), F.col("quote_id")], s.quotes_per_claim))
    kept = once(E.folded(ranked.groupBy("quote_id").agg(*[F.first(c).alias(c) for c in ("episode_id", "start_pos", "end_pos", "speaker", "ts")], F.first("quote").alias("text"), F.max("relevance").alias("score")), "episode_id"))
    moved = E.remapped(ranked.select("claim_id", "quote_id"), ranked, kept, "episode_id")
    texts = kept.select(F.col("quote_id").alias("kept_id"), F.col("text").alias("quote"), "score")
    links = entail(rerank(moved.join(texts, "kept_id").join(claims.select("claim_id", "claim"), "claim_id"))).where("relationship = 'SUPPORTS'")
    scores = links.groupBy("claim_id").agg(*[c.alias(n) for n, c in E.confidence(F.col("relevance")).items()])
    claims = claims.drop("embedding")
    return {"claims": claims.join(scores, "claim_id").where(F.col("final_confidence") >= s.least_confidence), "links": links}


def short(episodes: DataFrame, kind: str = "numbered", settings: Settings | None = None, embed=None) -> DataFrame:
    """Claims of each whole text, without chunks or quotes; with their vectors if ``embed`` is given."""
    s = settings or Settings()
    joined = Q.full_text(Q.parsed(episodes, kind), "episode_id").withColumnRenamed("full_text", "text")
    made = C.judged_claims(C.sentence_rows(joined)).where("reason = 'valid'").select("episode_id", F.col("sentence").alias("claim"), F.lit(s.short_confidence).alias("confidence"))
    return embed(made, "claim") if embed else made
