"""Stages of the whole extraction against plain ones."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from evidra.operators import claims as C
from evidra.operators import evidence as E
from evidra.operators import scorers as M
from evidra.operators import sequences as Q
from evidra.operators import similarity as V
from evidra.plans import extraction

SF = "/root/testdata/sf0.001"


def cosine(a, b):
    norm = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return max(0.0, min(1.0, sum(x * y for x, y in zip(a, b, strict=True)) / norm)) if norm else 0.0


def bag(text):
    return set(re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", text.lower())).split())


@pytest.mark.parametrize("block", [4, 4096])
def test_pairs_and_neighbours_within_groups(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = random.Random(2)
    rows = [(i, i % 3 if i % 7 else None, [float(rng.randrange(-2, 3)) for _ in range(4)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g long, v array<float>")
    known = [r for r in rows if r[1] is not None]
    want = {(a[0], b[0]) for a in known for b in known if a[0] < b[0] and a[1] == b[1] and cosine(a[2], b[2]) >= 0.6 - 1e-9}
    assert {(r.left_id, r.right_id) for r in V.similar_in_group(df, "g", "id", "v", 0.6).collect()} == want
    asked = df.where("id % 5 = 0").withColumnRenamed("id", "q")
    got = V.nearest_in_group(asked, df, "g", "id", "q", "v", 3).collect()
    for q, g, v in known:
        if q % 5 == 0:
            best = sorted((-round(cosine(v, b[2]), 6), b[0]) for b in known if b[1] == g)[:3]
            assert [(r.vec_id, round(r.score, 6)) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [(i, -s) for s, i in best]


def test_vectors_are_unit_counts(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (4, "c, C!")], "id long, text string")
    slots = {r.w: r.s for r in spark.createDataFrame([("a",), ("b",), ("c",)], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(64)).alias("s")).collect()}
    got = {r.id: r.embedding for r in M.embed(df).collect()}
    want = [0.0] * 64
    want[slots["a"]] += 2
    want[slots["b"]] += 1
    assert got[1] == pytest.approx([x / math.sqrt(sum(y * y for y in want)) for x in want], abs=1e-6)
    assert got[2] == got[3] == [0.0] * 64 and got[4][slots["c"]] == 1


def test_claims_of_an_episode_are_merged_as_plain_steps_do(spark):
    s = extraction.Settings(chunk_size=1000, chunk_overlap=100, chunk_margin=50)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 1500")
    episodes = docs.select(F.col("doc_id").alias("episode_id"), F.concat(F.lit("0 (5s):\n"), "text").alias("text"))
    joined = Q.full_text(Q.parsed(episodes, "numbered"), "episode_id")
    chunks = Q.chunks(joined, "full_text", 1000, 100, 50)
    rows = chunks.select(F.concat_ws(":", "episode_id", "chunk_no").alias("key"), "episode_id", "chunk_no", F.col("chunk_text").alias("text"))
    found = M.embed(C.valid_claims(rows, "key", "text", 10).select("episode_id", F.xxhash64("key", "pos").alias("id"), F.col("sentence").alias("claim")), "claim").collect()
    group = {r.id: r.id for r in found}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    merged = 0
    for a in found:
        for b in found:
            if a.id < b.id and a.episode_id == b.episode_id and cosine(a.embedding, b.embedding) >= 0.85 and len(bag(a.claim) & bag(b.claim)) / max(len(bag(a.claim)), 1) >= 0.9:
                merged += root(a.id) != root(b.id)
                group[root(b.id)] = root(a.id)
    best = {}
    for r in found:
        best.setdefault(root(r.id), []).append((len(r.claim), -r.id, r.claim))
    want = sorted(max(x)[2] for x in best.values())
    assert merged and sorted(r.claim for r in extraction.claims_of(episodes, "numbered", s).collect()) == want


def test_links_are_those_of_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) between 300 and 3000").limit(40)
    episodes = docs.select(F.col("doc_id").alias("episode_id"), F.concat(F.lit("0 (5s):\n"), "text").alias("text")).cache()
    s = extraction.Settings(chunk_size=1000, chunk_overlap=100, chunk_margin=50, least_relevance=0.5, candidates=5, quotes_per_claim=3)
    claims = M.classify_ads(extraction.claims_of(episodes, "numbered", s)).where("not (is_ad and ad_confidence >= 0.7)").collect()
    quotes = extraction.quotes_of(episodes, "numbered").collect()

    def share(claim, quote):
        return len(bag(claim) & bag(quote)) / len(bag(claim))

    ranked = []
    for c in claims:
        near = sorted((-round(cosine(c.embedding, q.embedding), 9), q.quote_id, q) for q in quotes if q.episode_id == c.episode_id)[:5]
        ranked += [(c, q, r) for r, _, q in sorted(((share(c.claim, q.quote), -i, q) for _, i, q in near), key=lambda x: (-x[0], -x[1])) if r >= 0.5][:3]
    moved = {}
    for episode in {c.episode_id for c, _, _ in ranked}:
        rows = {q.quote_id: {"quote_id": q.quote_id, "start_pos": q.start_pos, "end_pos": q.end_pos, "text": q.quote, "speaker": q.speaker, "ts": q.ts, "score": max(r for _, p, r in ranked if p.quote_id == q.quote_id)} for c, q, _ in ranked if c.episode_id == episode}
        for kept in E.fold_quotes(list(rows.values())):
            moved.update({i: (kept["quote_id"], kept["text"]) for i in kept["merged"]})
    want = {}
    for c in claims:
        texts = dict(moved[q.quote_id] for x, q, _ in ranked if x.claim_id == c.claim_id).values()
        scores = [share(c.claim, t) for t in texts if share(c.claim, t) >= 0.7]
        if scores:
            want[c.claim_id] = (len(scores), 0.65 * sum(scores) / len(scores) + 0.25 * max(scores) + 0.1 * min((len(scores) - 1) / 4, 1))
    got = {r.claim_id: (r.quote_count, r.final_confidence) for r in extraction.full(episodes, "numbered", s)["claims"].collect()}
    want = {i: x for i, x in want.items() if x[1] >= 0.3}
    assert len(want) > 3 and got.keys() == want.keys()
    assert all(got[i][0] == want[i][0] and got[i][1] == pytest.approx(want[i][1]) for i in want)
