"""The stage's SimHash step, and what travels in its last join."""

import random

import numpy as np

import corpus_pipeline
from evidra.llm import near

from .test_near import brute_kept, edited


def test_trees_link_close_texts_without_buckets(spark, monkeypatch):
    """With no candidates from buckets, the BK-trees of the fingerprints' shards still find texts that hardly differ."""
    monkeypatch.setattr(near, "_stars", lambda whole: spark.createDataFrame([], "x long, y long"))
    rng = random.Random(4)
    items = []
    for k in range(6):
        words = [f"w{k}x{rng.randrange(10**6)}" for _ in range(6000)]
        items += [" ".join(words), " ".join(edited(rng, words, 1)), " ".join(words).upper()]
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "")
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept(list(enumerate(items))) == [0, 3, 6, 9, 12, 15]


def test_what_trees_link_is_confirmed(spark, monkeypatch):
    """Alike fingerprints of unlike texts join nothing."""
    monkeypatch.setattr(near.simhash, "links", lambda fps: fps.alias("a").crossJoin(fps.alias("b")).where("a.fp > b.fp").selectExpr("a.fp u", "b.fp v"))
    rng = random.Random(6)
    items = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(20)]
    items += [" ".join(edited(rng, t.split(), 2)) for t in items[:9]]
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near.deduplicated(df).collect()) == brute_kept(list(enumerate(items)))


def test_set_fingerprint_is_the_majority_of_bits():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 3000):
        hashes = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        want = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > len(hashes))
        assert near.set_fingerprint(hashes) & (1 << 64) - 1 == want


def test_bands_do_not_depend_on_the_shingles_taken_at_once(monkeypatch):
    hashes = np.unique(np.random.default_rng(3).integers(0, 2**64, 2500, dtype=np.uint64))
    keys = near.band_keys(hashes).tolist()
    monkeypatch.setattr(near, "SHINGLES_AT_ONCE", 7)
    assert near.band_keys(hashes).tolist() == keys


def test_texts_that_stay_do_not_travel(spark):
    """The filter lets every lost row through, and few others."""
    whole = spark.range(20_000).withColumnRenamed("id", "__row")
    lost = whole.where("__row % 100 = 3")
    marked, doubtful = near._maybe(whole, lost, "__row")
    found = {r["__row"] for r in marked.where(doubtful).collect()}
    assert {r["__row"] for r in lost.collect()} <= found and len(found) < 4000
    assert marked.where(~doubtful).count() == 20_000 - len(found)
