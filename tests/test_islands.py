"""Folding in islands against folding whole episodes."""

import random

import pytest

from evidra.operators import evidence

SCHEMA = "episode_id long, quote_id long, start_pos long, end_pos long, text string, score double, speaker string, ts long"


def quotes(seed, n, words, reach):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        start = rng.randrange(reach)
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(9)))
        rows.append((rng.choice([1, 1, 1, 2, None]), k, start, start + rng.randrange(-3, 60), text, rng.random(), rng.choice("ab"), start))
    return rows


def plain(rows):
    found = set()
    for g in (1, 2, None):
        part = [dict(zip([x.split()[0] for x in SCHEMA.split(", ")], r, strict=True)) for r in rows if r[0] == g]
        found |= {(g, r["quote_id"], r["start_pos"], r["end_pos"], r["text"], r["score"], r["speaker"], r["ts"], tuple(r["merged"])) for r in evidence.fold_quotes(part)}
    return found


@pytest.mark.parametrize(("seed", "n", "size", "reach"), [(1, 300, 400, 400_000), (2, 300, 6, 400_000), (3, 200, 3000, 3000), (4, 400, 3000, 2_000_000), (5, 60, 4, 100_000)])
def test_islands_change_nothing(spark, monkeypatch, seed, n, size, reach):
    rows = quotes(seed, n, [f"w{k}" for k in range(size)], reach)
    rows += [(1, 10_000 + k, 7 * k, 7 * k + 5, "the very same words again and again", 0.5, "a", k) for k in range(0, 6)]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(evidence, "FOLDED_AT_ONCE", 20)
    monkeypatch.setattr(evidence, "STRETCH", 5000)
    got = [tuple(r[:-1]) + (tuple(r.merged),) for r in evidence.folded(df, "episode_id").collect()]
    assert set(got) == plain(rows) and len(got) == len(set(got))


def test_one_episode_in_many_islands(spark, monkeypatch):
    """A long episode is cut up; a long quote bridges what it reaches over, and quotes less than 20 characters apart go together."""
    rows = [(1, k, 100 * k, 100 * k + 60, f"quote number {k} says thing {k * 7} of {k * 11}", 0.5, "a", k) for k in range(3000)]
    far = [(1, 5000, 100 * 700 + 70, 100 * 800 + 10, "a bridge of words", 0.5, "a", 0), (1, 5001, 100 * 5000, 100 * 5000, "a point", 0.5, "a", 0), (1, 5002, 100 * 5000 + 19, 100 * 5000 + 19, "a point", 0.5, "a", 0), (1, 5003, 100 * 5000 + 40, 100 * 5000 + 41, "a point", 0.5, "a", 0)]
    df = spark.createDataFrame(rows + far, SCHEMA)
    made = evidence.islands(df, "episode_id")
    sizes = sorted(r["count"] for r in made.groupBy("island").count().collect())
    assert sum(sizes) == 3004 and sizes[-2:] == [2, 101] and len(sizes) == 2900 + 1 + 2
    monkeypatch.setattr(evidence, "FOLDED_AT_ONCE", 10)
    got = [tuple(r[:-1]) + (tuple(r.merged),) for r in evidence.folded(df, "episode_id").collect()]
    assert set(got) == plain(rows + far) and any(len(r[-1]) == 2 and r[1] == 5001 for r in got)


def test_like_quotes_far_apart_stay_apart():
    """Words count within 20 characters only; the entailment of the higher score is kept."""
    one = {"quote_id": 1, "start_pos": 0, "end_pos": 10, "text": "the very same words", "score": 0.5, "speaker": "a", "ts": 1, "rel": "RELATED"}
    two = one | {"quote_id": 2, "start_pos": 19, "end_pos": 40, "score": 0.9, "speaker": "b", "rel": "SUPPORTS"}
    far = one | {"quote_id": 3, "start_pos": 50, "end_pos": 60}
    kept = evidence.fold_quotes([far, two, one], carried=("rel",))
    assert [(k["quote_id"], k["merged"], k["rel"], k["speaker"], k["end_pos"]) for k in kept] == [(1, [1, 2], "SUPPORTS", "a", 40), (3, [3], "RELATED", "a", 60)]
