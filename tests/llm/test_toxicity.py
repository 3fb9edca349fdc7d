import math
import random

import pytest

from evidra.llm import toxicity

SCHEMA = "doc_id long, text string, score string"


def corpus(n=400):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        words = [f"word{rng.choice('abcdefgh')}{rng.choice('xyz')}" for _ in range(30)]
        bad = i % 5 == 0
        if bad:
            words[3 + i % 7 : 4 + i % 7] = rng.sample(["blockhead", "grumbling", "nitwits", "nitwitted"], 2)
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_rows_are_found_and_clean_ones_left_alone(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    out = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    held = [i for i, r in out.items() if r.held_out]
    assert 50 < len(held) < 150
    bad = [i for i in held if i % 5 == 0]
    assert sum(out[i].predicted for i in bad) >= 0.9 * len(bad)
    assert sum(out[i].predicted for i in held if i % 5) == 0
    flipped = spark.createDataFrame([(i, q, 1 - t if out[i].held_out else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    again = {r.doc_id: r.score for r in toxicity.scored(docs, toxicity.fit(docs, flipped)).collect()}
    assert again == {i: r.score for i, r in out.items()}  # held-out labels have no say


def test_nulls_empties_repeats_and_no_labels(spark):
    rows, labels = corpus(100)
    docs = spark.createDataFrame([*rows, (None, None, "x"), (900, "", "x"), (901, "nitwits " * 60_000, "x"), (901, "nitwits " * 60_000, "x")], SCHEMA)
    marks = spark.createDataFrame([*labels, (7777, 1, 1), (900, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.scored(docs, toxicity.fit(docs, marks)).collect()
    assert len(out) == 104 and all(0 <= r.score <= 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    none = toxicity.scored(docs, toxicity.fit(docs, marks.limit(0))).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), marks)).count() == 0


def plain_em(rows, prior):
    """rows: (signed votes, label or -1); the same model, row by row and pair by pair."""
    m = len(rows[0][0])
    accuracy = weight = None
    for step in range(toxicity.ROUNDS):
        heard = [(v, y) for v, y in rows if y >= 0 or step]
        ps = []
        for v, y in heard:
            if y >= 0:
                ps.append(toxicity.SURE if y else 1 - toxicity.SURE)
                continue
            z = math.log(prior / (1 - prior))
            for j in range(m):
                a = min(max(accuracy[j], 0.02), 0.995)
                z += v[j] * weight[j] * math.log(a / (1 - a))
            ps.append(1 / (1 + math.exp(-z)))
        new_accuracy, rate = [], []
        for j in range(m):
            cast = sum(abs(v[j]) for v, _ in heard)
            right = sum(p if v[j] > 0 else 1 - p for (v, _), p in zip(heard, ps, strict=True) if v[j])
            new_accuracy.append(max((right + 0.5) / (cast + 1), 0.5))
            rate.append([sum((1 - p) * abs(v[j]) for (v, _), p in zip(heard, ps, strict=True)) / sum(1 - p for p in ps), sum(p * abs(v[j]) for (v, _), p in zip(heard, ps, strict=True)) / sum(ps)])
        n = len(heard)

        def within(i, j):
            return sum((1 - p) * (abs(v[i]) - rate[i][0]) * (abs(v[j]) - rate[j][0]) + p * (abs(v[i]) - rate[i][1]) * (abs(v[j]) - rate[j][1]) for (v, _), p in zip(heard, ps, strict=True)) / n

        scale = [math.sqrt(max(within(j, j), 1e-9)) for j in range(m)]
        new_weight = [1 / (1 + sum(max(within(i, j) / scale[i] / scale[j] - toxicity.ECHO, 0) / (1 - toxicity.ECHO) for i in range(m) if i != j)) for j in range(m)]
        done = step and max(abs(a - b) for a, b in zip(new_accuracy + new_weight, accuracy + weight, strict=True)) < toxicity.REST
        accuracy, weight = new_accuracy, new_weight
        if done:
            break
    return accuracy, weight


def test_label_model_equals_a_plain_one(spark):
    rng = random.Random(4)
    raw = []
    for _ in range(150):
        bad = rng.random() < 0.3
        votes = [j for j in range(5) if rng.random() < (0.5 if bad else 0.05)]
        votes += [5] if 4 in votes and rng.random() < 0.9 else []  # an echo
        votes += [6] if rng.random() < 0.3 else []  # a pattern that knows nothing
        raw.append((votes, int(bad) if rng.random() < 0.4 else None))
    width, used = 6 + len(toxicity.PATTERNS), list(range(6 + len(toxicity.PATTERNS)))
    df = spark.createDataFrame(raw, "votes array<int>, toxic int").groupBy("votes", "toxic").count().withColumnRenamed("count", "n").repartition(3)
    model = toxicity.fit_label_model(toxicity.moments_of(df, width, used), 0.3, toxicity.expectation(df.where("toxic is null"), width, used))
    rows = [(toxicity.signed(toxicity.matrix([v], width))[0].tolist(), -1 if t is None else t) for v, t in raw]
    accuracy, weight = plain_em(rows, 0.3)
    assert model.accuracy.tolist() == pytest.approx(accuracy, abs=1e-3) and model.weight.tolist() == pytest.approx(weight, abs=1e-3)
    assert model.weight[5] < 0.9 and model.weight[0] > 0.95


def test_patterns_vote_where_no_term_marks_toxic_texts(spark):
    def shout(i):
        return " AAAA BBBB CCCC".translate({65: 65 + i % 20, 66: 66 + i % 19, 67: 67 + i % 18})

    docs = spark.createDataFrame([(i, f"{i}" + (" ok" if i % 3 else shout(i)), "x") for i in range(240)], SCHEMA)
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    out = toxicity.scored(docs, toxicity.fit(docs, marks)).collect()
    assert min(r.score for r in out if r.doc_id % 3 == 0) > max(r.score for r in out if r.doc_id % 3)


def test_one_id_on_very_many_rows_brings_no_more_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 50)
    rows, labels = corpus(60)
    docs = spark.createDataFrame([*rows, *[(0, "nitwits here", "x")] * 3000], SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    taken = []
    fit_linear = toxicity.fit_linear
    monkeypatch.setattr(toxicity, "fit_linear", lambda x, p: taken.append(len(x)) or fit_linear(x, p))
    out = toxicity.scored(docs, toxicity.fit(docs, marks))
    assert out.count() == 3060 and taken == [50]
    assert len({r.score for r in out.where("doc_id = 0 and score > 0").collect()}) <= 2
