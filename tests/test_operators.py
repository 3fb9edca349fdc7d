"""Small cases with results worked out by hand, and plain-Python versions on random inputs."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.operators import claims, evidence, metrics, scorers, selection, sequences, similarity
from evidra.plans import extraction
from evidra.sources import files
from evidra.streaming import incremental


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(expr.alias("r")).first().r


def test_sentences_and_windows(spark):
    df = spark.createDataFrame([(1, "A b. C d! E"), (2, " . x"), (3, "")], "id long, text string")
    got = {r.id: list(r.s) for r in df.select("id", X.sentences(F.col("text")).alias("s")).collect()}
    assert got == {1: ["A b.", "C d!", "E"], 2: ["x"], 3: []}
    assert [(r.window_no, r.window_text) for r in claims.sentence_windows(df.where("id = 1")).collect()] == [(0, "A b. C d!"), (1, "C d! E"), (2, "E")]


@pytest.mark.parametrize(
    ("claim", "reason"),
    [("one two three four", "short"), (" ".join(["w"] * 41), "long"), ("all small words are here now", "vague"), ("they say it may rain today", "valid"), ("he met Anna on the way", "valid"), ("in 1999 it was so cold", "valid"), ("he and The end of it", "vague")],
)
def test_claim_reasons(spark, claim, reason):
    assert one(spark, X.claim_reason(F.col("t")), t=("string", claim)) == reason


def test_questions_and_quotes(spark):
    df = spark.createDataFrame([("Why it works.",), ("It works?",), ("What happened next was huge.",), ("x" * 49,), ("please use code NOW " + "y" * 40,), ("z" * 60,)], "t string")
    rows = df.select(X.is_question(F.col("t")).alias("q"), X.quote_reason(F.col("t")).alias("r")).collect()
    assert [r.q for r in rows[:3]] == [True, True, False]
    assert [r.r for r in rows[3:]] == ["Too short", "Contains promo code", "valid"]


def test_scalars(spark):
    a, b = F.col("a"), F.col("b")
    vec = "array<double>"
    assert one(spark, X.cosine(a, b), a=(vec, [1.0, 0.0]), b=(vec, [1.0, 0.0])) == 1
    assert one(spark, X.cosine(a, b), a=(vec, [1.0, 0.0]), b=(vec, [-1.0, 0.0])) == 0
    assert one(spark, X.cosine(a, b), a=(vec, [0.0, 0.0]), b=(vec, [1.0, 0.0])) == 0
    assert one(spark, X.l2(a, b), a=(vec, [3.0, 0.0]), b=(vec, [0.0, 4.0])) == 5
    assert one(spark, X.jaccard(X.token_set(a), X.token_set(b)), a=("string", "A b, c!"), b=("string", "a B d")) == 0.5
    spans = {"p": ("long", 0), "q": ("long", 10), "r": ("long", 5), "s": ("long", 25)}
    assert one(spark, X.span_overlap(*map(F.col, "pqrs")), **spans) == 0.5
    got = spark.createDataFrame([(" Yes ", "0.9"), ("maybe", "abc"), (None, None)], "a string, b string").select(X.lenient_bool(a), X.lenient_float(b)).collect()
    assert [tuple(r) for r in got] == [(True, 0.9), (False, 0.5), (False, 0.5)]


def test_tolerant_json(spark):
    texts = ['["a", "b"]', "['a', 'b']", ', ["a", "b"]', '[["a", "b"]]', "So:\n- a\n- b", 'It is ["a", "b"] then']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(X.json_list(F.col("t"))).collect()] == [["a", "b"]] * len(texts)
    cells = spark.createDataFrame([("a; b; etc",), ('[{"claim":"x"}]',), ("Only ads, no claims",), ('["p", "q"]',)], "t string")
    assert [r[0] for r in cells.select(X.claims_cell(F.col("t"))).collect()] == [["a", "b"], ["x"], [], ["p", "q"]]
    assert one(spark, X.fenced(F.col("t")), t=("string", 'x ```json\n{"a": 1}\n``` y')) == '{"a": 1}'


def test_split_repair(spark):
    cases = [(["Name", "s policy changed"], ["Name's policy changed"]), (["x" * 30, "s y"], ["x" * 30, "s y"]), (["a", "s b", "s c"], ["a's b", "s c"]), ([], []), (["s a"], ["s a"])]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c array<string>")
    got = {r.i: r.r for r in df.select("i", X.repaired_claims(F.col("c")).alias("r")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_stamps(spark):
    long = {"0s": 0, "30s": 30, "1m": 60, "2m 30s": 150, "10m 5s": 605, "1h": 3600, "1h 3m 21s": 3801, "1h 8m 9s": 4089, "2h 30m 15s": 9015, "invalid": 0, "": 0}
    df = spark.createDataFrame([(k,) for k in long], "t string")
    assert {r.t: r.s for r in df.select("t", X.seconds_long(F.col("t")).alias("s")).collect()} == long
    assert one(spark, X.seconds_short(F.col("t")), t=("string", "1h 2m")) == 0
    assert one(spark, X.seconds_clock(F.col("t")), t=("string", "1:02:45")) == 3765


def test_transcripts(spark):
    def parse(text, kind):
        rows = sequences.parsed(spark.createDataFrame([(1, text)], "id long, text string"), kind).orderBy("seg_no").collect()
        return [(r.speaker, r.seconds, r.clean_text) for r in rows]

    assert parse("0 (30s):\nAlpha.\n\n2 (1m 27s):\nBeta.", "numbered") == [("Speaker_0", 30, "Alpha."), ("Speaker_2", 87, "Beta.")]
    assert parse("Ann:\n[0:03] Alpha.\n\nBob:\n[1:02:45] Beta.", "named") == [("Ann", 3, "Alpha."), ("Bob", 3765, "Beta.")]
    assert parse("Head\nTime\n=====\nSpeaker A (2s):\nx\n\nSpeaker C (3m):\nz", "lettered") == [("Speaker_A", 2, "x"), ("Speaker_C", 180, "z")]
    assert parse("plain text", "numbered") == [("Speaker_Unknown", 0, "plain text")]
    assert parse("", "numbered") == []
    with pytest.raises(ValueError):
        parse("x", "xyz")
    segments = sequences.parsed(spark.createDataFrame([(1, "0 (1s):\na\n1 (2s):\nb")], "id long, text string"))
    assert sequences.full_text(segments, "id").first().full_text == "a\n\nb"


def test_chunks():
    assert sequences.chunk_spans("x" * 2500, 1000, 100) == [(0, 1000), (900, 1900), (1800, 2500), (2400, 2500)]
    assert sequences.chunk_spans("x" * 2500, 1000, 100, drop_contained_tail=True)[-1] == (1800, 2500)
    assert sequences.chunk_spans("abc") == [(0, 3)] and sequences.chunk_spans(" \n") == []
    text = "word. " * 500
    assert all(text[e - 2 : e] == ". " for _, e in sequences.chunk_spans(text, 1000, 100)[:-2])


def test_components_and_joins(spark):
    nodes = spark.range(7).select(F.col("id").alias("node"))
    links = spark.createDataFrame([(0, 1), (1, 3), (5, 4)], "u long, v long")
    got = {r.node: r.component for r in similarity.link_components(nodes, links).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 0, 4: 4, 5: 4, 6: 6}
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(1, 9))), i % 2) for i in range(80)]
    df = spark.createDataFrame(docs, "id long, text string, block int")
    for t in (0.3, 0.6, 1.0):
        sets = {i: (set(x.split()), b) for i, x, b in docs}
        want = {(i, j) for i in sets for j in sets if i < j and sets[i][1] == sets[j][1] and len(sets[i][0] & sets[j][0]) / len(sets[i][0] | sets[j][0]) >= t}
        assert {(r.left_id, r.right_id) for r in similarity.jaccard_join(df, "id", "text", t, "block").collect()} == want


def brute_fold(rows):
    def bag(t):
        return set(re.sub(r"[^\w\s]", "", t.lower()).split())

    kept = []
    for r in sorted(rows, key=lambda r: (r["start_pos"], r["quote_id"])):
        for k in kept:
            short = min(k["e"] - k["s"], r["end_pos"] - r["start_pos"])
            inter = max(0, min(k["e"], r["end_pos"]) - max(k["s"], r["start_pos"]))
            a, b = bag(k["t"]), bag(r["text"])
            if (short > 0 and inter >= 0.5 * short) or (r["start_pos"] - k["s"] < 20 and a and b and len(a & b) >= 0.8 * len(a | b)):
                k["s"], k["e"] = min(k["s"], r["start_pos"]), max(k["e"], r["end_pos"])
                k["t"] = k["t"] if len(k["t"]) >= len(r["text"]) else r["text"]
                k["m"].append(r["quote_id"])
                break
        else:
            kept.append({"s": r["start_pos"], "e": r["end_pos"], "t": r["text"], "m": [r["quote_id"]]})
    return sorted((k["s"], k["e"], k["t"], tuple(k["m"])) for k in kept)


def test_fold_against_plain_python():
    rng = random.Random(2)
    for _ in range(200):
        rows = []
        for i in range(rng.randrange(12)):
            s = rng.randrange(60)
            rows.append({"quote_id": i, "start_pos": s, "end_pos": s + rng.randrange(20), "text": " ".join(rng.choice("abcd") for _ in range(rng.randrange(5))), "score": rng.random(), "speaker": "x", "ts": s})
        got = sorted((k["start_pos"], k["end_pos"], k["text"], tuple(k["merged"])) for k in evidence.fold_quotes(rows))
        assert got == brute_fold(rows)


def test_confidence_and_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), *[(2, 1.0)] * 5, (3, None)], "id int, s double")
    got = {r.id: round(r.final_confidence, 6) for r in df.groupBy("id").agg(*[c.alias(n) for n, c in evidence.confidence(F.col("s")).items()]).collect()}
    assert got == {1: 0.8025, 2: 1.0, 3: 0.0}
    votes = spark.createDataFrame([(True, True), (True, False), (False, True), (False, False)], "p boolean, a boolean")
    r = metrics.confusion(votes, F.col("p"), F.col("a")).first()
    assert [r.accuracy, r.precision, r.recall, r.false_positive_rate, r.false_negative_rate] == [0.5] * 5
    assert set(metrics.confusion(votes.limit(0), F.col("p"), F.col("a")).first()) == {0, 0.0}


def test_validation_and_links(spark):
    sent = spark.createDataFrame([(i, False, False) for i in (1, 2, 3)], "id long, is_flagged boolean, is_verified boolean")
    said = spark.createDataFrame([(1, False), (9, False)], "id long, is_valid boolean")
    assert sorted(map(tuple, selection.validated(sent, said, "id").collect())) == [(1, True, True), (2, False, True), (3, False, True)]
    quotes = spark.createDataFrame([("c", 1, 2), ("d", 1, 2), ("e", 5, 6)], "claim string, s long, e long")
    stored = spark.createDataFrame([(1, 2, 70)], "s long, e long, quote_id long")
    assert sorted((r.claim, r.quote_id) for r in selection.get_or_create(quotes, stored, ["s", "e"], "quote_id").collect()) == [("c", 70), ("d", 70), ("e", 71)]


def test_scorers(spark):
    df = spark.createDataFrame([("a b c d", "a b c d e"), ("a b c d", "a z"), ("a b", "")], "claim string, quote string")
    assert [r.relationship for r in scorers.entail(df).collect()] == ["SUPPORTS", "NEUTRAL", "NEUTRAL"]
    unit = scorers.embed(df.select(F.col("claim").alias("text"))).first().embedding
    assert abs(sum(x * x for x in unit) - 1) < 1e-5
    ads = scorers.classify_ads(spark.createDataFrame([("order now and save",), ("the sky is blue",)], "claim string"))
    assert [r.is_ad for r in ads.collect()] == [True, False]
    top = scorers.keywords(spark.createDataFrame([(1, "apple apple pie"), (2, "pie")], "id long, t string"), "id", "t", ["pie"]).orderBy("id").first()
    assert top.keywords[0] == "apple" and top.topics == ["pie"]


def test_extraction(spark):
    text = "0 (5s):\nAnna Smith sold 300 houses in 2019 to the city of Bonn. She was glad.\n\n1 (9s):\nYes, Anna Smith sold 300 houses in 2019 to the city of Bonn and more."
    got = extraction.full(spark.createDataFrame([(1, text)], "episode_id long, text string"))
    rows = got["claims"].collect()
    assert rows and all(0.3 <= r.final_confidence <= 1 for r in rows)
    assert got["links"].where("relationship <> 'SUPPORTS'").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "ex.json").write_text(json.dumps({"examples": [{"claim_text": "a", "is_advertisement": True}, {"claim_text": "b", "is_advertisement": False}]}))
    assert files.examples(spark, f"file://{tmp_path}/ex.json", "claim_text:string,is_advertisement:boolean").count() == 2
    (tmp_path / "r.csv").write_text('﻿chunk_text,Claims,Maintainer\n"a ""b""\nc","x; y",me\n,z,me\nd,,me\n', encoding="utf-8")
    rows = files.reviewed(spark, f"file://{tmp_path}/r.csv").collect()
    assert [(r.chunk_text, r.claims, r.maintainer) for r in rows] == [('a "b"\nc', ["x", "y"], "me")]
    for i, made in enumerate(({"model_name": "m", "timestamp": "2025-01-01T00:00:00", "optimized": 0.5}, {"model_name": "n", "timestamp": "2025-02-01T00:00:00", "optimized": {"score": 0.9}})):
        (tmp_path / f"res{i}.json").write_text(json.dumps(made))
    (tmp_path / "res9.json").write_text("{broken")
    found = files.results(spark, f"file://{tmp_path}/res*.json")
    assert [r.model_name for r in found.collect()] == ["n", "m"]
    assert [(r.model_name, r["rank"]) for r in files.leaderboard(found, "2025-01-15").collect()] == [("n", 1)]


def test_streaming(spark, tmp_path):
    src = f"file://{tmp_path}/in"
    seen = []
    for n in (3, 2):
        spark.range(n).write.mode("append").parquet(src)
        q = incremental.process_new(spark, src, "id long", f"file://{tmp_path}/ck", lambda df, _: seen.append(df.count()))
        q.awaitTermination()
    assert seen == [3, 2]
