"""Records across splits of a file, against Spark's whole-file reader and a plain expression; small items beside them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from evidra.operators import evidence, ranking, scorers, selection
from evidra.operators import store as S
from evidra.sources import files, splits


@pytest.fixture
def tiny_splits(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def test_blocks_across_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(5)
    bits = ["<<", ">>", "\n", "some words of a log", " ", "x" * 40, "\n\n", "<", ">"]
    texts = {f"{k}.log": "".join(rng.choice(bits) for _ in range(60)) for k in range(8)}
    texts["none.log"] = "nothing here\n"
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    assert splits.lines(spark, f"file://{tmp_path}/*.log").select("file", "split").distinct().count() > 25
    got = {}
    for r in splits.blocks(spark, f"file://{tmp_path}/*.log", "<<", ">>", 4).collect():
        got.setdefault(r.file.rsplit("/", 1)[1], {})[r.n] = r.block
    want = {name: dict(enumerate(re.findall(r"(?s)<<(.*?)>>", text)[:4])) for name, text in texts.items()}
    assert got == {k: v for k, v in want.items() if v}


def test_csv_across_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(6)
    bits = ["a", "word", ",", "\n", '"', " ", "x" * 30, "\n\n", "é"]

    def cell():
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))
        return '"' + text.replace('"', '""') + '"' if rng.random() < 0.7 else text.translate({ord(c): None for c in ',"\n'}).strip() or "b"

    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("one,two,three\n" + "".join(f"{cell()},{cell()},{cell()}\n" for _ in range(60)))
    path = f"file://{tmp_path}/*.csv"
    assert splits.lines(spark, path).select("file", "split").distinct().count() > 60
    whole = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    mine = splits.csv(spark, path)
    assert mine.columns == whole.columns
    assert sorted(map(str, mine.collect())) == sorted(map(str, whole.collect())) and mine.count() == 180


def test_csv_odd_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿chunk_text,Claims,Maintainer\r\n"a, b","c ""d""",m\r\nshort\r\n\r\nw,x,y,z\r\n"open,1,2\r\n')
    rows = splits.csv(spark, f"file://{tmp_path}/a.csv", corrupt="bad").collect()
    assert rows[0].asDict() == {"chunk_text": "a, b", "Claims": 'c "d"', "Maintainer": "m", "bad": None}
    assert [r.bad is not None for r in rows] == [False, True, True, True] and rows[1].Claims is None
    assert splits.csv_records(spark, f"file://{tmp_path}/a.csv").where("odd").count() == 1


def test_results_by_metric(spark, tmp_path):
    told = ['{"model_name": "a", "optimized": {"score": 0.5, "f1": 0.9}}', '{"model_name": "b", "optimized": {"score": 0.6}, "improvement": {"f1": 0.95}}', '{"model_name": "c", "optimized": 0.7, "improvement": 0.1}', '{"model_name": "d"}', '{"model_name": "e", "improvement": 0.8}', "no json"]
    for k, text in enumerate(told):
        (tmp_path / f"{k}.json").write_text(text)
    ranks = {m: [(r.model_name, r.sort_key) for r in files.leaderboard(files.results(spark, f"file://{tmp_path}/*", metric=m)).orderBy("rank").collect()] for m in ("f1", "score")}
    assert ranks["f1"] == [("b", 0.95), ("a", 0.9), ("c", 0.7), ("d", 0.0), ("e", 0.0)]
    assert ranks["score"] == [("e", 0.8), ("b", 0.6), ("a", 0.5), ("c", 0.1), ("d", 0.0)]


def test_ranks_of_sparse_keys(spark, monkeypatch):
    monkeypatch.setattr(ranking, "GROUPS", 8)
    rng = random.Random(1)
    keys = [rng.randrange(-(10**12), 10**12) for _ in range(300)] + [5] * 20 + [None] * 3
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    got = {r.i: r.rank for r in ranking.ordered_rank(df, "k", ["i"], "rank").collect()}
    want = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0, i))
    assert got == {i: n for n, i in enumerate(want, 1)}
    assert ranking.ordered_rank(df.where("k is null"), "k", ["i"], "rank").count() == 3


def test_added_links_are_counted(spark):
    stored = spark.createDataFrame([(1, 5, "old")], "claim_id long, quote_id long, kind string")
    new = spark.createDataFrame([(1, 5, "new"), (1, 6, "new"), (1, 6, "new"), (2, 5, "new")], stored.schema)
    whole, added, n = selection.merge_links(new, stored, ["claim_id", "quote_id"])
    assert n == 2 == added.count() and sorted(map(tuple, whole.collect())) == [(1, 5, "old"), (1, 6, "new"), (2, 5, "new")]


def test_entailment_answers(spark):
    rows = [('{"relationship": "supports", "reasoning": "it says so", "confidence": 0.95}', None), ('{"relationship": "RELATED"}', None), ('{"relationship": "NEUTRAL", "confidence": "high"}', None), ('{"relationship": "MAYBE"}', None), ("no json", None), (None, "timeout"), ('{"relationship": "SUPPORTS", "confidence": 7}', None)]
    made = scorers.entailment_answers(spark.createDataFrame(rows, "answer string, failed string"), error="failed").collect()
    assert [(r.relationship, r.entailment_score) for r in made] == [("SUPPORTS", 0.95), ("RELATED", 0.8), ("NEUTRAL", 0.8), ("NEUTRAL", 0.0), ("NEUTRAL", 0.0), ("NEUTRAL", 0.0), ("SUPPORTS", 1.0)]
    assert made[0].reasoning == "it says so" and made[5].reasoning == "Error during validation: timeout"


def test_merged_claims_unite_their_quotes(spark):
    claims = spark.createDataFrame([(1, 10, "short claim", 0.9, 100), (2, 10, "a longer claim", 0.9, 101), (3, 10, "the longest claim of all", 0.5, None), (4, 11, "alone", 0.1, 7)], "claim_id long, topic long, claim string, confidence double, chunk_id long")
    quotes = spark.createDataFrame([(20, 0, 50, "alpha beta gamma", 0.5), (21, 10, 60, "alpha beta gamma delta", 0.7), (22, 900, 950, "far away", 0.4)], "quote_id long, start_pos long, end_pos long, text string, score double").selectExpr("*", "'s' AS speaker", "cast(1 AS bigint) AS ts")
    links = spark.createDataFrame([(1, 20), (2, 21), (2, 22), (3, 22)], "claim_id long, quote_id long")
    whole, kept = evidence.merged_claims(claims, links, quotes, "topic")
    got = {r.topic: (r.claim_id, r.claim, r.confidence, r.chunk_id, r.chunks, r.merged_from, r.quotes_before, r.quotes_after) for r in whole.collect()}
    assert got == {10: (2, "a longer claim", 0.9, 101, [100, 101], 3, 4, 2), 11: (4, "alone", 0.1, 7, [7], 1, 0, 0)}
    assert sorted((r.quote_id, r.end_pos, sorted(r.merged)) for r in kept.collect()) == [(20, 60, [20, 21]), (22, 950, [22, 22])]


def test_a_database_table_in_ranges(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(100).select(F.col("id").alias("EPISODE"), (F.col("id") % 7).alias("PODCAST")).write.jdbc(url, "episodes", properties=driver)
    got = S.jdbc(spark, url, "episodes", "EPISODE", 0, 100, 4, **driver)
    assert got.rdd.getNumPartitions() == 4 and got.count() == 100 and got.where("PODCAST = 3").count() == 14


def test_claims_of_answers(spark):
    answers = ['["Anna Miller", "s firm in Boston grew by 5 percent", "too short"]', "- The market fell by 3 percent today", "nothing", None, '["The market fell by 3 percent today"]']
    df = spark.createDataFrame([(i, a, "timeout" if i == 4 else None) for i, a in enumerate(answers)], "id int, answer string, failed string")
    from evidra.operators import claims

    got = [(r.id, r.sentence) for r in claims.claims_from_answers(df, "id", error="failed").collect()]
    assert sorted(got) == [(0, "Anna Miller's firm in Boston grew by 5 percent"), (1, "The market fell by 3 percent today")]
    assert claims.claims_from_answers(df, "id").count() == 3
