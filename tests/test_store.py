"""Stored tables, lookups, batches and formats that no query over the driver's tables covers."""

import pytest
from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.operators import reporting as R
from evidra.operators import sequences as Q
from evidra.operators import store as S
from evidra.sources import files


def test_lookup_of_one_id(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id long, first string, second string")
    assert S.one(df, "id", 1, ["first", "second"])["first"] == "a"
    with pytest.raises(LookupError):
        S.one(df, "id", 9)
    with pytest.raises(ValueError, match="no transcript"):
        S.one(df, "id", 2, ["first", "second"])


def test_commit_shows_whole_versions_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    claims = spark.createDataFrame([(1, "x")], "claim_id long, claim string")
    quotes = spark.createDataFrame([(5, "q")], "quote_id long, quote string")
    links = spark.createDataFrame([(1, 5), (1, 5)], "claim_id long, quote_id long")
    S.save(claims, quotes, links, path)
    assert S.current(spark, path, "links").count() == 1 and S.current(spark, path, "claims").first()["embedding"] is None
    S.save(claims.unionByName(claims.withColumn("claim_id", F.lit(2).cast("long"))), quotes, links, path)
    assert S.current(spark, path, "claims").count() == 2
    claims.write.parquet(f"{path}/lost-run/claims")  # left by a run that never committed
    assert S.current(spark, path, "claims").count() == 2


def test_probe_and_readiness(spark):
    assert S.reachable(spark)
    answers = iter([False, False, True])
    S.until_ready(lambda: next(answers), wait=0)
    with pytest.raises(TimeoutError):
        S.until_ready(lambda: False, tries=2, wait=0)


def test_updates_and_ids(spark):
    table = spark.createDataFrame([(1, 0.5), (2, 0.5), (None, 0.1)], "id long, v double")
    new, lost = S.updated(table, spark.createDataFrame([(1, 0.9), (1, 0.7), (7, 0.2)], "id long, v double"), "id", "v")
    assert sorted(new.collect(), key=str) == sorted([(1, 0.9), (2, 0.5), (None, 0.1)], key=str) and [r.id for r in lost.collect()] == [7]
    rows = spark.createDataFrame([(k, i) for k in (5000, 3, None) for i in (2, 1)], "doc long, no long")
    ranked = {(r.doc, r.no): r.chunk_id for r in S.numbered(rows, "doc", "no", after=10).collect()}
    assert ranked == {(3, 1): 11, (3, 2): 12, (5000, 1): 13, (5000, 2): 14, (None, 1): 15, (None, 2): 16}


def test_batches(spark):
    df = spark.createDataFrame([(1, "one two"), (2, " "), (3, "none"), (4, None)], "id long, text string")

    def step(good):
        return good.where("text like 'one%'")

    made, results = R.run_batch(df, step, "id")
    assert [r.id for r in made.collect()] == [1]
    assert {r.id: (r.status, r.reason) for r in results.collect()} == {1: ("ok", None), 2: ("failed", "no transcript text"), 3: ("skipped", "no claims"), 4: ("failed", "no transcript text")}
    with pytest.raises(ValueError, match="no transcript text"):
        R.run_batch(df, step, "id", continue_on_error=False)
    assert R.run_one(df, step, "id", 1).count() == 1
    with pytest.raises(ValueError, match="positive"):
        R.run_one(df, step, "id", 0)


def test_formats(spark):
    row = spark.range(1).select(R.duration(F.lit(185)), R.duration(F.lit(7805)), R.duration(F.lit(9.9)), R.comparison(F.lit(0.25), F.lit(0.375)), R.comparison(F.lit(0.5), F.lit(0.25)), R.podcast_name(F.lit(7))).first()
    assert tuple(row) == ("3m 5s", "2h 10m", "9s", "0.250 → 0.375 (+0.125)", "0.500 → 0.250 (-0.250)", "Podcast 7")
    assert R.run_folder(spark, "claims").startswith("models/claims_20")


def test_guest_answers(spark):
    answers = ['{"guests": []}', '{"guests": [{"name": "A", "urls": ["u"]}]}', '{"guests": [{"name": "A", "urls": "u"}]}', '{"people": 1}', "no json", None]
    got = [r.g for r in spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string").orderBy("i").select(R.guests(F.col("a")).alias("g")).collect()]
    assert got[0] == [] and got[1][0]["urls"] == ["u"] and got[2:] == [None] * 4


def test_slices_and_choice(spark):
    df = spark.createDataFrame([(" ab cd ", 0, 4), (" ab cd ", 3, 2), (" ab cd ", 2, 99), (" ab cd ", -1, 2)], "t string, a int, b int")
    assert [r[0] for r in df.select(Q.slice_text(F.col("t"), F.col("a"), F.col("b"))).collect()] == ["ab", "", "", ""]
    three = spark.createDataFrame([(None, "", "c"), ("", "b", "c"), (None, None, None)], "a string, b string, c string")
    assert [tuple(r) for r in three.select(*Q.chosen_transcript(*map(F.col, "abc"))).collect()] == [("c", "lettered"), ("b", "named"), (None, None)]


def test_rules_on_examples_written_out(spark):
    """A few claims with the verdict that the rules must give, whatever lists the queries' SQL shares with them."""
    claims = {
        "He said the market grew by 5 percent": "pronoun",
        "It's about many things in general": None,
        "Revenue of the firm rose to 3 billion dollars in 2021": "none",
    }
    got = {r.c: r.i for r in spark.createDataFrame([(c,) for c in claims], "c string").select("c", F.coalesce(X.quality_issue(F.col("c")), F.lit("none")).alias("i")).collect()}
    assert all(got[c] == want for c, want in claims.items() if want)
    reasons = {"Too short claim": "short", "they never really said so there": "vague", "We saw 3 of them there": "valid", "we met in may last year": "valid", "so then Anna went home": "valid", " ".join(["word"] * 41): "long"}
    got = {r.c: r.i for r in spark.createDataFrame([(c,) for c in reasons], "c string").select("c", X.claim_reason(F.col("c")).alias("i")).collect()}
    assert got == reasons


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("chunk_text,Claims\nx,y\nx,y,z\n,\n")
    row = files.csv_profile(spark, f"file://{tmp_path}/a.csv", ["chunk_text", "Claims"]).first()
    assert row.n_rows == 3 and row.n_ragged == 1 and row.n_chunk_text == 2
    (tmp_path / "run.log").write_text("a <<one>> b <<two\nlines>> <<three>> <<four>>")
    assert [r.block for r in files.log_blocks(spark, f"file://{tmp_path}/run.log", "<<", ">>").orderBy("n").collect()] == ["one", "two\nlines", "three"]
    df = spark.range(3)
    first, second = files.snapshot(df, f"file://{tmp_path}/s"), files.snapshot(df.limit(1), f"file://{tmp_path}/s")
    assert first != second and files.latest_snapshot(spark, f"file://{tmp_path}/s").count() == 1
    files.write_result(spark, {"model_name": "m", "optimized": 0.5, "timestamp": "2024-01-01"}, f"file://{tmp_path}/r")
    back = files.results(spark, f"file://{tmp_path}/r/*").first()
    assert back.model_name == "m" and back.optimized == 0.5
