"""A memo over several runs, and rows that fail by themselves."""

import pytest
from pyspark.sql import functions as F

from evidra.operators import capture, memo, versions


@pytest.fixture
def counting(spark):
    """A scorer that adds up how many inputs it sees."""
    seen = spark.sparkContext.accumulator(0)

    def scorer(df):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return df.mapInArrow(run, df.schema).withColumn("size", F.coalesce(F.length("text"), F.lit(-1)))

    return scorer, seen


def table(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)


def test_only_new_inputs_are_scored(spark, tmp_path, counting):
    scorer, seen = counting
    path = f"file://{tmp_path}/m"
    one = memo.remembered(table(spark, ["a", "bb", "a", None, ""]), ["text"], scorer, path, now=1000)
    assert {(r.text, r.size) for r in one.rows.collect()} == {("a", 1), ("bb", 2), (None, -1), ("", 0)}
    assert (one.requests, one.misses, one.stored, seen.value) == (5, 4, 4, 4)
    two = memo.remembered(table(spark, ["bb", "ccc", "ccc", None]), ["text"], scorer, path, now=2000)
    assert (two.requests, two.misses, two.stored, seen.value) == (4, 1, 5, 5) and two.rows.count() == 4
    assert tuple(two.statistics().first()) == (4, 3, 1, 0.75, 0, 0, 5)
    assert len(versions.tables(spark, path)["memo"]["base"]) == 2  # the first answers were not written again
    none = memo.remembered(table(spark, ["a"]), ["text"], scorer, path, now=2001)
    assert none.misses == 0 and versions.newest(spark, path) == 2
    assert memo.remembered(table(spark, []), ["text"], scorer, path, now=2001).requests == 0


def test_age_check_and_size(spark, tmp_path, counting):
    scorer, seen = counting
    path = f"file://{tmp_path}/m"
    memo.remembered(table(spark, ["a", "bb"]), ["text"], scorer, path, hours=1, now=0)
    memo.remembered(table(spark, ["ccc"]), ["text"], scorer, path, hours=1, now=3000)
    late = memo.remembered(table(spark, ["a", "ccc"]), ["text"], scorer, path, hours=1, now=4000)
    assert (late.misses, late.expired, late.stored) == (1, 2, 2)  # a is too old, and bb goes with it
    checked = memo.remembered(table(spark, ["a", "ccc"]), ["text"], scorer, path, hours=1, now=4001, valid=F.col("size") < 3)
    assert (checked.misses, checked.expired) == (1, 1)
    many = memo.remembered(table(spark, [f"t{i}" for i in range(40)]), ["text"], scorer, path, hours=1, most=30, now=4002)
    assert (many.misses, many.evicted, many.stored) == (40, 12, 30) and many.rows.where("size is null").count() == 0
    left = memo.answers(spark, path).collect()
    assert len(left) == 30 and all(r.at == 4002_000 for r in left)
    youngest = memo.youngest(spark.createDataFrame([(f"{k:02x}", k % 3) for k in range(60)], "key string, at long"), 25)
    assert sorted((r.at, r.key) for r in youngest.collect()) == sorted(sorted(((k % 3, f"{k:02x}") for k in range(60)), key=lambda x: (-x[0], x[1]))[:25])


def halves(text):
    if text.startswith("bad"):
        raise ValueError(f"cannot read {text}")
    if text == "odd":
        return [{"word": 3, "n": "x"}]
    return [{"word": w, "n": len(w)} for w in text.split() if w != "none"]


def test_a_bad_row_fails_itself_only(spark):
    rows = [(1, "one two"), (2, "bad row"), (3, "none"), (4, None), (5, " "), (6, "odd"), (7, "three"), (None, "four"), (8, "bad " + "x" * 900)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(2)
    made, told = capture.batch(df, "id", "text", "word string, n long", halves)
    assert sorted((r.id or 0, r.word, r.n) for r in made.collect()) == [(0, "four", 4), (1, "one", 3), (1, "two", 3), (7, "three", 5)]
    got = {r.id: (r.status, r.reason, r.checked) for r in told.collect()}
    assert got[1] == ("ok", None, 2) and got[None] == ("ok", None, 1) and got[3] == ("skipped", "no claims", 0) and got[4] == got[5] == ("failed", "no transcript text", 0)
    assert got[2] == ("failed", "ValueError: cannot read bad row", 0) and got[6][0] == "failed" and len(got[8][1]) == capture.ERROR_CHARS
    with pytest.raises(ValueError, match="id 2: ValueError: cannot read bad row"):
        capture.batch(df.where("id < 4"), "id", "text", "word string, n long", halves, continue_on_error=False)
