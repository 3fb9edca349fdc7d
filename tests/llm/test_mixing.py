import pytest

from evidra.llm import mixing

from .helpers import same

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, copy string"


def test_oracle(spark):
    same(mixing.op9_mixing(spark, SF), mixing.ORACLE_SQL["op9_mixing"], SF)


def test_weights_are_met(spark):
    rows = [(i, "x" * 10, "big" if i % 10 else "small", "") for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed(df, {"big": 1.0, "small": 3.0}, ordered=False).groupBy("source").count().collect()
    got = {r.source: r["count"] for r in out}
    assert got["small"] == pytest.approx(3000, rel=0.08) and got["big"] == pytest.approx(1000, rel=0.12)  # small: mean 7.5, in two steps


def test_draws_do_not_depend_on_partitions_and_order_is_global(spark):
    df = spark.createDataFrame([(i, "text", f"s{i % 3}", "") for i in range(500)], SCHEMA)
    one = [tuple(r) for r in mixing.mixed(df.coalesce(1)).collect()]
    many = [tuple(r) for r in mixing.mixed(df.repartition(7)).collect()]
    assert one == many
    assert [r[-1] for r in one] == sorted(r[-1] for r in one)


def test_nulls_empties_repeats(spark):
    rows = [(None, "abc", None, "c"), (1, None, "a", "c"), (1, None, "a", "c"), (2, "", "b", "c"), (3, "long " * 90_000, "d", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mixed(df, size=3_000_000)
    assert out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    assert {r.source for r in out.collect()} <= {None, "d"}
    assert mixing.mixed(df.limit(0)).count() == 0
    assert mixing.mixed(df, {"zzz": 1.0}).count() == 0


def test_a_rate_beyond_the_largest_is_an_error_and_the_largest_is_met(spark):
    df = spark.createDataFrame([(1, "abc", "tiny", "c"), (2, "x" * 3000, "big", "c")], SCHEMA)
    with pytest.raises(Exception, match="the rate of source tiny is .* copies of each document"):
        mixing.mixed(df, size=1e12).count()
    n = mixing.mixed(df, {"tiny": 1.0}, size=2_700_000).count()  # 900,000 copies
    assert n == pytest.approx(900_000, rel=0.01)


def test_clashing_columns_stay(spark):
    df = spark.createDataFrame([(i, "text", "s", "kept") for i in range(50)], "doc_id long, text string, source string, __n string").withColumn("__source", mixing.F.lit("own"))
    out = mixing.mixed(df)
    assert out.columns == ["doc_id", "text", "source", "__n", "__source", "copy", "shuffle_key"]
    assert {(r["__n"], r["__source"]) for r in out.collect()} == {("kept", "own")}
