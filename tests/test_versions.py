"""Versions: conflicts, rollback, updates laid over files that stay, compaction."""

import threading

import pytest
from pyspark.sql import functions as F

from evidra.operators import versions as V


@pytest.fixture
def store(tmp_path):
    return f"file://{tmp_path}/store"


def test_versions_and_rollback(spark, store):
    assert V.newest(spark, store) == 0 and V.tables(spark, store) == {}
    assert V.write({"claims": spark.range(3), "quotes": spark.range(2)}, store) == 1
    assert V.write({"claims": spark.range(5)}, store) == 2
    assert (V.read(spark, store, "claims").count(), V.read(spark, store, "quotes").count()) == (5, 2)
    assert V.read(spark, store, "claims", 1).count() == 3
    assert V.rollback(spark, store, 1) == 3 and V.read(spark, store, "claims").count() == 3
    assert V.append({"claims": spark.range(10, 12)}, store) == 4 and V.read(spark, store, "claims").count() == 5
    assert [(r.version, r.after, r.tables) for r in V.history(spark, store).orderBy("version").collect()] == [(k, k - 1, ["claims", "quotes"]) for k in (1, 2, 3, 4)]
    with pytest.raises(LookupError):
        V.rollback(spark, store, 9)
    with pytest.raises(LookupError):
        V.read(spark, store, "links")


def test_a_failed_table_leaves_no_version(spark, store):
    """An error while one of several tables is written rolls back all of them."""
    V.write({"claims": spark.range(3), "links": spark.range(1)}, store)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("database error"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="database error"):
        V.write({"claims": spark.range(9), "links": broken}, store)
    assert V.newest(spark, store) == 1 and V.read(spark, store, "claims").count() == 3


def test_two_writers_at_once(spark, store):
    V.write({"claims": spark.range(1)}, store)
    with pytest.raises(V.Conflict):  # both saw version 1, and one was first
        V.write({"claims": spark.range(2)}, store, after=1)
        V.write({"claims": spark.range(7)}, store, after=1)
    assert V.read(spark, store, "claims").count() == 2
    wins, together = [], threading.Barrier(6)

    def put(k):
        together.wait()
        try:
            wins.append((V.commit(spark, store, {"t": {"base": [str(k)], "updates": [], "schema": "{}"}}, 2), k))
        except V.Conflict:
            pass

    threads = [threading.Thread(target=put, args=(k,)) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(wins) == 1 and V.tables(spark, store)["t"]["base"] == [str(wins[0][1])]

    def add(k):
        V.transact(spark, store, lambda seen: V.append({"claims": spark.range(k, k + 1)}, store, seen), tries=20)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(10, 14)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.id for r in V.read(spark, store, "claims").collect()) == [0, 1, 10, 11, 12, 13]


def test_updates_over_files_that_stay(spark, store):
    rows = spark.range(100).select("id", F.array(F.col("id") * 1.0, F.lit(0.0)).alias("v"), F.lit("a").alias("t")).repartitionByRange(10, "id")
    V.write({"claims": rows}, store)
    before = set(V.read(spark, store, "claims").select("_metadata.file_path").distinct().toPandas()["file_path"])
    new = spark.createDataFrame([(3, [7.0, 7.0]), (3, [8.0, 1.0]), (4, None), (500, [1.0, 1.0]), (None, [2.0, 2.0])], "id long, v array<double>")
    assert V.update(new, store, "claims", "id") == 2
    assert [r.id for r in V.lacking(new, store, "claims", "id").collect()] == [500]
    V.update(spark.createDataFrame([(3, "b"), (50, "c")], "id long, t string"), store, "claims", "id")
    V.update(spark.createDataFrame([(50, "d")], "id long, t string"), store, "claims", "id")

    def state(version=None):
        return {r.id: (r.v, r.t) for r in V.read(spark, store, "claims", version).collect()}

    want = {k: ([k * 1.0, 0.0], "a") for k in range(100)} | {3: ([8.0, 1.0], "b"), 4: (None, "a"), 50: ([50.0, 0.0], "d")}
    assert state() == want and state(1)[3] == ([3.0, 0.0], "a") and state(2)[50][1] == "a"
    assert V.compact(spark, store, "claims") == 5
    entry = V.tables(spark, store)["claims"]
    assert entry["updates"] == [] and state() == want
    stay = before & set(entry["base"])
    assert len(before) == 10 and len(stay) == 8  # ids 3 and 4 lie in one file, 50 in another
    assert V.compact(spark, store, "claims") == 5
    assert V.update(spark.createDataFrame([(1, "z")], "id long, t string"), store, "claims", "id") == 6
    assert V.append({"claims": spark.createDataFrame([(1, [0.0], "new")], "id long, v array<double>, t string")}, store) == 8
    assert sorted(r.t for r in V.read(spark, store, "claims").where("id = 1").collect()) == ["new", "z"]
    assert V.rollback(spark, store, 1) == 9 and state()[3] == ([3.0, 0.0], "a")
