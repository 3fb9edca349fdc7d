"""The stored search index: exact results, recall of a few probes, appended rows, files read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from evidra.operators import index as I
from evidra.operators import metric, scorers, similarity, versions


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(21)
    centres = rng.normal(0, 1, (40, 16))
    return centres[rng.integers(0, 40, 1500)] + rng.normal(0, 0.35, (1500, 16))


@pytest.fixture(scope="module")
def store(spark, points, tmp_path_factory):
    monkey = pytest.MonkeyPatch()
    monkey.setattr(metric, "CELL", 40)
    monkey.setattr(metric, "PART", 30)
    path = f"file://{tmp_path_factory.mktemp('index')}/i"
    rows = spark.createDataFrame([(i, x.tolist(), f"t{i}", "v") for i, x in enumerate(points)], "no long, e array<double>, text string, id string").repartition(4)
    assert I.build(rows.where("no < 900"), path, "no", "e") == 1
    yield path, rows
    monkey.undo()


def best(points, q, k, upto):
    u = points / np.linalg.norm(points, axis=1, keepdims=True)
    score = np.clip(u[:upto] @ u[q], 0, 1)
    return sorted(range(upto), key=lambda i: (-round(score[i], 9), i))[:k]


def asked(rows):
    return rows.where("no % 30 = 0").select("no", "e")


def listed(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    return {q: [i for _, i in sorted(v)] for q, v in got.items()}


def test_exact_and_appended(spark, store, points):
    path, rows = store
    files = versions.tables(spark, path)["lists"]["base"]
    got = listed(I.search(spark, path, asked(rows), "no", "e", 10))
    assert got == {q: best(points, q, 10, 900) for q in range(0, 1500, 30)}
    assert I.append(rows.where("no >= 900"), path, "no", "e") == 2
    assert versions.tables(spark, path)["lists"]["base"][:1] == files  # what was there is not rewritten
    found = I.search(spark, path, asked(rows), "no", "e", 10)
    assert listed(found) == {q: best(points, q, 10, 1500) for q in range(0, 1500, 30)}
    assert all(r.text == f"t{r.vec_id}" for r in found.select("vec_id", "text").collect())
    stats = I.statistics(spark, path).first()
    assert stats.n_rows == 1500 and stats.n_lists > 15
    assert I.rows_of(spark, path).count() == 1500
    assert listed(I.search(spark, path, asked(rows), "no", "e", 10, data=False)) == listed(found)


def test_recall_of_probes_and_pruning(spark, store, points, capsys):
    path, rows = store
    upto = I.statistics(spark, path).first().n_rows
    recall = {}
    for probes in (1, 4, 8):
        got = listed(I.search(spark, path, asked(rows), "no", "e", 10, probes, data=False))
        recall[probes] = np.mean([len(set(got[q]) & set(best(points, q, 10, upto))) / 10 for q in got])
    assert recall[1] <= recall[4] <= recall[8] and recall[8] >= 0.9
    near = versions.read(spark, path, "lists").where(F.col("cell").isin([0, 1]))
    near.explain("formatted")
    told = capsys.readouterr().out
    assert told.count("PartitionFilters: [cell") == len(versions.tables(spark, path)["lists"]["base"])  # only folders of these lists are read


def test_points_and_none(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None), (4, [3.0, 4.0])], "no long, e array<float>")
    I.build(rows, path, "no", "e", unit=False)
    got = I.search(spark, path, spark.createDataFrame([(7, [0.0, 0.0])], "no long, e array<float>"), "no", "e", 2)
    assert [(r["rank"], r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(1, 1, 0.0), (2, 2, 5.0)]
    I.build(rows.limit(0), f"file://{tmp_path}/none", "no", "e")
    with pytest.raises(ValueError, match="without vectors"):
        I.search(spark, f"file://{tmp_path}/none", rows, "no", "e")


def test_claims_known_elsewhere(spark):
    rows = [(1, 1, "alpha beta gamma"), (2, 2, "gamma beta alpha"), (3, 2, "alpha beta gamma"), (4, 3, "something else entirely"), (5, None, "alpha beta gamma"), (6, 3, "gamma alpha betas")]
    known = scorers.letters(spark.createDataFrame(rows, "id long, g long, text string"), "text", "v")
    got = {r.claim_id: (r.existing_id, round(r.distance, 6), r.relevance) for r in metric.matched(known, known, scorers.rerank).collect()}
    assert got == {1: (2, 0.0, 1.0), 2: (1, 0.0, 1.0), 3: (1, 0.0, 1.0)}
    loose = {r.claim_id: r.existing_id for r in metric.matched(known, known, scorers.rerank, 0.5, 10, 0.6).collect()}
    assert loose == {1: 2, 2: 1, 3: 1, 6: 1}
    assert similarity.jaccard_join(known, "id", "text", 0.9).count() == 6
