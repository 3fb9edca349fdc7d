"""Joins in cells against all pairs, on vectors with clusters, copies, zeros and nulls."""

import numpy as np
import pytest

from evidra.operators import metric, similarity


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 1, (12, 8))
    x = centres[rng.integers(0, 12, 700)] + rng.normal(0, 0.08, (700, 8))
    x[50:60] = x[40]
    x[60] = 0
    x[61:64] = 2 * x[40]
    return x


@pytest.fixture(scope="module")
def frame(spark, points):
    rows = [(i, x.tolist(), None if i % 50 == 7 else i % 3) for i, x in enumerate(points)] + [(9000, None, 1)]
    return spark.createDataFrame(rows, "id long, v array<double>, g int").repartition(5).cache()


def cosines(x):
    n = np.linalg.norm(x, axis=1, keepdims=True)
    u = np.divide(x, n, out=np.zeros_like(x), where=n > 0)
    return np.clip(u @ u.T, 0, 1)


@pytest.fixture(autouse=True)
def small_cells(monkeypatch):
    monkeypatch.setattr(metric, "CELL", 30)
    monkeypatch.setattr(metric, "PART", 25)


@pytest.mark.parametrize("threshold", [0.2, 0.9, 0.999])
def test_pairs_and_links(frame, points, threshold):
    c = cosines(points)
    want = {(i, j) for i, j in zip(*np.nonzero(c >= threshold - 1e-12), strict=True) if i < j}
    got = [(r.left_id, r.right_id) for r in metric.similar_pairs(frame, "id", "v", threshold).collect()]
    assert len(got) == len(want) and set(got) == want
    label = list(range(len(points)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in want:
        a, b = sorted((top(i), top(j)))
        label[b] = a
    links = metric.similar_links(frame, "id", "v", threshold)
    nodes = frame.select(frame.id.alias("node")).where("node < 9000")
    found = {r.node: r.component for r in similarity.link_components(nodes, links).collect()}
    assert found == {i: top(i) for i in range(len(points))}
    if threshold == 0.9:
        assert links.count() < len(want) / 3


def test_cells_are_skipped(frame):
    homes, cells = metric._self_cells(frame, "id", "v")
    from pyspark.sql import functions as F

    seen, full = metric.cells_seen(homes.withColumn("reach", F.lit(metric._reach(0.98))), cells, True, later=True)
    assert len(cells.pivots) > 15 and seen < full / 3
    assert cells.parts().max() >= 2


@pytest.mark.parametrize(("kind", "within", "group"), [("cosine", None, None), ("l2", 0.5, "g"), ("l2", None, None), ("l2", None, "g")])
def test_nearest(frame, points, kind, within, group):
    got = {}
    for r in metric.nearest(frame.where("id % 5 = 0"), frame, "id", "v", 6, kind, group, within).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    c = cosines(points) if kind == "cosine" else None
    for q in range(0, len(points), 5):
        score = 1 - c[q] if c is not None else np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        ok = [i for i in range(len(points)) if i != q and (within is None or score[i] < within) and (group is None or (q % 50 != 7 and i % 50 != 7 and i % 3 != q % 3))]
        best = sorted(ok, key=lambda i: (round(score[i], 9), i))[:6]
        assert [(n, i) for n, i, _ in sorted(got.get(q, []))] == list(enumerate(best, 1)), q


def test_empty(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    some = spark.createDataFrame([(1, [1.0, 0.0])], "id long, v array<double>")
    assert metric.similar_pairs(none, "id", "v", 0.5).collect() == []
    assert metric.nearest(some, none, "id", "v", 3).collect() == []
    assert metric.nearest(none, some, "id", "v", 3).collect() == []
    assert metric.nearest(some, some, "id", "v", 3).collect() == []
    with pytest.raises(ValueError, match="above zero"):
        metric.similar_pairs(some, "id", "v", 0.0)
