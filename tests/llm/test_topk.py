import random

import numpy as np

from evidra.llm import topk

from .helpers import same

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, score string"


def test_oracle(spark):
    same(topk.op6_topk(spark, SF), topk.ORACLE_SQL["op6_topk"], SF)


def test_search_against_all_scores():
    rng = np.random.default_rng(3)
    for n, dims, k in ((1, 3, 5), (7, 2, 3), (900, 8, 20), (3000, 16, 20)):
        c = np.floor(rng.normal(0, 8, (n, dims)))
        c[n // 2 :] = c[rng.integers(0, max(n // 2, 1), n - n // 2)]  # many ties
        own = rng.integers(-1, n, 40)
        q = np.where((own >= 0)[:, None], c[own], np.floor(rng.normal(0, 8, (40, dims))))
        q[:3] = 0
        got = topk.search(q, c, own, np.arange(n), k)
        for i in range(40):
            order = sorted((-float(s), j) for j, s in enumerate(c @ q[i]) if j != own[i])[:k]
            assert [(j, s) for a, j, s in got if a == i] == [(j, int(-s)) for s, j in order]


def test_nulls_repeats_and_ties(spark):
    rows = [(0, [1.0, 0.5], "x"), (0, [1.0, 0.5], "x"), (1, [1.0], "x"), (2, None, "x"), (3, [float("nan"), 1.0], "x"), (4, [None, 1.0], "x"), (5, [1.0, 0.5], "x"), (None, [1.0, 0.5], "x"), (20, [], "x")]
    out = topk.top_k(spark.createDataFrame(rows, SCHEMA)).collect()
    mine = [[r.rank, r.vec_id, r.score] for r in out if r.query_id == 0]
    once = [[1, 0, 5120], [2, 5, 5120], [3, None, 5120], [4, 1, 4096], [5, 20, 0]]
    assert sorted(mine, key=lambda x: x[0]) == [x for x in once for _ in range(2)]
    assert len([r for r in out if r.query_id == 20]) == 5
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cells_do_not_change_results(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(i, [float(rng.choice([-1, 0, 0.5, 2])) for _ in range(4)], "x") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, topk.top_k(df).collect()))
    monkeypatch.setattr(topk, "BLOCK", 90)
    monkeypatch.setattr(topk, "CHUNK", 9)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want


def test_lists_are_left_early_where_bounds_allow():
    rng = np.random.default_rng(5)
    c = np.floor(rng.normal(0, 2, (4000, 12)))
    c[:, 0] = np.floor(rng.normal(0, 200, 4000))  # one dimension decides
    lists = topk.Lists(c)
    q = np.array([[9.0] + [1.0] * 11])
    none, never = np.array([-1]), np.array([-np.inf])
    (alive,), (read,) = topk.qualified(lists, q, none, 20, never)
    score = c @ q[0]
    best = np.argsort(-score)[:20]
    assert set(best) <= set(alive) and len(alive) < 200 and read < 0.6
    (alive,), (read,) = topk.qualified(lists, q, none, 20, np.array([1e9]))  # no candidate can reach the bar: nothing is read
    assert not len(alive) and read == 0
    (alive,), _ = topk.qualified(lists, q, best[:1], 20, np.array([np.sort(score)[-15]]))
    assert best[0] not in alive and set(best[1:15]) <= set(alive)
