"""What a task holds of its visitors or texts is bounded, and the results are those of all at once."""

import numpy as np

from evidra.operators import metric, sequences


def _vectors(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 8))
    x[::7] = x[3]
    return x / np.linalg.norm(x, axis=1, keepdims=True), spark.createDataFrame([(i, i % 3 if i % 11 else None, v.tolist()) for i, v in enumerate(x / np.linalg.norm(x, axis=1, keepdims=True))], "id long, g long, v array<double>")


def test_visitors_come_in_turns_and_slices(spark, monkeypatch):
    x, df = _vectors(spark, 150, 1)
    sizes = []
    for name, value in (("VISITORS", 40), ("TOGETHER", 16), ("CELL", 20), ("PART", 40), ("BOUNDING", 4), ("EXACT_AT_ONCE", 32)):
        monkeypatch.setattr(metric, name, value)
    cosine = x @ x.T
    want = {(i, j) for i in range(150) for j in range(i + 1, 150) if cosine[i, j] >= 0.6}
    assert sorted((r.left_id, r.right_id) for r in metric.similar_pairs(df, "id", "v", 0.6).collect()) == sorted(want)
    u, v = zip(*[(r.u, r.v) for r in metric.similar_links(df, "id", "v", 0.6).collect()], strict=True)
    assert set(map(tuple, np.transpose(metric.forest(np.array(u), np.array(v))).tolist())) == set(map(tuple, np.transpose(metric.forest(*np.array(sorted(want)).T)).tolist()))
    distance = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    got = {(r.query_id, r["rank"]): r.vec_id for r in metric.nearest(df, df, "id", "v", 5, "l2", "g", 1.3).collect()}
    want = {}
    for i in range(150):
        near = sorted((round(distance[i, j], 9), j) for j in range(150) if j % 11 and i % 11 and i % 3 != j % 3 and distance[i, j] < 1.3)[:5]
        want |= {(i, k + 1): j for k, (_, j) in enumerate(near)}
    assert got == want
    met = metric.meet

    def counting(visiting, residents, cells, run, schema):
        sizes.extend(r["count"] for r in visiting.withColumn("turn", metric.F.pmod(metric.F.xxhash64("id", metric.F.lit("turn")), metric.F.lit(4))).groupBy("to", "part", "turn").count().collect())
        return met(visiting, residents, cells, run, schema)

    monkeypatch.setattr(metric, "meet", counting)
    metric.similar_pairs(df, "id", "v", 0.3)
    assert max(sizes) < 75  # of 150


def test_texts_are_walked_some_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(sequences, "SLICE_BYTES", 3000)
    df = spark.createDataFrame([(i, None if i == 5 else "One two three. " * (i % 9) * 40) for i in range(40)], "id long, text string").coalesce(1)
    rows = sequences.chunks(df, "text", 200, 20, 10).collect()
    want = [(i, k, a, b) for i in range(40) for k, (a, b) in enumerate(sequences.chunk_spans(None if i == 5 else "One two three. " * (i % 9) * 40, 200, 20, 10))]
    assert [(r.id, r.chunk_no, r.clean_start, r.clean_end) for r in rows] == want
    spans = sequences.chunks(df, "text", 200, 20, 10, texts=False)
    assert spans.columns == ["id", "chunk_no", "clean_start", "clean_end"] and [tuple(r) for r in spans.collect()] == want


def test_residents_are_copied_by_visitors_not_by_their_own_number(spark, monkeypatch):
    for name, value in (("VISITORS", 20), ("CELL", 20), ("PART", 40), ("FEW", 0)):
        monkeypatch.setattr(metric, name, value)
    x, df = _vectors(spark, 200, 2)
    copies, met = [], metric.meet

    def counting(visiting, residents, cells, run, schema):
        copies.append(sum(int(n) * int(t) for n, t in zip(cells.rows, cells.turns, strict=True)))
        return met(visiting, residents, cells, run, schema)

    monkeypatch.setattr(metric, "meet", counting)
    got = {(r.query_id, r["rank"]): r.vec_id for r in metric.nearest(df.where("id < 6"), df, "id", "v", 4).collect()}
    score = np.clip(x @ x.T, 0, 1)
    want = {(i, k + 1): j for i in range(6) for k, j in enumerate(sorted((j for j in range(200) if j != i), key=lambda j: (-round(score[i, j], 9), j))[:4])}
    assert got == want and copies and set(copies) == {200}
    many = metric.turned(df.withColumn("reach", metric.F.lit(9.0)), metric.Cells(x[:1], np.array([200]), np.zeros(1), np.full(1, 2.0)), True)
    assert many.turns.tolist() == [10]


def test_a_few_queries_go_to_residents_that_stay(spark, monkeypatch):
    for name, value in (("CELL", 20), ("PART", 40)):
        monkeypatch.setattr(metric, name, value)
    x, df = _vectors(spark, 200, 3)
    monkeypatch.setattr(metric, "meet", None)  # no residents travel
    for kind, group, within in (("cosine", None, None), ("l2", "g", 1.3), ("l2", None, None)):
        got = {(r.query_id, r["rank"]): r.vec_id for r in metric.nearest(df.where("id < 9"), df, "id", "v", 4, kind, group, within).collect()}
        far = -np.clip(x @ x.T, 0, 1) if kind == "cosine" else np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
        want = {}
        for i in range(9):
            others = [j for j in range(200) if j != i and (not group or (i % 11 and j % 11 and i % 3 != j % 3)) and (within is None or far[i, j] < within)]
            want |= {(i, k + 1): j for k, j in enumerate(sorted(others, key=lambda j: (round(far[i, j], 9), j))[:4])}
        assert got == want
