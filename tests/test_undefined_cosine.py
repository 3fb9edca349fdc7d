"""A vector without a cosine takes no links from others, and counts in the query as it does in its SQL."""

import duckdb
import numpy as np
import pytest

from evidra.operators import metric, similarity
from evidra.plans import table_queries


def _vectors():
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (6, 8))[rng.integers(0, 6, 90)] + rng.normal(0, 0.05, (90, 8))
    return [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]


ODD = [float("nan"), float("inf"), float("-inf")]


def test_links_of_others_are_kept(spark, monkeypatch):
    monkeypatch.setattr(metric, "CELL", 10)
    rows = _vectors()
    odd = [(1000 + k, [x, *[1.0] * 7]) for k, x in enumerate(ODD)]
    schema, nodes = "id long, v array<double>", spark.range(90).withColumnRenamed("id", "node")
    got = []
    for part in (rows, rows + odd):
        links = metric.similar_links(spark.createDataFrame(part, schema), "id", "v", 0.95)
        got.append(sorted((r.node, r.component) for r in similarity.link_components(nodes, links).collect()))
    assert got[0] == got[1] and len({c for _, c in got[0]}) < 10
    pairs = [metric.similar_pairs(spark.createDataFrame(part, schema), "id", "v", 0.95).count() for part in (rows, rows + odd)]
    assert pairs[0] == pairs[1] > 90


@pytest.mark.parametrize("odd", [[], [None], [[0.0] * 8], [[float("nan"), *[1.0] * 7]], [[float("inf"), *[1.0] * 7], None]])
def test_components_are_those_of_the_sql(spark, tmp_path, odd):
    rows = _vectors() + [(1000 + k, v) for k, v in enumerate(odd)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(table_queries.ORACLE_SQL["dup_components"]).fetchall()
    assert sorted((r.vec_id, r.component) for r in table_queries.dup_components(spark, str(tmp_path)).collect()) == sorted(want)
