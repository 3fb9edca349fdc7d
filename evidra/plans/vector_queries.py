"""Queries on what is stored between runs (a search index, updates by id, a memo), and on rows that fail."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import capture, memo, versions
from ..operators import claims as C
from ..operators import index as I
from ..operators import metric as D
from ..operators import scorers as M
from ..operators import similarity as V
from .common import table, token_set
from .extraction import once
from .text_queries import claim_rows

#: Room for the sentences of a document in a claim's id.
PER_DOC = 1_000_000


def _place(spark: SparkSession, name: str) -> str:
    V.checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/evidra-{name}-{uuid.uuid4().hex}"


def _claims(spark, sf_dir) -> DataFrame:
    """(id, g, text, v): valid claims of all documents with letter vectors."""
    found = C.judged_claims(C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))).where("reason = 'valid'")
    return M.letters(found.select((F.col("doc_id") * PER_DOC + F.col("pos")).alias("id"), F.col("doc_id").alias("g"), F.col("sentence").alias("text")), "text", "v")


def cross_episode_match(spark, sf_dir):
    """The longest claim of every document, where another document has it already: l2 below 0.15, ten nearest, relevance from 0.9."""
    known = once(_claims(spark, sf_dir))
    new = once(C.top_by(known, ["g"], [F.length("text").desc(), F.col("id")], 1))
    out = D.matched(new, known, M.rerank)
    return out.select("claim_id", "existing_id", F.round("distance", 6).alias("distance"), F.round("relevance", 6).alias("relevance"))


def search_index_topk(spark, sf_dir):
    """The ten windows nearest to each benchmark text, from a stored index to which half of the windows were appended."""
    windows = C.sentence_windows(table(spark, sf_dir, "documents").select("doc_id", "text")).select((F.col("doc_id") * PER_DOC + F.col("window_no")).alias("id"), "doc_id", F.col("window_text").alias("text"))
    rows = V._tabled(M.letters(windows, "text", "v"), "windows")
    path = _place(spark, "index")
    I.build(rows.where("doc_id % 2 = 0"), path, "id", "v")
    I.append(rows.where("doc_id % 2 = 1"), path, "id", "v")
    asked = M.letters(table(spark, sf_dir, "benchmark").select("item_id", "text"), "text", "v")
    found = I.search(spark, path, asked, "item_id", "v", 10)
    return found.select(F.col("query_id").alias("item_id"), "rank", "vec_id", "doc_id", F.length("text").alias("n_chars"), F.round("score", 6).alias("score"))


def vector_updates(spark, sf_dir):
    """Whole vectors replaced by id, twice, in a stored table; and the ids that it lacks."""
    path = _place(spark, "vectors")
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    versions.write({"vectors": rows}, path)
    first = rows.where("vec_id % 3 = 0").select((F.col("vec_id") * 2).alias("vec_id"), F.reverse("embedding").alias("embedding"))
    second = rows.where("vec_id % 5 = 0").select("vec_id", F.slice("embedding", 1, 3).alias("embedding"))
    versions.update(first, path, "vectors", "vec_id")
    versions.update(second, path, "vectors", "vec_id")
    text = F.array_join(F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("long").cast("string")), ",", "null")
    kept = versions.read(spark, path, "vectors").select("vec_id", F.md5(text).alias("vector_md5"), F.size("embedding").alias("n"), F.lit("stored").alias("state"))
    lost = versions.lacking(first, path, "vectors", "vec_id")
    return kept.unionByName(lost.select("vec_id", F.lit(None).cast("string").alias("vector_md5"), F.lit(None).cast("int").alias("n"), F.lit("missing").alias("state")))


def memo_runs(spark, sf_dir):
    """Two runs over documents with one memo: half of them, then all; what the memo answered, and how many texts are good."""
    path = _place(spark, "memo")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("is_valid", X.quality_issue(F.col("text")).isNull())

    runs = []
    for at, rows in enumerate((docs.where("doc_id % 2 = 0"), docs)):
        made = memo.remembered(rows, ["text"], score, path, now=3600.0 * at)
        good = made.rows.agg(F.count_if("is_valid").alias("n_valid"))
        runs.append(made.statistics().crossJoin(F.broadcast(good)).withColumn("run", F.lit(at)))  # one row each
    return runs[0].unionByName(runs[1]).select("run", "requests", "hits", "misses", F.round("hit_rate", 6).alias("hit_rate"), "stored", "n_valid")


def _lines(text: str) -> list[dict]:
    """The lines of a text that are not blank; texts marked as broken cannot be read."""
    if text.startswith("BROKEN "):
        raise ValueError("broken transcript")
    return [{"line": line} for line in text.split("\n") if line.strip(" \t\r\f\v")]


def batch_row_errors(spark, sf_dir):
    """Documents through a step that fails on some of them: what became of each."""
    broken = F.when(F.col("doc_id") % 50 == 7, F.concat(F.lit("BROKEN "), F.col("text"))).when(F.col("doc_id") % 50 != 9, F.col("text"))
    return capture.batch(table(spark, sf_dir, "documents").select("doc_id", broken.alias("text")), "doc_id", "text", "line string", _lines)[1]


QUERIES = {f.__name__: f for f in (cross_episode_match, search_index_topk, vector_updates, memo_runs, batch_row_errors)}

_LETTERS = "list_transform(range(97, 123), lambda c: CAST(length({t}) - length(replace(replace({t}, chr(CAST(c AS INTEGER)), ''), chr(CAST(c - 32 AS INTEGER)), '')) AS DOUBLE))"
_UNIT = "list_transform({v}, lambda x: x / greatest(sqrt(list_sum(list_transform({v}, lambda y: y * y))), 1e-300))"
_VECTOR = _UNIT.format(v="w")


def _issue() -> str:
    from .text_queries import _ISSUE

    return _ISSUE


def _oracles() -> dict[str, str]:
    rows = f"WITH {claim_rows()}"
    known = f"kw AS (SELECT doc_id * {PER_DOC} + pos AS id, doc_id AS g, s AS text, {token_set('s')} AS ts, {_LETTERS.format(t='s')} AS w FROM r WHERE reason = 'valid'), known AS MATERIALIZED (SELECT id, g, text, ts, {_VECTOR} AS v FROM kw)"
    new = "new AS (SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY g ORDER BY length(text) DESC, id) = 1)"
    near = "near AS (SELECT n.id AS claim_id, k.id AS existing_id, n.ts AS a, k.ts AS b, list_distance(n.v, k.v) AS d FROM new n JOIN known k ON n.g <> k.g WHERE list_distance(n.v, k.v) < 0.15), ten AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY round(d, 9), existing_id) AS n, coalesce(len(list_intersect(a, b)) / nullif(len(a), 0), 0) AS relevance FROM near)"
    windows = f"x AS (SELECT doc_id, pos, s || coalesce(' ' || lead(s) OVER (PARTITION BY doc_id ORDER BY pos), '') AS t FROM r), xw AS (SELECT doc_id * {PER_DOC} + pos AS id, doc_id, length(t) AS n_chars, {_LETTERS.format(t='t')} AS w FROM x), win AS MATERIALIZED (SELECT id, doc_id, n_chars, {_VECTOR} AS v FROM xw)"
    asked = f"aw AS (SELECT item_id, {_LETTERS.format(t='text')} AS w FROM benchmark), asked AS (SELECT item_id, {_VECTOR} AS v FROM aw)"
    best = "found AS (SELECT item_id, id, doc_id, n_chars, greatest(0, least(1, list_inner_product(asked.v, win.v))) AS c FROM asked, win)"
    text = "md5(array_to_string(list_transform(v, lambda x: CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT)), ','))"
    blank = "trim({t}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) = ''"
    rate = "round((requests - misses) / requests::DOUBLE, 6)"
    return {
        "memo_runs": f"WITH d AS (SELECT doc_id, text, CASE WHEN {_issue()} THEN 0 ELSE 1 END AS good FROM (SELECT doc_id, text, text AS s FROM documents)), a AS (SELECT 0 AS run, count(*) AS requests, count(DISTINCT text) + CAST(bool_or(text IS NULL) AS INTEGER) AS misses, CAST(sum(good) AS BIGINT) AS n_valid FROM d WHERE doc_id % 2 = 0), b AS (SELECT 1 AS run, (SELECT count(*) FROM d) AS requests, (SELECT count(DISTINCT text) FROM d WHERE text NOT IN (SELECT text FROM d WHERE doc_id % 2 = 0 AND text IS NOT NULL)) AS misses, (SELECT CAST(sum(good) AS BIGINT) FROM d) AS n_valid) SELECT run, requests, requests - misses AS hits, misses, {rate} AS hit_rate, misses AS stored, n_valid FROM a UNION ALL SELECT b.run, b.requests, b.requests - b.misses, b.misses, round((b.requests - b.misses) / b.requests::DOUBLE, 6), a.misses + b.misses, b.n_valid FROM a, b",
        "batch_row_errors": f"WITH d AS (SELECT doc_id, text IS NULL OR {blank.format(t='text')} OR doc_id % 50 = 9 AS bare, doc_id % 50 = 7 AS broken, len(list_filter(string_split(text, chr(10)), lambda x: NOT {blank.format(t='x')})) AS n FROM documents) SELECT doc_id, CASE WHEN (broken AND NOT coalesce(bare, true)) OR bare THEN 'failed' WHEN n = 0 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN bare THEN 'no transcript text' WHEN broken THEN 'ValueError: broken transcript' WHEN n = 0 THEN 'no claims' END AS reason, CASE WHEN bare OR broken THEN 0 ELSE n END AS checked FROM d",
        "cross_episode_match": f"{rows}, {known}, {new}, {near} SELECT claim_id, existing_id, round(d, 6) AS distance, round(relevance, 6) AS relevance FROM ten WHERE n <= 10 AND relevance >= 0.9 QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY n) = 1",
        "search_index_topk": f"{rows}, {windows}, {asked}, {best} SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS vec_id, doc_id, n_chars, round(c, 6) AS score FROM found WINDOW w AS (PARTITION BY item_id ORDER BY round(c, 9) DESC, id) QUALIFY row_number() OVER w <= 10",
        "vector_updates": f"WITH a AS (SELECT vec_id * 2 AS vec_id, list_reverse(embedding) AS v FROM embeddings WHERE vec_id % 3 = 0), b AS (SELECT vec_id, embedding[1:3] AS v FROM embeddings WHERE vec_id % 5 = 0), e AS (SELECT e.vec_id, coalesce(b.v, a.v, embedding) AS v FROM embeddings e LEFT JOIN a USING (vec_id) LEFT JOIN b USING (vec_id)) SELECT vec_id, {text} AS vector_md5, CAST(len(v) AS INTEGER) AS n, 'stored' AS state FROM e UNION ALL SELECT vec_id, NULL, NULL, 'missing' FROM a WHERE vec_id NOT IN (SELECT vec_id FROM embeddings)",
    }


ORACLE_SQL = _oracles()
