"""Queries on chunks, transcripts and the whole extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sequences as Q
from ..streaming.incremental import sessions as sessions_of
from . import extraction
from .common import WS, table

SIZE, OVERLAP, MARGIN = 1000, 100, 50


def _chunked(spark, sf_dir, texts: bool = True):
    return Q.chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", SIZE, OVERLAP, MARGIN, texts=texts)


def chunk_spans(spark, sf_dir):
    return _chunked(spark, sf_dir, texts=False).select("doc_id", "chunk_no", "clean_start", "clean_end")


def chunk_overlap_text(spark, sf_dir):
    return Q.shared_with_next(_chunked(spark, sf_dir), "doc_id")


def _transcripts(spark, sf_dir):
    """Conversations as marked transcripts, a marker per turn."""
    turn = F.concat(F.col("turn").cast("string"), F.lit(" ("), F.col("turn").cast("string"), F.lit("m 5s):\n"), F.regexp_replace("text", "[\n\r]+", " "))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", turn.alias("t")))).alias("ts"))
    return grouped.select(F.col("conv_id").alias("episode_id"), F.array_join(F.transform("ts", lambda x: x["t"]), "\n\n").alias("text"))


def transcript_segments(spark, sf_dir):
    return Q.parsed(_transcripts(spark, sf_dir)).select("episode_id", "seg_no", "speaker", "seconds", "raw_start", "raw_end", "clean_text")


def _episodes(spark, sf_dir):
    """Documents as transcripts of one speaker."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("episode_id"), F.concat(F.lit("0 (5s):\n"), "text").alias("text"))


def extraction_full(spark, sf_dir):
    settings = extraction.Settings(chunk_size=SIZE, chunk_overlap=OVERLAP, chunk_margin=MARGIN, least_relevance=0.5)
    return extraction.full(_episodes(spark, sf_dir), "numbered", settings)["claims"].select("episode_id", "chunk_no", "claim", "quote_count", F.round("final_confidence", 6).alias("confidence"))


def extraction_short(spark, sf_dir):
    return extraction.short(_episodes(spark, sf_dir))


def event_sessions(spark, sf_dir):
    made = sessions_of(table(spark, sf_dir, "events"))
    return made.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("started"), "n_events", F.round("value", 3).alias("total"))


_CHUNKS = rf"""m AS (SELECT doc_id, text, length(text) AS len, regexp_extract_all(text, '(?s)(.*?[.!?]){WS}+', 0) AS w, regexp_extract_all(text, '(?s)(.*?[.!?]){WS}+', 1) AS b FROM documents),
u AS (SELECT doc_id, unnest(w) AS w, unnest(b) AS b, generate_subscripts(w, 1) AS i FROM m),
c AS (SELECT doc_id, i, sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i) AS e, sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i) - length(w) + length(b) - 1 AS p FROM u),
l AS (SELECT m.doc_id, any_value(text) AS text, any_value(len) AS len, list({{'p': CAST(p AS BIGINT), 'e': CAST(e AS BIGINT)}} ORDER BY i) FILTER (i IS NOT NULL) AS cs FROM m LEFT JOIN c ON m.doc_id = c.doc_id GROUP BY m.doc_id),
r AS (SELECT doc_id, 0 AS chunk_no, 0::BIGINT AS s, {{end0}} AS e FROM l WHERE trim(text, chr(32) || chr(9) || chr(10) || chr(13)) <> ''
  UNION ALL SELECT q.doc_id, q.n, q.s, {{endn}} FROM (SELECT doc_id, chunk_no + 1 AS n, CASE WHEN e - {OVERLAP} > s THEN e - {OVERLAP} ELSE e END AS s FROM r) q JOIN l ON q.doc_id = l.doc_id WHERE q.s < l.len AND l.len > {SIZE} AND q.n <= 1000)"""


def _end(start: str) -> str:
    goal = f"({start} + {SIZE})"
    low, high = f"greatest(0, {goal} - {MARGIN})", f"least(l.len, {goal} + {MARGIN})"
    best = f"list_sort(list_transform(list_filter(coalesce(l.cs, []), lambda x: x.p >= {low} AND x.p + 1 < {high}), lambda x: {{'d': abs(least(x.e, {high}) - {goal}), 'e': least(x.e, {high})}}))[1].e"
    return f"CASE WHEN {goal} >= l.len THEN CAST(l.len AS BIGINT) ELSE coalesce({best}, {goal}) END"


_CTE = "WITH RECURSIVE " + _CHUNKS.replace("{end0}", _end("0::BIGINT")).replace("{endn}", _end("q.s"))
_TURN = "turn || ' (' || turn || 'm 5s):' || chr(10) || regexp_replace(text, '[\\n\\r]+', ' ', 'g')"

def extraction_short_sql() -> str:
    from .text_queries import claim_rows

    return f"WITH {claim_rows()} SELECT doc_id AS episode_id, s AS claim, CAST(0.8 AS DOUBLE) AS confidence FROM r WHERE reason = 'valid'"


QUERIES = {f.__name__: f for f in (chunk_spans, chunk_overlap_text, transcript_segments, extraction_full, extraction_short, event_sessions)}
ORACLE_SQL = {
    "chunk_spans": f"{_CTE} SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, s AS clean_start, e AS clean_end FROM r",
    "chunk_overlap_text": f"{_CTE}, x AS (SELECT *, lead(s) OVER w AS s2, lead(e) OVER w AS e2 FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY chunk_no)) SELECT x.doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, substr(text, CAST(s2 + 1 AS BIGINT), CAST(greatest(least(e, e2) - s2, 0) AS BIGINT)) AS shared FROM x JOIN l USING (doc_id) WHERE s2 IS NOT NULL",
    "transcript_segments": f"WITH t AS (SELECT conv_id, turn, {_TURN} AS t, length(turn || ' (' || turn || 'm 5s):') AS h FROM conversations), o AS (SELECT *, row_number() OVER w - 1 AS n, coalesce(sum(length(t) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base, lead(turn) OVER w IS NULL AS last FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id AS episode_id, n AS seg_no, 'Speaker_' || turn AS speaker, CAST(turn * 60 + 5 AS INTEGER) AS seconds, CAST(base + h AS BIGINT) AS raw_start, CAST(base + length(t) + CASE WHEN last THEN 0 ELSE 2 END AS BIGINT) AS raw_end, trim(substr(t, CAST(h + 1 AS BIGINT)), chr(10) || ' ') AS clean_text FROM o",
    "extraction_short": extraction_short_sql(),
    "event_sessions": "WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT * EXCLUDE fresh, CASE WHEN fresh = 1 AND row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) > 1 THEN 0 ELSE fresh END AS fresh FROM g)) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS started, count(*) AS n_events, round(sum(value), 3) AS total FROM n WHERE user_id IS NOT NULL GROUP BY user_id, k",
}
