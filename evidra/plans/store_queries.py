"""Queries on stored tables and summaries: documents as chunks, orders as episodes, line items as claims, customers as podcasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import claims as C
from ..operators import reporting as R
from ..operators import scorers as M
from ..operators import sequences as Q
from ..operators import similarity as V
from ..operators import store as S
from .common import table, token_set
from .sequence_queries import _CTE, MARGIN, OVERLAP, SIZE
from .text_queries import claim_rows


def _chunks(spark, sf_dir):
    return Q.chunks(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", SIZE, OVERLAP, MARGIN)


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_id"), F.col("o_custkey").alias("podcast_id"), F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("seconds"))


def _items(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))


def chunk_ids(spark, sf_dir):
    """Chunks of all documents with ids in input order."""
    return S.numbered(_chunks(spark, sf_dir), "doc_id", "chunk_no").select("doc_id", "chunk_no", "chunk_id")


def claims_with_chunk_ids(spark, sf_dir):
    """Line items with the id of the chunk that their order and line name; the last lines have none."""
    items = _items(spark, sf_dir)
    chunks = S.numbered(items.where("line <= 5").select("episode_id", "line").distinct(), "episode_id", "line", after=1000)
    return S.with_chunk_ids(items.select("episode_id", "line"), chunks, ["episode_id", "line"])


def merged_chunk_ids(spark, sf_dir):
    """Chunk ids of each customer's merged claims: the lines of one order."""
    items = _items(spark, sf_dir)
    chunks = S.numbered(items.select("episode_id", "line").distinct(), "episode_id", "line")
    claims = S.lists_by(items, "episode_id", "line", "line", "lines").withColumn("claim_id", F.col("episode_id") * 7)
    made = S.merged_chunk_ids(claims, chunks, "claim_id", "episode_id", "lines", "line")
    return made.select("claim_id", F.array_join("merged_chunk_ids", ",").alias("chunk_ids"))


def episode_lookup(spark, sf_dir):
    requested = table(spark, sf_dir, "events").select(F.col("event_id").alias("episode_id"))
    return S.lookup(requested, _orders(spark, sf_dir), "episode_id").select("episode_id", "podcast_id", "found")


def missing_ids(spark, sf_dir):
    requested = table(spark, sf_dir, "events").select((F.col("event_id") * 2).alias("episode_id"))
    return S.missing(requested, _orders(spark, sf_dir), "episode_id")


def has_claims(spark, sf_dir):
    return S.has_rows(_orders(spark, sf_dir), _items(spark, sf_dir).where("flag = 'R'"), "episode_id").select("episode_id", "has_rows")


def selectable_episodes(spark, sf_dir):
    """Episodes with a transcript, of two podcasts: documents with a text or source, in two languages."""
    return S.with_transcripts(table(spark, sf_dir, "documents"), ["text", "source"], "lang", ["en", "fr"]).select("doc_id", "lang")


def latest_with_repeats(spark, sf_dir):
    """Orders of each customer that an event asks for, as often as it does."""
    requests = table(spark, sf_dir, "events").where("user_id is not null").select((F.col("user_id") + 1).alias("podcast_id"))
    return S.latest_with_repeats(requests, _orders(spark, sf_dir), "podcast_id").groupBy("podcast_id", "episode_id").agg(F.count("*").alias("n"))


def embedding_update(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("first"))
    changes = vectors.where("vec_id % 3 = 0").select((F.col("vec_id") * 2).alias("vec_id"), (F.col("vec_id") + 0.5).alias("first"))
    new, lost = S.updated(vectors, changes, "vec_id", "first")
    return new.select("vec_id", F.round("first", 6).alias("first"), F.lit("stored").alias("state")).unionByName(lost.select("vec_id", F.lit(None).cast("double").alias("first"), F.lit("missing").alias("state")))


def dry_run_count(spark, sf_dir):
    """How many claims a flagging of the fourth parts would change."""
    return S.would_change(_items(spark, sf_dir), _items(spark, sf_dir).where("part % 4 = 0"), "part", F.col("flag") != "R")


def claims_by_chunk(spark, sf_dir):
    made = S.lists_by(_items(spark, sf_dir), "episode_id", "line", "part", "parts")
    return made.select("episode_id", F.array_join("parts", ",").alias("parts"))


def _results(spark, sf_dir):
    counts = _items(spark, sf_dir).groupBy("episode_id").agg(F.count("*").alias("checked"), F.count_if(F.col("flag") == "R").alias("flagged"))
    joined = _orders(spark, sf_dir).join(counts, "episode_id", "left")
    few = F.coalesce("checked", F.lit(0)) < 5
    status = F.when(F.col("state") == "P", "failed").when(few, "skipped").otherwise("ok")
    reason = F.when(F.col("state") == "P", "error").when(F.col("checked").isNull(), "no claims").when(few, "too few claims")
    return joined.select("episode_id", status.alias("status"), reason.alias("reason"), F.coalesce("checked", F.lit(0)).alias("checked"), F.coalesce("flagged", F.lit(0)).alias("flagged"), F.floor(F.col("seconds")).cast("long").alias("seconds"))


def batch_summary(spark, sf_dir):
    return R.batch_summary(_results(spark, sf_dir)).withColumn("mean_seconds", F.round("mean_seconds", 3))


def skip_reasons(spark, sf_dir):
    return R.reasons(_results(spark, sf_dir))


def batch_errors(spark, sf_dir):
    """Documents run as a batch: what became of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 50 != 7, F.col("text")).alias("text"))
    return R.run_batch(docs, lambda df: C.judged_claims(C.sentence_rows(df)).where("reason = 'valid'"), "doc_id")[1]


def funnel_averages(spark, sf_dir):
    counts = C.judged_claims(C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))).groupBy("doc_id").agg(F.count("*").alias("sentences"), F.count_if(F.col("reason") == "valid").alias("valid"))
    made = R.funnel_averages(counts, ["sentences", "valid"])
    return made.select("sum_sentences", "sum_valid", F.round("avg_sentences", 6).alias("avg_sentences"), F.round("avg_valid", 6).alias("avg_valid"))


def distinct_positions(spark, sf_dir):
    return R.distinct_positions(_items(spark, sf_dir), "episode_id", "line", "part")


def cache_statistics(spark, sf_dir):
    return R.cache_statistics(table(spark, sf_dir, "documents").select("text"), "text").withColumn("hit_rate", F.round("hit_rate", 6))


def cache_keys(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", R.cache_keys(F.lit("embed"), F.col("text")).alias("key"))


def index_statistics(spark, sf_dir):
    return R.index_statistics(C.sentence_windows(table(spark, sf_dir, "documents").select("doc_id", "text")))


def split_probes(spark, sf_dir):
    rows = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return R.split_probes(rows, "sentence", ["doc_id", "pos"]).select("probe", "doc_id", "pos", "sentence")


def split_artefacts(spark, sf_dir):
    """Turns whose pieces, cut at an apostrophe, have one that begins with "s "."""
    pieces = F.split("text", "['’]")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", R.has_split(pieces).alias("split"))


def guests_shape(spark, sf_dir):
    """Answers of three shapes, of which the middle one is a guest list."""
    name = F.col("c_name")
    answers = F.element_at(F.array(
        F.concat(F.lit('{"people": [{"name": "'), name, F.lit('"}]}')),
        F.concat(F.lit('```json\n{"guests": [{"name": "'), name, F.lit('", "urls": ["http://a/"]}, {"name": "B", "urls": []}]}\n```')),
        F.concat(F.lit('{"guests": [{"name": "'), name, F.lit('"}]}')),
    ), (F.col("c_custkey") % 3 + 1).cast("int"))
    found = R.guests(answers)
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(F.size(found), F.lit(-1)).alias("n_guests"), F.get(found, F.lit(0))["name"].alias("first_name"))


def prompt_json(spark, sf_dir):
    rows = table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("size"), F.floor(F.col("item_id") / 50).alias("batch"))
    return R.prompt(rows, "batch", "item_id", ["item_id", "size"])


def components_json(spark, sf_dir):
    made = _items(spark, sf_dir).groupBy("episode_id").agg(F.count("*").alias("quote_count"), F.max("part").alias("max_part"))
    return made.select("episode_id", F.to_json(F.struct("quote_count", "max_part")).alias("components"))


def hybrid_score(spark, sf_dir):
    rows = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return R.hybrid_scores(rows, "doc_id", "sentence").withColumn("score", F.round("score", 6))


def judge_score(spark, sf_dir):
    rows = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return R.judge_scores(rows, "doc_id", "sentence").withColumn("score", F.round("score", 6))


def ad_judge_points(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    said = M.classify_ads(rows, "text")
    return said.groupBy("quality").agg(F.sum(R.ad_points(F.col("is_ad"), F.col("quality") == 0)).alias("points"), F.count("*").alias("n"))


def _reviewed(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", (F.col("conv_id") * 1000 + F.col("turn")).alias("row"), (F.col("conv_id") % 40).alias("chunk"), F.filter(F.split("text", ";|,"), lambda x: F.length(X.trimmed(x)) > 0).alias("claims"))


def reviewed_chunks(spark, sf_dir):
    made = R.reviewed_chunks(_reviewed(spark, sf_dir), "chunk", "row", "claims")
    return made.select("chunk", F.size("claims").cast("long").alias("n_claims"), F.md5(F.array_join("claims", "|")).alias("claims_md5"), "first")


def reviewed_totals(spark, sf_dir):
    return R.reviewed_totals(_reviewed(spark, sf_dir), "chunk", "claims").withColumn("avg_claims", F.round("avg_claims", 6))


def reviewed_by(spark, sf_dir):
    return R.reviewed_by(_reviewed(spark, sf_dir), "role", "claims")


def formatted_durations(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("episode_id", R.podcast_name(F.col("podcast_id")).alias("podcast"), F.floor(F.col("seconds") / 7).cast("long").alias("s"))
    return rows.select("episode_id", "podcast", R.duration(F.col("s")).alias("took"), R.comparison(F.lit(0.5), (F.col("s") % 8) / 8.0).alias("compared"))


def scored_once(spark, sf_dir):
    """Line items with what a scorer says of their part, which it is asked about once."""
    items = _items(spark, sf_dir).select("episode_id", "line", "part")
    return M.once(items, ["part"], lambda df: df.withColumn("is_ad", F.col("part") % 5 == 0))


def cross_corpus_match(spark, sf_dir):
    """Sentences of documents matched to ``benchmark``: of the ten nearest items by token distance, the first that covers the sentence."""
    left = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.struct("doc_id", "pos").alias("id"), F.col("sentence").alias("text"))
    out = V.cross_match(left, table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text"), 0.1, 10, 0.3)
    return out.select(F.col("left_id.doc_id").alias("doc_id"), F.col("left_id.pos").alias("pos"), F.col("right_id").alias("item_id"), F.round("jaccard", 6).alias("jaccard"), F.round("relevance", 6).alias("relevance"))


def transcript_formats(spark, sf_dir):
    """Conversations written as each of the three transcript formats, under a header for the last, and read again."""
    made = None
    for kind, fmt in _FORMATS.items():
        turn = F.format_string(fmt, F.col("turn"), F.col("turn"), F.regexp_replace("text", "[\n\r]+", " "))
        if kind == "lettered":
            turn = F.format_string(fmt, F.element_at(F.array(*map(F.lit, "ABCDEFGHIJ")), (F.col("turn") % 10 + 1).cast("int")), F.col("turn"), F.regexp_replace("text", "[\n\r]+", " "))
        grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", turn.alias("t")))).alias("ts"))
        head = "Transcript\nmade by hand\n\n" if kind == "lettered" else ""
        texts = grouped.select("conv_id", F.concat(F.lit(head), F.array_join(F.transform("ts", lambda x: x["t"]), "\n\n")).alias("text"))
        part = Q.parsed(texts, kind).select("conv_id", F.lit(kind).alias("kind"), "seg_no", "speaker", "seconds", "clean_text")
        made = part if made is None else made.unionByName(part)
    return made


def unmarked_transcripts(spark, sf_dir):
    """Documents read as transcripts: without a marker, each is one segment of an unknown speaker."""
    rows = Q.parsed(table(spark, sf_dir, "documents").select("doc_id", "text"), "lettered")
    return rows.select("doc_id", "seg_no", "speaker", "seconds", "raw_start", "raw_end", F.md5("clean_text").alias("clean_md5"))


def transcript_choice(spark, sf_dir):
    """The first given of three transcripts, and its format."""
    kind = F.col("event_type")
    text, chosen = Q.chosen_transcript(F.when(kind == "view", "").when(kind != "click", kind), F.when(kind == "click", F.col("props")), F.when(kind != "signup", F.col("props")))
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"), chosen.alias("format"))


def text_slices(spark, sf_dir):
    """A stretch of each document; empty where it is out of range."""
    start = F.length("source")
    return table(spark, sf_dir, "documents").select("doc_id", Q.slice_text(F.col("text"), start, start + 200).alias("stretch"))


def _shaped(column, shapes):
    """One of some written shapes of a customer's name and segment, by the length of the name and the account."""
    return F.element_at(F.array(*shapes), (F.abs(F.hash(column)) % len(shapes) + 1).cast("int"))


def tolerant_lists(spark, sf_dir):
    """Lists of two as models write them, read again."""
    a, b = F.col("c_name"), F.col("c_mktsegment")

    def put(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    shapes = [
        put('["', a, '", "', b, '"]'), put("['", a, "', '", b, "']"), put(', ["', a, '", "', b, '"]'), put('[["', a, '", "', b, '"]]'),
        put("Here they are:\n- ", a, "\n- ", b), put('The claims: ["', a, '", "', b, '"] as asked.'),
    ]
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(X.json_list(_shaped(F.col("c_custkey"), shapes)), "|").alias("items"))


def claims_cells(spark, sf_dir):
    """Reviewed cells in the shapes that reviewers use, read as claims."""
    a, b = F.col("c_name"), F.col("c_mktsegment")

    def put(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    shapes = [put(a, "; ", b, "; etc."), put('["', a, '", "', b, '"]'), put('[{"claim": "', a, '"}, {"claim": "', b, '"}]'), put('broken {"claim": "', a, '"}, {"claim": "', b, '"')]
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(X.claims_cell(_shaped(F.col("c_custkey"), shapes)), "|").alias("claims"))


_FORMATS = {"numbered": "%d (%dm 5s):\n%s", "named": "Guest %d:\n[1:%02d:07] %s", "lettered": "Speaker %s (1h %dm 9s):\n%s"}

def claims_from_answers(spark, sf_dir):
    """Claims of model answers: the sentences of each document as a JSON list, every seventh answer lost, every eleventh no list."""
    sentences = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = sentences.groupBy("doc_id").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("pos", "sentence"))), lambda x: x["sentence"])).alias("all"))
    answer = F.when(F.col("doc_id") % 11 == 0, F.lit("I cannot say.")).otherwise(F.concat(F.lit("```json\n"), "all", F.lit("\n```")))
    made = listed.select("doc_id", answer.alias("answer"), F.when(F.col("doc_id") % 7 == 0, F.lit("timeout")).alias("failed"))
    return C.claims_from_answers(made, "doc_id", "answer", "failed").select("doc_id", F.length("sentence").alias("n_chars"), F.md5("sentence").alias("claim_md5"))


def guest_names(spark, sf_dir):
    """Guests named in texts: in documents, with an introduction before every third."""
    docs = table(spark, sf_dir, "documents")
    intro = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Welcome back, Anna Lee Moore. Guest: Élise Dupont-Roy and joined by John O'Neil; "), F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
    made = M.guests(docs.select("doc_id", intro.alias("text")))
    return made.where(F.size("guests") > 0).select("doc_id", F.array_join(F.transform("guests", lambda g: g["name"]), "|").alias("names"))


QUERIES = {f.__name__: f for f in (
    chunk_ids, claims_with_chunk_ids, merged_chunk_ids, episode_lookup, missing_ids, has_claims, selectable_episodes, latest_with_repeats, embedding_update, dry_run_count,
    claims_by_chunk, batch_summary, skip_reasons, batch_errors, funnel_averages, distinct_positions, cache_statistics, cache_keys, index_statistics, split_probes, split_artefacts,
    guests_shape, prompt_json, components_json, hybrid_score, judge_score, ad_judge_points, reviewed_chunks, reviewed_totals, reviewed_by, formatted_durations, scored_once,
    cross_corpus_match, claims_from_answers, guest_names, transcript_formats, unmarked_transcripts, transcript_choice, text_slices, tolerant_lists, claims_cells,
)}


def _oracles() -> dict[str, str]:
    from .text_queries import _ISSUE, _OBVIOUS, _PROMO, W, contains_any

    rows = f"WITH {claim_rows()}"
    words = "(^|[^\\p{L}\\p{N}_])(" + "|".join(W.JUDGED_PRONOUNS) + ")([^\\p{L}\\p{N}_]|$)"
    asked = f"({_OBVIOUS} = 'none' AND regexp_matches(lower(s), '{words}'))"
    num = "num AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS chunk_id FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem {where}))"
    results = "c AS (SELECT l_orderkey AS k, count(*) AS checked, count(*) FILTER (l_returnflag = 'R') AS flagged FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey AS episode_id, CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN coalesce(checked, 0) < 5 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN o_orderstatus = 'P' THEN 'error' WHEN checked IS NULL THEN 'no claims' WHEN checked < 5 THEN 'too few claims' END AS reason, coalesce(checked, 0) AS checked, coalesce(flagged, 0) AS flagged, CAST(floor(o_totalprice) AS BIGINT) AS seconds FROM orders LEFT JOIN c ON k = o_orderkey)"
    rev = "rv AS (SELECT role, conv_id * 1000 + turn AS row, conv_id % 40 AS chunk, list_filter(string_split_regex(text, ';|,'), lambda x: length(trim(x, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))) > 0) AS claims FROM conversations)"
    dur = "CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' END"
    clean = "regexp_replace(text, '[\\n\\r]+', ' ', 'g')"
    seg = "row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seg_no"
    tidy = f"trim({clean}, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"
    return {
        "chunk_ids": f"{_CTE} SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, row_number() OVER (ORDER BY doc_id, chunk_no) AS chunk_id FROM r",
        "claims_with_chunk_ids": f"WITH {num.format(where='WHERE l_linenumber <= 5')} SELECT l.l_orderkey AS episode_id, l.l_linenumber AS line, chunk_id + 1000 AS chunk_id FROM lineitem l LEFT JOIN num USING (l_orderkey, l_linenumber)",
        "merged_chunk_ids": f"WITH {num.format(where='')} SELECT l_orderkey * 7 AS claim_id, string_agg(chunk_id, ',' ORDER BY chunk_id) AS chunk_ids FROM num GROUP BY l_orderkey",
        "episode_lookup": "SELECT e.event_id AS episode_id, o_custkey AS podcast_id, o_orderkey IS NOT NULL AS found FROM (SELECT DISTINCT event_id FROM events) e LEFT JOIN orders ON o_orderkey = e.event_id",
        "missing_ids": "SELECT DISTINCT event_id * 2 AS episode_id FROM events WHERE event_id * 2 NOT IN (SELECT o_orderkey FROM orders)",
        "has_claims": "SELECT o_orderkey AS episode_id, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS has_rows FROM orders",
        "selectable_episodes": "SELECT doc_id, lang FROM documents WHERE (text IS NOT NULL OR source IS NOT NULL) AND lang IN ('en', 'fr')",
        "latest_with_repeats": "SELECT o_custkey AS podcast_id, o_orderkey AS episode_id, count(*) AS n FROM events JOIN orders ON o_custkey = user_id + 1 GROUP BY 1, 2",
        "embedding_update": "WITH ch AS (SELECT vec_id * 2 AS vec_id, vec_id + 0.5::DOUBLE AS new FROM embeddings WHERE vec_id % 3 = 0) SELECT e.vec_id, round(coalesce(new, CAST(embedding[1] AS DOUBLE)), 6) AS first, 'stored' AS state FROM embeddings e LEFT JOIN ch USING (vec_id) UNION ALL SELECT vec_id, NULL, 'missing' FROM ch WHERE vec_id NOT IN (SELECT vec_id FROM embeddings)",
        "dry_run_count": "SELECT count(*) AS n FROM lineitem WHERE l_partkey % 4 = 0 AND l_returnflag <> 'R'",
        "claims_by_chunk": "SELECT l_orderkey AS episode_id, string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1",
        "batch_summary": f"WITH {results} SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS successful, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped, CAST(coalesce(sum(checked) FILTER (status = 'ok'), 0) AS BIGINT) AS checked, CAST(coalesce(sum(flagged) FILTER (status = 'ok'), 0) AS BIGINT) AS flagged, round(coalesce(avg(seconds) FILTER (status = 'ok'), 0), 3) AS mean_seconds FROM r",
        "skip_reasons": f"WITH {results} SELECT reason, count(*) AS n FROM r WHERE status = 'skipped' GROUP BY reason",
        "batch_errors": f"{rows}, v AS (SELECT doc_id, count(*) FILTER (reason = 'valid') AS n FROM r GROUP BY doc_id), d AS (SELECT doc_id, doc_id % 50 <> 7 AND coalesce(trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)), '') <> '' AS good, coalesce(n, 0) AS n FROM documents LEFT JOIN v USING (doc_id)) SELECT doc_id, CASE WHEN NOT good THEN 'failed' WHEN n = 0 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN NOT good THEN 'no transcript text' WHEN n = 0 THEN 'no claims' END AS reason, CASE WHEN good THEN n ELSE 0 END AS checked FROM d",
        "funnel_averages": f"{rows}, v AS (SELECT doc_id, count(*) AS sentences, count(*) FILTER (reason = 'valid') AS valid FROM r GROUP BY doc_id) SELECT CAST(sum(sentences) AS BIGINT) AS sum_sentences, CAST(sum(valid) AS BIGINT) AS sum_valid, round(avg(sentences), 6) AS avg_sentences, round(avg(valid), 6) AS avg_valid FROM v",
        "distinct_positions": "SELECT l_orderkey AS episode_id, count(DISTINCT (l_linenumber, l_partkey)) AS n_positions FROM lineitem GROUP BY 1",
        "cache_statistics": "WITH d AS (SELECT text, count(*) AS n FROM documents GROUP BY text) SELECT CAST(sum(n) AS BIGINT) AS requests, CAST(sum(n) - count(*) AS BIGINT) AS hits, count(*) AS misses, round((sum(n) - count(*)) / sum(n)::DOUBLE, 6) AS hit_rate FROM d",
        "cache_keys": "SELECT item_id, md5('embed' || chr(1) || text) AS key FROM benchmark",
        "index_statistics": f"{rows}, w AS (SELECT s || coalesce(' ' || lead(s) OVER (PARTITION BY doc_id ORDER BY pos), '') AS t FROM r) SELECT count(*) AS n_windows, CAST(sum(length(t)) AS BIGINT) AS total_chars FROM w",
        "split_probes": f"{rows}, pr AS (SELECT 'starts_with_s' AS probe, doc_id, pos, s FROM r WHERE s LIKE 's %' UNION ALL SELECT 'very_short', doc_id, pos, s FROM r WHERE length(s) < 15) SELECT probe, doc_id, CAST(pos AS INTEGER) AS pos, s AS sentence FROM pr QUALIFY row_number() OVER (PARTITION BY probe ORDER BY doc_id, pos) <= 100",
        "split_artefacts": "SELECT conv_id, turn, coalesce(len(list_filter(string_split_regex(text, '[''’]'), lambda x: starts_with(x, 's '))) > 0, false) AS split FROM conversations",
        "guests_shape": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 2 ELSE -1 END AS n_guests, CASE WHEN c_custkey % 3 = 1 THEN c_name END AS first_name FROM customer",
        "prompt_json": "SELECT item_id // 50 AS batch, '[' || string_agg('{\"item_id\":' || item_id || ',\"size\":' || length(text) || '}', ',' ORDER BY item_id) || ']' AS prompt FROM benchmark GROUP BY 1",
        "components_json": "SELECT l_orderkey AS episode_id, '{\"quote_count\":' || count(*) || ',\"max_part\":' || max(l_partkey) || '}' AS components FROM lineitem GROUP BY 1",
        "hybrid_score": f"{rows} SELECT doc_id, count(*) AS n_claims, count(*) FILTER ({asked}) AS judge_calls, round(avg(CASE WHEN {_OBVIOUS} <> 'none' THEN 0 WHEN {asked} THEN CASE WHEN {_ISSUE} THEN 0 ELSE 1 END ELSE 1 END), 6) AS score FROM r GROUP BY doc_id",
        "judge_score": f"{rows} SELECT doc_id, count(*) AS n_claims, round(avg(CASE WHEN {_ISSUE} THEN 0 ELSE 1 END), 6) AS score FROM r GROUP BY doc_id",
        "ad_judge_points": f"WITH t AS (SELECT quality, text FROM labels JOIN documents USING (doc_id)), a AS (SELECT quality, coalesce({contains_any('lower(text)', W.ADVERT)} OR {_PROMO.replace('length(text)', 'length(rpad(text, 200, chr(32)))').replace('lower(text)', 'lower(rpad(text, 200, chr(32)))')} NOT IN ('valid', 'Too short'), false) AS is_ad FROM t) SELECT quality, CAST(sum(CASE WHEN is_ad = (quality = 0) THEN 1 ELSE 0 END) AS BIGINT) AS points, count(*) AS n FROM a GROUP BY quality",
        "reviewed_chunks": f"WITH {rev} SELECT chunk, CAST(sum(len(claims)) AS BIGINT) AS n_claims, md5(array_to_string(flatten(list(claims ORDER BY row, claims)), '|')) AS claims_md5, min(row) AS first FROM rv GROUP BY chunk",
        "reviewed_totals": f"WITH {rev}, p AS (SELECT chunk, CAST(sum(len(claims)) AS BIGINT) AS n, count(*) AS c FROM rv GROUP BY chunk) SELECT CAST(sum(c) AS BIGINT) AS n_rows, CAST(sum(n) AS BIGINT) AS n_claims, count(*) AS n_chunks, round(avg(n), 6) AS avg_claims, min(n) AS min_claims, max(n) AS max_claims FROM p",
        "reviewed_by": f"WITH {rev} SELECT role, count(*) AS n_rows, CAST(sum(len(claims)) AS BIGINT) AS n_claims FROM rv GROUP BY role",
        "formatted_durations": f"WITH t AS (SELECT o_orderkey AS episode_id, 'Podcast ' || o_custkey AS podcast, CAST(floor(o_totalprice / 7) AS BIGINT) AS s FROM orders) SELECT episode_id, podcast, {dur} AS took, printf('%.3f → %.3f (%s%.3f)', 0.5::DOUBLE, (s % 8) / 8.0::DOUBLE, CASE WHEN s % 8 >= 4 THEN '+' ELSE '' END, (s % 8) / 8.0::DOUBLE - 0.5::DOUBLE) AS compared FROM t",
        "scored_once": "SELECT l_orderkey AS episode_id, l_linenumber AS line, l_partkey AS part, l_partkey % 5 = 0 AS is_ad FROM lineitem",
        "cross_corpus_match": f"{rows}, a AS (SELECT doc_id, pos, {token_set('s')} AS t FROM r), b AS (SELECT item_id, {token_set('text')} AS t FROM benchmark), j AS (SELECT doc_id, pos, item_id, len(list_intersect(a.t, b.t)) AS c, len(a.t) AS na, len(b.t) AS nb FROM a, b WHERE len(a.t) > 0 AND len(b.t) > 0 AND list_has_any(a.t, b.t)), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY c / (na + nb - c) DESC, item_id) AS n FROM j WHERE c / (na + nb - c) >= 0.1), f AS (SELECT * FROM k WHERE n <= 10 AND c / na >= 0.3 QUALIFY row_number() OVER (PARTITION BY doc_id, pos ORDER BY n) = 1) SELECT doc_id, CAST(pos AS INTEGER) AS pos, item_id, round(c / (na + nb - c), 6) AS jaccard, round(c / na, 6) AS relevance FROM f",
        "claims_from_answers": f"{rows}, f AS (SELECT * FROM r WHERE reason = 'valid' AND doc_id % 7 <> 0 AND doc_id % 11 <> 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(s) DESC, pos) <= 10) SELECT doc_id, CAST(length(s) AS INTEGER) AS n_chars, md5(s) AS claim_md5 FROM f",
        "guest_names": "WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'Welcome back, Anna Lee Moore. Guest: Élise Dupont-Roy and joined by John O''Neil; ' || coalesce(text, '') ELSE text END AS text FROM documents), g AS (SELECT doc_id, regexp_extract_all(text, '(?:[Gg]uests?:? (?:is |are )?|[Ww]elcome,? (?:back,? )?|[Jj]oined by |[Ff]eaturing |[Ii]nterview with )(\\p{Lu}[\\p{L}''-]+(?: \\p{Lu}[\\p{L}''-]+){1,3})', 1) AS n FROM t) SELECT doc_id, array_to_string(n, '|') AS names FROM (SELECT doc_id, list_filter(n, lambda x, i: list_position(n, x) = i) AS n FROM g) WHERE len(n) > 0",
        "unmarked_transcripts": f"WITH t AS (SELECT doc_id, text, {tidy.replace(clean, 'text')} AS c FROM documents) SELECT doc_id, CAST(0 AS BIGINT) AS seg_no, 'Speaker_Unknown' AS speaker, CAST(0 AS INTEGER) AS seconds, CAST(0 AS BIGINT) AS raw_start, length(text) AS raw_end, md5(c) AS clean_md5 FROM t WHERE c <> ''",
        "transcript_choice": "SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN props ELSE event_type END AS text, CASE event_type WHEN 'view' THEN 'lettered' WHEN 'click' THEN 'named' ELSE 'numbered' END AS format FROM events",
        "text_slices": "SELECT doc_id, CASE WHEN length(source) + 200 <= length(text) THEN trim(substr(text, length(source) + 1, 200), chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) ELSE '' END AS stretch FROM documents",
        "tolerant_lists": "SELECT c_custkey, c_name || '|' || c_mktsegment AS items FROM customer",
        "claims_cells": "SELECT c_custkey, c_name || '|' || c_mktsegment AS claims FROM customer",
        "transcript_formats": f"SELECT conv_id, 'numbered' AS kind, {seg}, 'Speaker_' || turn AS speaker, CAST(turn * 60 + 5 AS INTEGER) AS seconds, {tidy} AS clean_text FROM conversations UNION ALL SELECT conv_id, 'named', {seg}, 'Guest ' || turn, CAST(3600 + turn * 60 + 7 AS INTEGER), {tidy} FROM conversations UNION ALL SELECT conv_id, 'lettered', {seg}, 'Speaker_' || substr('ABCDEFGHIJ', CAST(turn % 10 + 1 AS BIGINT), 1), CAST(3600 + turn * 60 + 9 AS INTEGER), {tidy} FROM conversations",
    }


ORACLE_SQL = _oracles()
