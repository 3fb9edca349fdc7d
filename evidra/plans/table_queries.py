"""Relational queries: orders stand for episodes, line items for claims, customers for podcasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import metrics as M
from ..operators import selection as S
from ..operators import metric as D
from ..operators import similarity as V
from .common import table, token_set

LATEST = 3


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_id"), F.col("o_custkey").alias("podcast_id"), F.col("o_orderdate").alias("air_date"))


def _claims(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return items.select(F.col("l_orderkey").alias("episode_id"), F.col("l_linenumber").alias("line"), (F.col("l_linestatus") == "F").alias("is_verified"), (F.col("l_returnflag") == "R").alias("is_flagged"), F.col("l_discount").alias("relevance"))


def _window(spark, sf_dir):
    return S.latest(_orders(spark, sf_dir), "podcast_id", "air_date", "episode_id", LATEST)


def latest_n_per_podcast(spark, sf_dir):
    return _window(spark, sf_dir).select("podcast_id", "episode_id", F.date_format("air_date", "yyyy-MM-dd").alias("air_date"))


def unprocessed_in_window(spark, sf_dir):
    return S.unprocessed(_window(spark, sf_dir), _claims(spark, sf_dir), "episode_id").select("podcast_id", "episode_id")


def to_validate_in_window(spark, sf_dir):
    return S.to_validate(_window(spark, sf_dir), _claims(spark, sf_dir), "episode_id", F.col("is_verified")).select("podcast_id", "episode_id")


def unprocessed_all(spark, sf_dir):
    return S.unprocessed(_orders(spark, sf_dir), _claims(spark, sf_dir), "episode_id").select("episode_id")


def to_validate_all(spark, sf_dir):
    return S.to_validate(_orders(spark, sf_dir), _claims(spark, sf_dir), "episode_id", F.col("is_verified")).select("episode_id")


def processing_stats(spark, sf_dir):
    return S.processing_stats(_orders(spark, sf_dir), _claims(spark, sf_dir), "episode_id")


def claim_counts_zero_fill(spark, sf_dir):
    return S.counts_with_zeros(_orders(spark, sf_dir).select("episode_id"), _claims(spark, sf_dir), "episode_id")


def min_claims_eligible(spark, sf_dir):
    return S.eligible(_claims(spark, sf_dir).where("not is_verified or is_flagged"), "episode_id")


def claims_in_state(spark, sf_dir):
    """Claims of each episode that are neither flagged nor verified."""
    return S.in_state(_claims(spark, sf_dir), flagged=False, verified=False).groupBy("episode_id").agg(F.count("*").alias("n_claims"))


def flag_and_verify(spark, sf_dir):
    keyed = _claims(spark, sf_dir).withColumn("claim_id", F.col("episode_id") * 10 + F.col("line")).select("claim_id", "is_flagged", "is_verified")
    answers = keyed.where("claim_id % 7 = 0").select("claim_id", (F.col("claim_id") % 2 == 0).alias("is_valid"))
    out = S.validated(keyed, answers, "claim_id")
    return out.groupBy("is_flagged", "is_verified").agg(F.count("*").alias("n"), F.sum("claim_id").alias("id_sum"))


def _links(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"))


def get_or_create_links(spark, sf_dir):
    links = _links(spark, sf_dir)
    stored = links.where("part % 3 = 0").select("part", "supp").distinct().withColumn("quote_id", F.col("part") * 1000 + F.col("supp"))
    return S.get_or_create(links.select("claim_id", "part", "supp"), stored, ["part", "supp"], "quote_id").select("claim_id", "part", "supp", "quote_id")


def merge_links_anti(spark, sf_dir):
    links = _links(spark, sf_dir).select("claim_id", F.col("part").alias("quote_id"))
    return S.new_links(links, links.where("quote_id % 4 = 0"), ["claim_id", "quote_id"]).select("claim_id", "quote_id", F.lit("cross_ep_rerank").alias("match_type"))


def _confidence(spark, sf_dir):
    made = E.confidence(F.col("relevance").cast("double") * 10)
    return _claims(spark, sf_dir).groupBy("episode_id").agg(*[(c if n == "quote_count" else F.round(c, 6)).alias(n) for n, c in made.items()])


def confidence_score(spark, sf_dir):
    return _confidence(spark, sf_dir)


def confidence_filter(spark, sf_dir):
    return _confidence(spark, sf_dir).where("final_confidence >= 0.3").select("episode_id", "final_confidence")


def _marked(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.length(F.regexp_replace("text", "[^#*$%&|<>!]", "")) * 50 > F.length("text")).alias("says_bad"))
    return table(spark, sf_dir, "labels").join(docs, "doc_id")


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])


def confusion_metrics(spark, sf_dir):
    return _rounded(M.confusion(_marked(spark, sf_dir), F.col("says_bad"), F.col("quality") == 0))


def _four(col):
    return F.element_at(F.array(*map(F.lit, ("SUPPORTS", "RELATED", "NEUTRAL", "CONTRADICTS"))), col)


def fourway_metrics(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    actual = _four((2 * F.col("toxic") + 1 - F.col("quality") + 1).cast("int"))
    said = _four((F.col("says_bad").cast("int") + F.when(F.col("doc_id") % 5 == 0, 2).otherwise(0) + 1).cast("int"))
    both = rows.select(said.alias("said"), actual.alias("actual"))
    return _rounded(M.entailment(both, F.col("said"), F.col("actual")))


def judge_penalties(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    actual, said = _four((F.col("toxic") + 1).cast("int")), _four((F.col("says_bad").cast("int") + 1).cast("int"))
    return rows.groupBy(actual.alias("actual")).agg(F.sum(M.penalty(said, actual)).alias("points"), F.count("*").alias("n"))


def label_distribution(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"))


def deterministic_split(spark, sf_dir):
    return M.split(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "42").select("doc_id", "part")


def segment_offsets(spark, sf_dir):
    turns = E.offsets(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
    return turns.select("conv_id", "turn", "start_pos", "end_pos")


def segment_join_text(spark, sf_dir):
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["text"]), "\n\n").alias("full_text"))


def _spans(spark, sf_dir):
    turns = E.offsets(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")
    return turns.select("conv_id", (F.col("conv_id") * 100 + F.col("turn")).alias("quote_id"), (F.floor(F.col("start_pos") * 0.7)).alias("start_pos"), "end_pos", "text", "role")


def span_overlap_pairs(spark, sf_dir):
    out = E.overlapping(_spans(spark, sf_dir), "conv_id", "quote_id", least=0.25)
    return out.withColumn("overlap", F.round("overlap", 6))


def same_quotes(spark, sf_dir):
    """Turns that are the same quote: of overlapping spans, or beginning close by with alike words; and each turn said again at once."""
    spans = _spans(spark, sf_dir)
    again = spans.select("conv_id", (F.col("quote_id") + 50).alias("quote_id"), (F.col("end_pos") + 1).alias("start_pos"), (F.col("end_pos") + 1 + F.length("text")).alias("end_pos"), "text", "role")
    short = F.length("text") < 25
    return E.same_quotes(spans.where(~short).unionByName(spans.where(short)).unionByName(again.where(short)), "conv_id", "quote_id")


def quote_dedup_fold(spark, sf_dir):
    quotes = _spans(spark, sf_dir).select("conv_id", "quote_id", "start_pos", "end_pos", "text", (F.col("quote_id") % 10 / 10.0).alias("score"), F.col("role").alias("speaker"), F.col("start_pos").alias("ts"))
    return E.folded(quotes, "conv_id").select("conv_id", "quote_id", "start_pos", "end_pos", "score", F.array_join("merged", ",").alias("merged"))


def quote_remap(spark, sf_dir):
    spans = _spans(spark, sf_dir)
    quotes = spans.select("conv_id", "quote_id", "start_pos", "end_pos", "text", F.lit(0.5).alias("score"), F.col("role").alias("speaker"), F.col("start_pos").alias("ts"))
    links = spans.select((F.col("quote_id") % 7).alias("claim_id"), "quote_id")
    return E.remapped(links, quotes, E.folded(quotes, "conv_id"), "conv_id")


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def cosine_self_join(spark, sf_dir):
    out = D.similar_pairs(_vectors(spark, sf_dir), "vec_id", "embedding", 0.3)
    return out.withColumn("cosine", F.round("cosine", 6))


def cosine_topk(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    out = D.nearest(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 30)
    return out.select("query_id", "rank", "vec_id", F.round("score", 6).alias("cosine"))


def l2_knn_other_group(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    out = D.nearest(vectors, vectors, "vec_id", "embedding", 10, "l2", "label", 1.3)
    return out.select("query_id", "rank", "vec_id", F.round("score", 6).alias("distance"))


def dup_components(spark, sf_dir):
    """Components of alike vectors; a cosine that is not a number is above any threshold, as in SQL, so a vector without a direction links all."""
    vectors = _vectors(spark, sf_dir)
    links = D.similar_links(vectors, "vec_id", "embedding", 0.36)
    some = vectors.where(F.size("embedding") > 0)
    hub = some.where(~D.has_cosine("embedding")).agg(F.min("vec_id").alias("u")).where("u is not null")
    links = links.unionByName(some.select(F.col("vec_id").alias("v")).crossJoin(F.broadcast(hub)))
    return V.link_components(vectors.select(F.col("vec_id").alias("node")), links).withColumnRenamed("node", "vec_id")


def merge_representative(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    from ..functions.text import normalized

    keyed = docs.select("doc_id", "text", F.md5(normalized(F.col("text"))).alias("group_key"), F.lit(1.0).alias("confidence"), "source")
    return E.merged_groups(keyed, "group_key", "doc_id", "text", "confidence", "source").select("group_key", "representative", F.array_join("chunks", ",").alias("chunks"), "n_members")


_EP = "ep AS (SELECT o_orderkey AS episode_id, o_custkey AS podcast_id, o_orderdate AS air_date FROM orders), cl AS (SELECT l_orderkey AS episode_id, l_linenumber AS line, l_linestatus = 'F' AS is_verified, l_returnflag = 'R' AS is_flagged, l_discount AS relevance FROM lineitem)"
_WIN = f"{_EP}, win AS (SELECT * FROM ep QUALIFY row_number() OVER (PARTITION BY podcast_id ORDER BY air_date DESC NULLS LAST, episode_id) <= {LATEST})"
_CONF = f"{_EP}, s AS (SELECT episode_id, avg(CAST(relevance AS DOUBLE) * 10) AS a, max(CAST(relevance AS DOUBLE) * 10) AS m, count(*) AS n FROM cl GROUP BY episode_id), c AS (SELECT episode_id, round(a, 6) AS avg_relevance, round(m, 6) AS max_relevance, n AS quote_count, round(least(1.0, (n - 1) / 4.0), 6) AS count_score, round(least(1.0, greatest(0.0, 0.65 * a + 0.25 * m + 0.10 * least(1.0, (n - 1) / 4.0))), 6) AS final_confidence FROM s)"
_MARK = "mk AS (SELECT l.*, length(regexp_replace(text, '[^#*$%&|<>!]', '', 'g')) * 50 > length(text) AS says_bad FROM labels l JOIN documents USING (doc_id))"
_R = "round(coalesce(({a}) / nullif(CAST({b} AS DOUBLE), 0), 0), 6)"
_FOUR = "['SUPPORTS', 'RELATED', 'NEUTRAL', 'CONTRADICTS']"
_OFF = "off AS (SELECT conv_id, turn, role, text, CAST(coalesce(sum(length(coalesce(text, '')) + 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_pos, length(coalesce(text, '')) AS size FROM conversations)"
_SPAN = f"{_OFF}, sp AS (SELECT conv_id, conv_id * 100 + turn AS id, CAST(floor(start_pos * 0.7::DOUBLE) AS BIGINT) AS s, start_pos + size AS e FROM off)"


def _fold(score: str) -> str:
    """DuckDB CTEs that end in ``kept``: quotes folded one by one, the kept ones of a conversation in a list."""
    near = "(least(k.e - k.s, q.e - q.s) > 0 AND greatest(0, least(k.e, q.e) - greatest(k.s, q.s)) / CAST(least(k.e - k.s, q.e - q.s) AS DOUBLE) >= 0.5) OR (q.s - k.s < 20 AND len(k.bag) > 0 AND len(q.bag) > 0 AND len(list_intersect(k.bag, q.bag)) / CAST(len(k.bag) + len(q.bag) - len(list_intersect(k.bag, q.bag)) AS DOUBLE) >= 0.8)"
    grown = "{'id': k.id, 's': least(k.s, q.s), 'e': greatest(k.e, q.e), 'n': greatest(k.n, q.size), 'bag': CASE WHEN k.n >= q.size THEN k.bag ELSE q.bag END, 'score': greatest(k.score, q.score), 'merged': list_append(k.merged, q.id)}"
    fresh = "{'id': q.id, 's': q.s, 'e': q.e, 'n': q.size, 'bag': q.bag, 'score': q.score, 'merged': [q.id]}"
    return f"""WITH RECURSIVE {_SPAN.replace("SELECT conv_id, conv_id * 100", "SELECT text, size, conv_id, conv_id * 100")},
q AS (SELECT *, {score} AS score, {token_set("coalesce(text, '')")} AS bag, row_number() OVER (PARTITION BY conv_id ORDER BY s, id) AS turn FROM sp),
f AS (SELECT conv_id, CAST(0 AS BIGINT) AS turn, list_filter([{{'id': CAST(0 AS BIGINT), 's': CAST(0 AS BIGINT), 'e': CAST(0 AS BIGINT), 'n': CAST(0 AS BIGINT), 'bag': ['']::VARCHAR[], 'score': 0::DOUBLE, 'merged': [CAST(0 AS BIGINT)]}}], lambda k: false) AS kept FROM (SELECT DISTINCT conv_id FROM q)
UNION ALL SELECT conv_id, turn, CASE WHEN coalesce(spot, 0) = 0 THEN list_append(kept, {fresh.replace("q.", "")}) ELSE list_transform(kept, lambda k, i: CASE WHEN i = spot THEN {grown.replace("q.", "")} ELSE k END) END
FROM (SELECT q.*, f.kept, list_position(list_transform(f.kept, lambda k: {near}), true) AS spot FROM f JOIN q ON q.conv_id = f.conv_id AND q.turn = f.turn + 1)),
kept AS (SELECT conv_id, unnest(kept) AS k FROM (SELECT conv_id, arg_max(kept, turn) AS kept FROM f GROUP BY conv_id))"""


_COS = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"
_DIST = "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"

QUERIES = {f.__name__: f for f in (
    latest_n_per_podcast, unprocessed_in_window, to_validate_in_window, unprocessed_all, to_validate_all, processing_stats, claim_counts_zero_fill,
    min_claims_eligible, claims_in_state, flag_and_verify, get_or_create_links, merge_links_anti, confidence_score, confidence_filter, confusion_metrics, fourway_metrics,
    judge_penalties, label_distribution, deterministic_split, segment_offsets, segment_join_text, span_overlap_pairs, same_quotes, quote_dedup_fold, quote_remap,
    cosine_self_join, cosine_topk, l2_knn_other_group, dup_components, merge_representative,
)}

ORACLE_SQL = {
    "latest_n_per_podcast": f"WITH {_WIN} SELECT podcast_id, episode_id, strftime(air_date, '%Y-%m-%d') AS air_date FROM win",
    "unprocessed_in_window": f"WITH {_WIN} SELECT podcast_id, episode_id FROM win ANTI JOIN cl USING (episode_id)",
    "to_validate_in_window": f"WITH {_WIN} SELECT podcast_id, episode_id FROM win WHERE episode_id IN (SELECT episode_id FROM cl WHERE NOT is_verified)",
    "unprocessed_all": f"WITH {_EP} SELECT episode_id FROM ep ANTI JOIN cl USING (episode_id)",
    "to_validate_all": f"WITH {_EP} SELECT episode_id FROM ep WHERE episode_id IN (SELECT episode_id FROM cl WHERE NOT is_verified)",
    "processing_stats": f"WITH {_EP}, n AS (SELECT episode_id, count(*) AS n FROM cl GROUP BY 1) SELECT count(*) AS total, count(n) AS processed, count(*) - count(n) AS unprocessed, CAST(coalesce(sum(n), 0) AS BIGINT) AS claims FROM ep LEFT JOIN n USING (episode_id)",
    "claim_counts_zero_fill": f"WITH {_EP} SELECT ep.episode_id, count(cl.episode_id) AS n_claims FROM ep LEFT JOIN cl USING (episode_id) GROUP BY ep.episode_id",
    "min_claims_eligible": f"WITH {_EP} SELECT episode_id, count(*) AS n_claims FROM cl WHERE NOT is_verified OR is_flagged GROUP BY 1 HAVING count(*) >= 5",
    "claims_in_state": f"WITH {_EP} SELECT episode_id, count(*) AS n_claims FROM cl WHERE NOT is_flagged AND NOT is_verified GROUP BY 1",
    "flag_and_verify": f"WITH {_EP}, k AS (SELECT episode_id * 10 + line AS claim_id, is_flagged FROM cl) SELECT is_flagged OR (claim_id % 7 = 0 AND claim_id % 2 <> 0) AS is_flagged, true AS is_verified, count(*) AS n, CAST(sum(claim_id) AS BIGINT) AS id_sum FROM k GROUP BY 1, 2",
    "get_or_create_links": "WITH l AS (SELECT l_orderkey AS claim_id, l_partkey AS part, l_suppkey AS supp FROM lineitem), st AS (SELECT DISTINCT part, supp, part * 1000 + supp AS quote_id FROM l WHERE part % 3 = 0), fresh AS (SELECT part, supp FROM (SELECT DISTINCT part, supp FROM l) ANTI JOIN st USING (part, supp)), num AS (SELECT part, supp, (SELECT max(quote_id) FROM st) + row_number() OVER (ORDER BY md5(part || ':' || supp), part, supp) AS quote_id FROM fresh) SELECT claim_id, part, supp, quote_id FROM l JOIN (SELECT * FROM st UNION ALL SELECT * FROM num) USING (part, supp)",
    "merge_links_anti": "SELECT DISTINCT l_orderkey AS claim_id, l_partkey AS quote_id, 'cross_ep_rerank' AS match_type FROM lineitem WHERE l_partkey % 4 <> 0",
    "confidence_score": f"WITH {_CONF} SELECT * FROM c",
    "confidence_filter": f"WITH {_CONF} SELECT episode_id, final_confidence FROM c WHERE final_confidence >= 0.3",
    "confusion_metrics": f"WITH {_MARK}, c AS (SELECT count(*) FILTER (says_bad AND quality = 0) AS tp, count(*) FILTER (says_bad AND quality <> 0) AS fp, count(*) FILTER (NOT says_bad AND quality = 0) AS fn, count(*) FILTER (NOT says_bad AND quality <> 0) AS tn FROM mk) SELECT *, {_R.format(a='tp + tn', b='tp + fp + fn + tn')} AS accuracy, {_R.format(a='tp', b='(tp + fp)')} AS precision, {_R.format(a='tp', b='(tp + fn)')} AS recall, {_R.format(a='fp', b='(fp + tn)')} AS false_positive_rate, {_R.format(a='fn', b='(fn + tp)')} AS false_negative_rate FROM c",
    "fourway_metrics": f"WITH {_MARK}, b AS (SELECT {_FOUR}[2 * toxic + 1 - quality + 1] AS actual, {_FOUR}[CAST(says_bad AS INTEGER) + CASE WHEN doc_id % 5 = 0 THEN 2 ELSE 0 END + 1] AS said FROM mk), c AS (SELECT count(*) AS n, count(*) FILTER (said = actual) AS r, count(*) FILTER (said = 'SUPPORTS' AND actual = 'SUPPORTS') AS tp, count(*) FILTER (said = 'SUPPORTS') AS sd, count(*) FILTER (actual = 'SUPPORTS') AS tr, count(*) FILTER (said = 'SUPPORTS' AND actual = 'RELATED') AS w, count(*) FILTER (actual = 'RELATED') AS rel FROM b) SELECT n, {_R.format(a='r', b='n')} AS accuracy, {_R.format(a='tp', b='sd')} AS supports_precision, {_R.format(a='tp', b='tr')} AS supports_recall, {_R.format(a='w', b='rel')} AS false_positive_rate FROM c",
    "judge_penalties": f"WITH {_MARK}, b AS (SELECT {_FOUR}[toxic + 1] AS actual, {_FOUR}[CAST(says_bad AS INTEGER) + 1] AS said FROM mk) SELECT actual, CAST(sum(CASE WHEN said = actual THEN 1 WHEN said = 'SUPPORTS' AND actual = 'RELATED' THEN -2 ELSE 0 END) AS BIGINT) AS points, count(*) AS n FROM b GROUP BY actual",
    "label_distribution": "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic",
    "deterministic_split": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42' || doc_id), doc_id) <= floor(0.7 * (SELECT count(*) FROM labels)) THEN 'train' ELSE 'val' END AS part FROM labels",
    "segment_offsets": f"WITH {_OFF} SELECT conv_id, turn, start_pos, start_pos + size AS end_pos FROM off",
    "segment_join_text": "SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS full_text FROM conversations GROUP BY conv_id",
    "span_overlap_pairs": f"WITH {_SPAN}, o AS (SELECT a.id AS left_id, b.id AS right_id, (least(a.e, b.e) - greatest(a.s, b.s)) / CAST(least(a.e - a.s, b.e - b.s) AS DOUBLE) AS ov FROM sp a JOIN sp b ON a.conv_id = b.conv_id AND a.id < b.id AND a.s < b.e AND b.s < a.e AND a.e > a.s AND b.e > b.s) SELECT left_id, right_id, round(ov, 6) AS overlap FROM o WHERE ov >= 0.25",
    "same_quotes": f"WITH {_SPAN.replace('SELECT conv_id, conv_id * 100', 'SELECT text, size, conv_id, conv_id * 100')}, q AS (SELECT conv_id, id, s, e, text FROM sp UNION ALL SELECT conv_id, id + 50, e + 1, e + 1 + length(text), text FROM sp WHERE length(text) < 25), t AS (SELECT *, {token_set('text')} AS bag FROM q) SELECT a.id AS left_id, b.id AS right_id FROM t a JOIN t b ON a.conv_id = b.conv_id AND a.id < b.id WHERE (a.e > a.s AND b.e > b.s AND a.s < b.e AND b.s < a.e AND (least(a.e, b.e) - greatest(a.s, b.s)) / CAST(least(a.e - a.s, b.e - b.s) AS DOUBLE) >= 0.5) OR (abs(a.s - b.s) < 20 AND len(a.bag) > 0 AND len(b.bag) > 0 AND len(list_intersect(a.bag, b.bag)) / CAST(len(a.bag) + len(b.bag) - len(list_intersect(a.bag, b.bag)) AS DOUBLE) >= 0.8)",
    "quote_dedup_fold": f"{_fold('(id % 10) / 10.0::DOUBLE')} SELECT conv_id, k.id AS quote_id, k.s AS start_pos, k.e AS end_pos, k.score, array_to_string(k.merged, ',') AS merged FROM kept",
    "quote_remap": f"{_fold('0.5::DOUBLE')} SELECT DISTINCT m % 7 AS claim_id, kept_id FROM (SELECT k.id AS kept_id, unnest(k.merged) AS m FROM kept)",
    "cosine_self_join": f"SELECT a.vec_id AS left_id, b.vec_id AS right_id, round({_COS}, 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_COS} >= 0.3",
    "cosine_topk": f"SELECT a.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, b.vec_id, round(greatest(0, least(1, {_COS})), 6) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0 WINDOW w AS (PARTITION BY a.vec_id ORDER BY greatest(0, least(1, {_COS})) DESC, b.vec_id) QUALIFY row_number() OVER w <= 30",
    "l2_knn_other_group": f"SELECT a.vec_id AS query_id, CAST(row_number() OVER w AS INTEGER) AS rank, b.vec_id, round({_DIST}, 6) AS distance FROM embeddings a JOIN embeddings b ON a.label <> b.label WHERE {_DIST} < 1.3 WINDOW w AS (PARTITION BY a.vec_id ORDER BY {_DIST}, b.vec_id) QUALIFY row_number() OVER w <= 10",
    "dup_components": f"WITH RECURSIVE p AS (SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE {_COS} >= 0.36), r AS (SELECT vec_id AS n, vec_id AS m FROM embeddings UNION SELECT r.n, p.v FROM r JOIN p ON r.m = p.u) SELECT n AS vec_id, min(m) AS component FROM r GROUP BY n",
    "merge_representative": r"WITH t AS (SELECT doc_id, source, text, md5(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}_ \t\n\r\f\v]', '', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))) AS group_key FROM documents) SELECT group_key, arg_max(doc_id, {'a': length(text), 'b': -doc_id}) AS representative, array_to_string(list_sort(list(DISTINCT source)), ',') AS chunks, count(*) AS n_members FROM t GROUP BY group_key",
}
