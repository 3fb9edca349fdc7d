"""Text queries over documents, conversations and benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import words as W
from ..operators import claims as C
from ..operators.similarity import jaccard_join
from .common import SENTENCES, TOKENS, contains_any, quoted, table, token_set

_FIRST = r"'^\p{Ll}'"
_NAMED = "len(list_filter({k}[2:], lambda w: regexp_matches(w, '^\\p{{Lu}}.') AND lower(w) NOT IN (" + quoted(W.SMALL_WORDS) + "))) > 0"
_DATED = r"regexp_matches(lower(s), '(^|[^\p{L}\p{N}_])((19|20)[0-9]{2}|" + "|".join(dict.fromkeys(W.MONTHS + W.SHORT_MONTHS)) + r")([^\p{L}\p{N}_]|$)')"
_REASON = f"CASE WHEN len(k) < 5 THEN 'short' WHEN len(k) > 40 THEN 'long' WHEN regexp_matches(s, '[0-9]') OR {_NAMED.format(k='k')} OR {_DATED} THEN 'valid' ELSE 'vague' END"
_ROWS = f"""p AS (SELECT doc_id, lang, source, {SENTENCES.format(t='text')} AS ss FROM documents),
e AS (SELECT doc_id, lang, source, unnest(ss) AS s, generate_subscripts(ss, 1) - 1 AS pos FROM p), t AS (SELECT *, {TOKENS.format(t='s')} AS k FROM e),
r AS (SELECT *, {_REASON} AS claim, CASE WHEN regexp_matches(s, {_FIRST}) THEN 'lower' ELSE {_REASON} END AS reason FROM t)"""


def claim_rows() -> str:
    """DuckDB CTEs that end in ``r``: a row per sentence of documents with its reason."""
    return _ROWS


def claim_funnel_by_lang(spark, sf_dir):
    """Sentences per language through the claim filters, in their order, and what the cap keeps."""
    judged = C.judged_claims(C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "lang", "text")))
    per_doc = judged.groupBy("doc_id", "lang").agg(F.count("*").alias("n"), *[F.count_if(F.col("reason") == r).alias(r) for r in ("lower", "short", "long", "vague", "valid")])
    return per_doc.groupBy("lang").agg(F.sum("n").alias("sentences"), *[F.sum(r).alias(f"n_{r}") for r in ("lower", "short", "long", "vague", "valid")], F.sum(F.least("valid", F.lit(10))).alias("n_capped"))


def sentence_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(F.size(X.sentences(F.col("text")))).cast("long").alias("n_sentences"))


def sentence_windows(spark, sf_dir):
    return C.sentence_windows(table(spark, sf_dir, "documents").select("doc_id", "text"))


def claim_validity_reason(spark, sf_dir):
    rows = C.sentence_rows(table(spark, sf_dir, "documents").select("lang", "text"))
    return rows.groupBy("lang", X.claim_reason(F.col("sentence")).alias("reason")).agg(F.count("*").alias("n"))


def longest_k_per_group(spark, sf_dir):
    return C.valid_claims(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id").select("doc_id", "pos", "sentence")


def question_filter(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", X.is_question(F.col("text")).alias("is_question"))


def quote_quality_reason(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy(X.quote_reason(F.col("text")).alias("reason")).agg(F.count("*").alias("n"))


def _scored(issue):
    def query(spark, sf_dir):
        rows = C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))
        return rows.groupBy("doc_id").agg(F.count("*").alias("n_claims"), F.round(1 - F.avg(issue(F.col("sentence")).isNotNull().cast("double")), 6).alias("score"))

    return query


def obvious_issue_hist(spark, sf_dir):
    rows = C.sentence_rows(table(spark, sf_dir, "documents").select("text"))
    s = F.col("sentence")
    return rows.groupBy(F.coalesce(X.obvious_issue(s), F.lit("none")).alias("issue"), X.needs_judge(s).alias("needs_judge")).agg(F.count("*").alias("n"))


def jaccard_pairs(spark, sf_dir):
    out = jaccard_join(table(spark, sf_dir, "benchmark"), "item_id", "text", 0.1)
    return out.withColumn("jaccard", F.round("jaccard", 6))


def jaccard_near_dup_docs(spark, sf_dir):
    """Documents of alike token sets, whatever their source; copies pair with the first of them."""
    out = jaccard_join(table(spark, sf_dir, "documents"), "doc_id", "text", 0.8, stars=True)
    return out.withColumn("jaccard", F.round("jaccard", 6))


def filter_samples(spark, sf_dir):
    """The first 5 rejected sentences of each reason."""
    judged = C.judged_claims(C.sentence_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))).where("reason <> 'valid'")
    return C.top_by(judged, ["reason"], [F.col("doc_id"), F.col("pos")], 5).select("reason", "doc_id", "pos", "sentence")


def prompt_batches(spark, sf_dir):
    """Numbered claim lists of ten."""
    rows = table(spark, sf_dir, "benchmark").withColumn("batch", F.floor(F.col("item_id") / 10)).groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("item_id", "text"))).alias("items"))
    return rows.select("batch", F.array_join(F.transform("items", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["text"])), "\n").alias("prompt"))


def non_empty_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.agg(F.count("*").alias("n_rows"), *[F.count_if(X.trimmed(F.col(c).cast("string")) != "").alias(f"n_{c}") for c in ("doc_id", "text", "lang", "source")])


def split_repair(spark, sf_dir):
    """Turn pieces at apostrophes put together again."""
    turns = table(spark, sf_dir, "conversations")
    pieces = F.filter(F.split(F.regexp_replace("text", " ([a-z]{1,4}) ", "\x01s $1 "), "\x01"), lambda x: x != "")
    return turns.select("conv_id", "turn", X.repaired_claims(pieces).alias("r")).select("conv_id", "turn", F.size("r").alias("n_items"), F.array_join("r", "|").alias("items"))


def fence_json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\n")).alias("answer"), "props")
    return events.select("event_id", X.fenced(F.col("answer")).alias("inner_json"))


def lenient_bool_float(spark, sf_dir):
    """Answers as models give them: of an event's type, and its value, now and then with words around."""
    said = F.when(F.col("event_type") == "click", " Yes ").when(F.col("event_type") == "view", "true").when(F.col("event_type") == "signup", "1").otherwise(F.col("event_type"))
    number = F.when(F.col("value") > 20, F.concat(F.lit("about "), F.col("value").cast("string"))).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", X.lenient_bool(said).alias("flag"), F.round(X.lenient_float(number), 6).alias("confidence"))


def _has_word_sql(listed):
    return f"regexp_matches(' ' || lower(s) || ' ', ' ({'|'.join(listed)}) ')".replace("he's", "he''s").replace("she's", "she''s").replace("they're", "they''re").replace("it's", "it''s")


_PRON = _has_word_sql(W.PRONOUNS)
_ISSUE = f"{_PRON} OR {contains_any('lower(s)', W.VAGUE)} OR {contains_any('lower(s)', W.OPINION)} OR {contains_any('lower(s)', W.ADVERT)} OR {contains_any('lower(s)', W.NO_CONTEXT)}"
_STRICT = f"{_PRON} OR {contains_any('lower(s)', W.VAGUE)} OR {contains_any('lower(s)', W.STRICT_OPINION)} OR {contains_any('lower(s)', W.STRICT_ADVERT)} OR contains(s, '?') OR len(k) < 5 OR len(k) > 40 OR {contains_any('lower(s)', W.STRICT_CONTEXT)}"
_OBVIOUS = f"CASE WHEN {contains_any('lower(s)', W.OBVIOUS_ADVERT)} THEN 'advertisement' WHEN contains(s, '?') THEN 'question' WHEN len(k) < 5 THEN 'too_short' WHEN regexp_matches(s, '^({'|'.join(W.START_PRONOUNS)})[ \\t\\n\\r\\f\\v]') THEN 'pronoun_at_start' WHEN starts_with(lower(s), 'the new ') OR starts_with(lower(s), 'the ban ') THEN 'vague_reference' ELSE 'none' END"
_QUESTION_FIRST = r"regexp_replace(coalesce(list_filter(string_split_regex(lower(text), '[ \t\n\r\f\v]+'), lambda x: x <> '')[1], ''), '^[.,!?;:\"'']+|[.,!?;:\"'']+$', '', 'g')"
_PROMO = "CASE WHEN length(text) < 50 THEN 'Too short' " + " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{r}'" for p, r in W.PROMOTIONS) + " ELSE 'valid' END"


def _pairs_sql(source: str, key: str, threshold: float) -> str:
    return f"""WITH t AS (SELECT {key}, {token_set('text')} AS s FROM {source}),
j AS (SELECT a.{key} AS left_id, b.{key} AS right_id, len(list_intersect(a.s, b.s)) AS c, len(a.s) AS na, len(b.s) AS nb FROM t a JOIN t b ON a.{key} < b.{key} WHERE len(a.s) > 0 AND len(b.s) > 0
  AND least(len(a.s), len(b.s)) >= {threshold} * greatest(len(a.s), len(b.s)))
SELECT left_id, right_id, round(c / (na + nb - c), 6) AS jaccard FROM j WHERE c / (na + nb - c) >= {threshold}"""


QUERIES = {
    "claim_funnel_by_lang": claim_funnel_by_lang,
    "sentence_count": sentence_count,
    "sentence_windows": sentence_windows,
    "claim_validity_reason": claim_validity_reason,
    "longest_k_per_group": longest_k_per_group,
    "question_filter": question_filter,
    "quote_quality_reason": quote_quality_reason,
    "rule_quality_score": _scored(X.quality_issue),
    "strict_quality_score": _scored(X.strict_issue),
    "obvious_issue_hist": obvious_issue_hist,
    "jaccard_pairs": jaccard_pairs,
    "jaccard_near_dup_docs": jaccard_near_dup_docs,
    "filter_samples": filter_samples,
    "prompt_batches": prompt_batches,
    "non_empty_profile": non_empty_profile,
    "split_repair": split_repair,
    "fence_json_extract": fence_json_extract,
    "lenient_bool_float": lenient_bool_float,
}

ORACLE_SQL = {
    "claim_funnel_by_lang": f"WITH {_ROWS}, d AS (SELECT doc_id, lang, count(*) AS n, " + ", ".join(f"count(*) FILTER (reason = '{x}') AS n_{x}" for x in ("lower", "short", "long", "vague", "valid")) + " FROM r GROUP BY doc_id, lang) SELECT lang, CAST(sum(n) AS BIGINT) AS sentences, " + ", ".join(f"CAST(sum(n_{x}) AS BIGINT) AS n_{x}" for x in ("lower", "short", "long", "vague", "valid")) + ", CAST(sum(least(n_valid, 10)) AS BIGINT) AS n_capped FROM d GROUP BY lang",
    "sentence_count": f"SELECT lang, CAST(sum(len({SENTENCES.format(t='text')})) AS BIGINT) AS n_sentences FROM documents GROUP BY lang",
    "sentence_windows": f"WITH {_ROWS} SELECT doc_id, CAST(pos AS INTEGER) AS window_no, s || coalesce(' ' || lead(s) OVER (PARTITION BY doc_id ORDER BY pos), '') AS window_text FROM r",
    "claim_validity_reason": f"WITH {_ROWS} SELECT lang, claim AS reason, count(*) AS n FROM r GROUP BY lang, claim",
    "longest_k_per_group": f"WITH {_ROWS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, s AS sentence FROM r WHERE reason = 'valid' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(s) DESC, pos) <= 10",
    "question_filter": f"SELECT conv_id, turn, contains(text, '?') OR ({_QUESTION_FIRST} IN ({quoted(W.QUESTION_WORDS)}) AND NOT {contains_any('lower(text)', W.NOT_QUESTIONS)}) AS is_question FROM conversations",
    "quote_quality_reason": f"SELECT {_PROMO} AS reason, count(*) AS n FROM conversations GROUP BY 1",
    "rule_quality_score": f"WITH {_ROWS} SELECT doc_id, count(*) AS n_claims, round(1 - avg(CAST(({_ISSUE}) AS INTEGER)), 6) AS score FROM r GROUP BY doc_id",
    "strict_quality_score": f"WITH {_ROWS} SELECT doc_id, count(*) AS n_claims, round(1 - avg(CAST(({_STRICT}) AS INTEGER)), 6) AS score FROM r GROUP BY doc_id",
    "obvious_issue_hist": f"WITH {_ROWS} SELECT {_OBVIOUS} AS issue, {_OBVIOUS} = 'none' AND regexp_matches(lower(s), '(^|[^\\p{{L}}\\p{{N}}_])({'|'.join(W.JUDGED_PRONOUNS)})([^\\p{{L}}\\p{{N}}_]|$)') AS needs_judge, count(*) AS n FROM r GROUP BY 1, 2",
    "jaccard_pairs": _pairs_sql("benchmark", "item_id", 0.1),
    "jaccard_near_dup_docs": f"""WITH d AS (SELECT doc_id, list_sort({token_set('text')}) AS s FROM documents), t AS (SELECT s, min(doc_id) AS doc_id FROM d WHERE len(s) > 0 GROUP BY s),
j AS (SELECT a.doc_id AS left_id, b.doc_id AS right_id, len(list_intersect(a.s, b.s)) AS c, len(a.s) AS na, len(b.s) AS nb FROM t a JOIN t b ON a.doc_id < b.doc_id AND least(len(a.s), len(b.s)) >= 0.8 * greatest(len(a.s), len(b.s)))
SELECT left_id, right_id, round(c / (na + nb - c), 6) AS jaccard FROM j WHERE c / (na + nb - c) >= 0.8 UNION ALL SELECT t.doc_id, d.doc_id, 1.0::DOUBLE FROM d JOIN t ON d.s = t.s WHERE d.doc_id <> t.doc_id""",
    "filter_samples": f"WITH {_ROWS} SELECT reason, doc_id, CAST(pos AS INTEGER) AS pos, s AS sentence FROM r WHERE reason <> 'valid' QUALIFY row_number() OVER (PARTITION BY reason ORDER BY doc_id, pos) <= 5",
    "prompt_batches": "WITH n AS (SELECT item_id // 10 AS batch, item_id, text, row_number() OVER (PARTITION BY item_id // 10 ORDER BY item_id) AS k FROM benchmark) SELECT batch, string_agg(k || '. ' || text, chr(10) ORDER BY k) AS prompt FROM n GROUP BY batch",
    "non_empty_profile": "SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (trim(CAST({c} AS VARCHAR)) <> '') AS n_{c}" for c in ("doc_id", "text", "lang", "source")) + " FROM documents",
    "fence_json_extract": "SELECT event_id, trim(props) AS inner_json FROM events",
    "lenient_bool_float": "SELECT event_id, coalesce(event_type IN ('click', 'view', 'signup'), false) AS flag, CASE WHEN value <= 20 THEN round(value, 6) ELSE 0.5 END AS confidence FROM events",
    "split_repair": r"""WITH RECURSIVE p AS (SELECT conv_id, turn, list_filter(string_split(regexp_replace(text, ' ([a-z]{1,4}) ', chr(1) || 's \1 ', 'g'), chr(1)), lambda x: x <> '') AS ps FROM conversations),
w AS (SELECT conv_id, turn, ps, CAST([] AS VARCHAR[]) AS done, 1 AS i FROM p
  UNION ALL SELECT conv_id, turn, ps, CASE WHEN j THEN list_append(done, trim(ps[i], chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) || chr(39) || ps[i + 1]) ELSE list_append(done, ps[i]) END, CASE WHEN j THEN i + 2 ELSE i + 1 END
  FROM (SELECT *, i < len(ps) AND starts_with(coalesce(ps[i + 1], ''), 's ') AND length(trim(ps[i], chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))) < 30 AS j FROM w) WHERE i <= len(ps))
SELECT conv_id, turn, CAST(len(done) AS INTEGER) AS n_items, array_to_string(done, '|') AS items FROM w WHERE i > len(ps)""",
}
