"""Quality rules with thresholds that adapt to each language and source.

Every text is reduced to a few counts.  Each derived signal is summarised per (language, source) by a mergeable
quantile sketch: a histogram over log-spaced buckets (the six leading bits of an integer), so sketches merge by adding
counts, the quantiles are exact to one part in 32, and neither partitioning nor retries change the outcome.  To the sketch
of a group, that of its language is added with the weight of ``PRIOR`` documents, and to that of a language the sketch of
everything in the same way: what few documents say moves a threshold little, what many say decides it, and no size of a
group is a limit.  A document is rejected if a signal lies beyond ``median + reach * max(upper quartile - median, slack)``
of its group.

Everything is DataFrame expressions; the only shuffle carries pre-aggregated bucket counts.  The thresholds are computed
first and join back on (language, source): by broadcast if they are few, so that no text moves; else by a shuffle in
which adaptive execution splits a hot source.

Defined results: a null or empty text has no words; a text of any length counts whole; a value at its threshold is kept; a
null language or source is a group of its own; an empty table gives an empty result; repeated rows are judged alike, each
on its own; input columns named like an output are replaced, all others kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE_CLASS, guarded, let, replacing, sized, stored, table

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUTS = (*COUNTS, "base_failed", "kept")

#: Signals in units of 1/10000 (word length: 1/100), with the least spread that counts as one.
SIGNALS = {"symbols": 40, "dup_lines": 500, "repeats": 600, "upper": 400, "long_words": 60}
REACH = 8
#: Documents that the larger group's sketch counts for in a smaller one's, and the units that a document is counted in.
PRIOR, UNITS = 200, 1 << 20


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    Most texts have none, which distinct hashes prove.  Otherwise 33 hash bits and the position share one long; sorting
    those finds candidate windows cheaply, and only the candidates are compared as strings, so the count is exact and
    costs n log n.
    """

    def window(i: Column) -> Column:
        return F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def neighbours(items: Column, key) -> Column:
        return F.filter(items, lambda x, k: (key(x) == key(F.get(items, k - 1))) | (key(x) == key(F.get(items, k + 1))))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
            F.lit(0),
            lambda total, x: total + x,
        )

    def exact(candidates: Column) -> Column:
        spelled = F.sort_array(
            F.transform(
                candidates,
                lambda x: let(x.bitwiseAND(F.lit(2**31 - 1)).cast("int"), lambda i: F.struct(window(i).alias("g"), i.alias("i"))),
            )
        )
        return let(
            spelled,
            lambda s: let(F.sort_array(F.transform(neighbours(s, lambda e: e["g"]), lambda e: e["i"])), covered),
        )

    def candidates(hashes: Column) -> Column:
        packed = F.sort_array(F.transform(hashes, lambda x, i: F.shiftleft(x, 31).bitwiseOR(i.cast("long"))))
        return let(packed, lambda p: neighbours(p, lambda x: F.shiftright(x, 31)))

    found = let(
        F.transform(F.sequence(F.lit(0), F.size(words) - 3), hashed),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), let(candidates(h), exact)).otherwise(0),
    )
    return F.when(F.size(words) >= 3, found).otherwise(0).cast("long")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__words`` reduced to the counts, and the two further numbers that the signals need."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(whole, f"[{SPACE_CLASS}]+"), "")
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(f"[^{SPACE_CLASS}]"))
    counted = docs.select(
        "*",
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                _repeat_words(w).alias("n_repeat_words"),
            ),
        ).alias("__w"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("__l"),
        F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("long").alias("__upper"),
    )
    return counted.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col("__w.n_words").alias("n_words"),
        F.col("__w.word_chars").alias("word_chars"),
        "n_symbols",
        F.col("__l.dup").alias("n_dup_lines"),
        F.col("__w.n_repeat_words").alias("n_repeat_words"),
        F.col("__l.n").alias("__lines"),
        "__upper",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _signals() -> dict[str, Column]:
    def share(part: str, whole: str, unit: int = 10_000) -> Column:
        return F.expr(f"coalesce(try_divide({unit} * {part}, {whole}), 0)").cast("long")

    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "__lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "upper": share("__upper", "word_chars"),
        "long_words": share("word_chars", "n_words", 100),
    }


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: its six leading bits, the others zero."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(scored: DataFrame, lang: str, source: str) -> DataFrame:
    """One row per (language, source, signal, bucket) with its count; counts of equal buckets add up to a merged sketch."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("signal"), bucket(F.col(f"__s.{name}")).alias("bucket")) for name in SIGNALS]))
    long = scored.where(~F.col("base_failed")).select(F.col(lang).alias("lang"), F.col(source).alias("source"), each.alias("e"))
    return long.groupBy("lang", "source", F.col("e.signal").alias("signal"), F.col("e.bucket").alias("bucket")).agg(F.count("*").alias("n"))


def _shrunk(own: DataFrame, larger: DataFrame, keys: list[str]) -> DataFrame:
    """The sketch of each group of ``keys`` in ``UNITS``, with the ``larger`` one (of all but the last key) as ``PRIOR`` more documents."""
    over = keys[:-1]
    share = F.col("n").cast("double") / F.sum("n").over(Window.partitionBy(*over, "signal")).cast("double")
    prior = larger.select(*[F.col(k).alias(f"of_{k}") for k in over], F.col("signal").alias("of"), "bucket", F.floor(share * (PRIOR * UNITS)).cast("long").alias("n"))
    same = F.col("signal") == F.col("of")
    for k in over:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))
    each = own.select(*keys, "signal").distinct().join(prior, same).select(*keys, "signal", "bucket", "n")
    return each.unionByName(own.select(*keys, "signal", "bucket", (F.col("n") * UNITS).alias("n"))).groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def _fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The fence of every signal for each group of ``keys``, as a map."""
    group = Window.partitionBy(*keys, "signal")
    ranked = sketch.select(
        *keys, "signal", "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("rows"),
    )
    quartiles = ranked.groupBy(*keys, "signal").agg(
        F.min(F.when(2 * F.col("upto") >= F.col("rows"), F.col("bucket"))).alias("mid"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("rows"), F.col("bucket"))).alias("high"),
    )
    slack = F.create_map(*[F.lit(x) for pair in SIGNALS.items() for x in pair])
    fence = F.col("mid") + REACH * F.greatest(F.col("high") - F.col("mid"), slack[F.col("signal")])
    return quartiles.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("signal", fence.alias("fence")))).alias("fences"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (language, source): the fences to use there."""

    def merged(*keys: str) -> DataFrame:
        return sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))

    of_lang = _shrunk(merged("lang"), merged(), ["lang"])
    fences = _fences(_shrunk(sketch, of_lang, ["lang", "source"]), ["lang", "source"])
    return fences.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.col("fences").alias("__fences"))


@guarded
def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", drop_text: bool = False) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``; without the text if ``drop_text``."""
    counted = text_counts(replacing(docs, *OUTPUTS), text).withColumn("base_failed", base_failed())
    scored = counted.withColumn("__s", F.struct(*[c.alias(n) for n, c in _signals().items()])).drop("__lines", "__upper")
    scored = stored(scored.drop(text) if drop_text else scored, "quality")
    limits = sized(thresholds(sketches(scored, lang, source)))
    joined = scored.join(limits, F.col(lang).eqNullSafe(limits["__lang"]) & F.col(source).eqNullSafe(limits["__source"]), "left")
    beyond = [F.coalesce(F.col(f"__s.{name}") > F.col("__fences")[name], F.lit(False)) for name in SIGNALS]
    rejected = F.col("base_failed")
    for one in beyond:
        rejected = rejected | one
    return joined.withColumn("kept", ~rejected).drop("__s", "__lang", "__source", "__fences")


def quality_filter(docs: DataFrame, **names: str) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judged(docs, **names).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judged(docs, drop_text=True).select("doc_id", *OUTPUTS)


_SIGNAL_SQL = {
    "symbols": "10000 * n_symbols / nullif(word_chars, 0)",
    "dup_lines": "10000 * n_dup_lines / nullif(n_lines, 0)",
    "repeats": "10000 * n_repeat_words / nullif(n_words, 0)",
    "upper": "10000 * n_upper / nullif(word_chars, 0)",
    "long_words": "100 * word_chars / nullif(n_words, 0)",
}


def _oracle() -> str:
    unpivot = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, base_failed, '{n}' AS signal, {SIGNALS[n]} AS slack, coalesce(CAST(trunc({e}) AS BIGINT), 0) AS v FROM f" for n, e in _SIGNAL_SQL.items()
    )

    def shrunk(own: str, larger: str, keys: list[str]) -> str:
        listed = "".join(f"g.{k}, " for k in keys)
        over = ", ".join([*keys[:-1], "signal"])
        same = " AND ".join(["g.signal = p.signal", *[f"g.{k} IS NOT DISTINCT FROM p.{k}" for k in keys[:-1]]])
        prior = f"SELECT *, CAST(floor((CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY {over}) AS DOUBLE)) * {PRIOR * UNITS}) AS BIGINT) AS m FROM {larger}"
        return (
            f"SELECT {', '.join(keys)}, signal, slack, b, CAST(sum(n) AS BIGINT) AS n FROM (SELECT {', '.join(keys)}, signal, slack, b, n * {UNITS} AS n FROM {own} "
            f"UNION ALL SELECT {listed}g.signal, g.slack, p.b, p.m FROM (SELECT DISTINCT {', '.join(keys)}, signal, slack FROM {own}) g JOIN ({prior}) p ON {same}) GROUP BY ALL"
        )

    over = "PARTITION BY lang, source, signal, slack"
    fence = (
        f"SELECT lang, source, signal, min(b) FILTER (2 * upto >= rows) + {REACH} * greatest(min(b) FILTER (4 * upto >= 3 * rows) - min(b) FILTER (2 * upto >= rows), slack) AS fence "
        f"FROM (SELECT *, sum(n) OVER ({over} ORDER BY b) AS upto, sum(n) OVER ({over}) AS rows FROM w) GROUP BY lang, source, signal, slack"
    )

    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
t1 AS (SELECT *, regexp_extract_all(text, '[^ \t-\r]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM t),
g AS (SELECT *, row_number() OVER () AS rid, [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)] AS grams FROM t1),
x AS (SELECT rid, unnest(grams) AS gram, generate_subscripts(grams, 1) AS i FROM g),
hit AS (SELECT rid, i FROM x QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
rep AS (SELECT rid, count(DISTINCT i + o) AS n_repeat_words FROM hit, (VALUES (0), (1), (2)) v(o) GROUP BY rid),
f AS (SELECT doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
  len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed FROM g LEFT JOIN rep USING (rid)),
s AS ({unpivot}),
k AS (SELECT lang, source, signal, slack, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b, count(*) AS n FROM s WHERE NOT base_failed GROUP BY ALL),
ka AS (SELECT signal, slack, b, sum(n) AS n FROM k GROUP BY ALL), kl AS (SELECT lang, signal, slack, b, sum(n) AS n FROM k GROUP BY ALL),
lw AS ({shrunk("kl", "ka", ["lang"])}), w AS ({shrunk("k", "lw", ["lang", "source"])}), lim AS ({fence}),
bad AS (SELECT DISTINCT s.doc_id FROM s JOIN lim ON s.lang IS NOT DISTINCT FROM lim.lang AND s.source IS NOT DISTINCT FROM lim.source AND s.signal = lim.signal WHERE v > fence)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept
FROM f LEFT JOIN bad ON f.doc_id = bad.doc_id"""


QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLE_SQL = {"op1_quality_rules": _oracle()}
