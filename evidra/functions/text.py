"""Text as Column expressions: sentences, validity with reasons, quality rules, token sets, lenient readers, stamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import words as W

SPACE = r"[ \t\n\r\f\x0B]"
MARK = "\x01"


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\f\x0b"))


def tokens(text: Column) -> Column:
    """White-space separated tokens, none of them empty."""
    return F.filter(F.split(text, SPACE + "+"), lambda x: x != "")


def any_of(text: Column, phrases: list[str]) -> Column:
    """Whether ``text`` contains one of the phrases; a search of bytes for each, as an expression of them all is tried anew at every character."""
    return reduce(Column.__or__, [text.contains(p) for p in phrases])


def sentences(text: Column) -> Column:
    """Split after . ! ? and white space; the mark stays; sentences without a body are left out."""
    parts = F.split(F.regexp_replace(text, rf"([.!?]){SPACE}+", f"$1{MARK}"), MARK)
    return F.filter(F.transform(parts, trimmed), lambda x: (F.length(x) > 0) & ~x.rlike(r"^[.!?]$"))


def _tokens_from(text: Column, n: int) -> Column:
    """Whether a text has ``n`` tokens or more."""
    word = SPACE.replace("[", "[^", 1)
    return text.rlike(rf"^{SPACE}*+(?:{word}++{SPACE}++){{{n - 1}}}{word}")


def claim_reason(claim: Column) -> Column:
    """Why a claim is rejected: ``short``, ``long`` or ``vague``; ``valid`` if it is not.

    Expressions over the whole text find what tokens would tell, as functions of each token are interpreted; a year has a digit anyway.
    """
    low, small = F.lower(claim), "|".join(W.SMALL_WORDS)
    named = trimmed(claim).rlike(rf"{SPACE}(?=\p{{Lu}}[^ \t\n\r\f\x0B\x85\u2028\u2029])(?!(?i:{small})(?:{SPACE}|\z))")
    months = low.rlike(rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(dict.fromkeys(W.MONTHS + W.SHORT_MONTHS))})([^\p{{L}}\p{{N}}_]|$)")
    known = claim.rlike("[0-9]") | named | (any_of(low, W.SHORT_MONTHS) & months)
    return F.when(~_tokens_from(claim, 5), "short").when(_tokens_from(claim, 41), "long").when(known, "valid").otherwise("vague")


def starts_lower(claim: Column) -> Column:
    return claim.rlike(r"^\p{Ll}")


def is_question(text: Column) -> Column:
    low = F.lower(text)
    first = F.regexp_replace(F.coalesce(F.regexp_extract(low, rf"^{SPACE}*+([^{SPACE[1:]}*+)", 1), F.lit("")), r"^[.,!?;:\"']+|[.,!?;:\"']+$", "")
    return text.contains("?") | (first.isin(W.QUESTION_WORDS) & ~any_of(low, W.NOT_QUESTIONS))


def quote_reason(text: Column) -> Column:
    """Why a quote is rejected; ``valid`` if it is not.  The first promotional pattern names the reason."""
    low = F.lower(text)
    out = F.when(F.length(text) < 50, F.lit("Too short"))
    for (pattern, reason), marks in zip(W.PROMOTIONS, W.PROMOTION_MARKS, strict=True):
        out = out.when(any_of(low, marks) & low.rlike(pattern), reason)
    return out.otherwise("valid")


def _has_word(low: Column, listed: list[str]) -> Column:
    return any_of(F.concat(F.lit(" "), low, F.lit(" ")), [f" {w} " for w in listed])


def quality_issue(claim: Column) -> Column:
    """The first rule that a claim breaks, or null."""
    low = F.lower(claim)
    return F.when(_has_word(low, W.PRONOUNS), "pronoun").when(any_of(low, W.VAGUE), "vague").when(any_of(low, W.OPINION), "opinion").when(any_of(low, W.ADVERT), "advertisement").when(any_of(low, W.NO_CONTEXT), "context")


def strict_issue(claim: Column) -> Column:
    low, n = F.lower(claim), F.size(tokens(claim))
    return (
        F.when(_has_word(low, W.PRONOUNS), "pronoun").when(any_of(low, W.VAGUE), "vague").when(any_of(low, W.STRICT_OPINION), "opinion")
        .when(any_of(low, W.STRICT_ADVERT), "advertisement").when(claim.contains("?"), "question").when(n < 5, "short").when(n > 40, "long")
        .when(any_of(low, W.STRICT_CONTEXT), "context")
    )


def obvious_issue(claim: Column) -> Column:
    low = F.lower(claim)
    return (
        F.when(any_of(low, W.OBVIOUS_ADVERT), "advertisement").when(claim.contains("?"), "question").when(F.size(tokens(claim)) < 5, "too_short")
        .when(trimmed(claim).rlike(f"^({'|'.join(W.START_PRONOUNS)}){SPACE}"), "pronoun_at_start").when(low.startswith("the new ") | low.startswith("the ban "), "vague_reference")
    )


def needs_judge(claim: Column) -> Column:
    """No obvious issue, but a pronoun as a whole word."""
    pronoun = F.lower(claim).rlike(rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(W.JUDGED_PRONOUNS)})([^\p{{L}}\p{{N}}_]|$)")
    return obvious_issue(claim).isNull() & pronoun


def normalized(text: Column) -> Column:
    return trimmed(F.regexp_replace(F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}_ \t\n\r\f\x0B]", ""), SPACE + "+", " "))


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(normalized(text)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def span_overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Intersection over the shorter length; 0 if that is empty."""
    shorter = F.least(e1 - s1, e2 - s2)
    return F.when(shorter <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2)) / shorter)


def lenient_bool(text: Column) -> Column:
    return F.coalesce(F.lower(trimmed(text)).isin("true", "1", "yes"), F.lit(False))


def lenient_float(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.5))


def fenced(text: Column) -> Column:
    """What stands inside a markdown code fence, else the text itself."""
    inside = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(inside != "", inside).otherwise(text)


def json_list(text: Column) -> Column:
    """Tolerant list of strings: leading junk, bullets, single quotes, an embedded or doubly nested list; null if none."""
    plain = F.regexp_replace(text, r"^[\s,;:]+(?=\[)", "")
    embedded = F.regexp_extract(plain, r"(?s)\[.*\]", 0)
    nested = F.get(F.from_json(plain, "array<array<string>>"), F.lit(0))
    bullets = F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\s*[-*•]\s+\S")), lambda x: trimmed(F.regexp_replace(x, r"^\s*[-*•]\s+", "")))

    def strings(x: Column) -> Column:
        return F.from_json(x, "array<string>", {"allowSingleQuotes": "true"})

    listed = F.coalesce(nested, strings(plain), strings(F.nullif(embedded, F.lit(""))))
    return F.when(F.size(bullets) > 0, bullets).otherwise(F.filter(listed, lambda x: x.isNotNull()))


def claims_cell(text: Column) -> Column:
    """A reviewed cell as claims: none, a JSON list of texts or objects, rescued values, or a ;-separated text."""
    none = F.lower(text).rlike("only ads") & F.lower(text).rlike("no claims")
    rescued = F.regexp_extract_all(text, F.lit(r'"claim"\s*:\s*"((?:[^"\\]|\\.)*)"'), F.lit(1))
    listed = F.from_json(text, "array<string>")
    parts = F.filter(F.transform(F.split(text, ";"), trimmed), lambda x: (x != "") & ~F.lower(x).isin("etc", "etc.", "..."))
    return F.when(none, F.array().cast("array<string>")).when(F.size(rescued) > 0, rescued).when(trimmed(text).startswith("["), F.coalesce(listed, parts)).otherwise(parts)


def repaired_claims(items: Column) -> Column:
    """Joins ``s ...`` to a short item before it with an apostrophe, from left to right, each item used once."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(acc: Column, x: Column) -> Column:
        fits = acc["open"].isNotNull() & x.startswith("s ") & (F.length(trimmed(acc["open"])) < 30)
        shut = F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        joined = F.concat(acc["done"], F.array(F.concat(trimmed(acc["open"]), F.lit("'"), x)))
        return F.when(fits, F.struct(joined.alias("done"), F.lit(None).cast("string").alias("open"))).otherwise(F.struct(shut.alias("done"), x.alias("open")))

    return F.aggregate(items, start, step, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def _int(text: Column, pattern: str, group: int = 1) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("int"), F.lit(0))


def seconds_short(stamp: Column) -> Column:
    """``1m 27s``; without hours: a stamp that does not start with minutes or seconds is 0."""
    pattern = r"^(?:(\d+)m)?\s*(?:(\d+)s)?"
    return _int(stamp, pattern, 1) * 60 + _int(stamp, pattern, 2)


def seconds_clock(stamp: Column) -> Column:
    """The first ``[H:]MM:SS``."""
    pattern = r"(?:(\d+):)?(\d+):(\d+)"
    return _int(stamp, pattern, 1) * 3600 + _int(stamp, pattern, 2) * 60 + _int(stamp, pattern, 3)


def seconds_long(stamp: Column) -> Column:
    """``1h 3m 21s``, each part optional."""
    pattern = r"^(?:(\d+)h)?\s*(?:(\d+)m)?\s*(?:(\d+)s)?"
    return _int(stamp, pattern, 1) * 3600 + _int(stamp, pattern, 2) * 60 + _int(stamp, pattern, 3)


def cosine(a: Column, b: Column) -> Column:
    """Clamped to [0, 1]; 0 for a zero vector."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / norm)))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double"))), F.lit(0.0), lambda s, v: s + v))
