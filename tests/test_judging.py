"""Claims are judged by expressions over the whole text, as their tokens would judge them."""

import random
import re

from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.functions import words as W

MONTHS = "|".join(dict.fromkeys(W.MONTHS + W.SHORT_MONTHS))


def reason(claim: str) -> str:
    found = [w for w in re.split("[ \t\n\r\f\x0b]+", claim) if w]
    if not 5 <= len(found) <= 40:
        return "short" if len(found) < 5 else "long"
    named = any(len(w) > 1 and w[0].isupper() and w[1] not in "\x85  " and w.lower() not in W.SMALL_WORDS for w in found[1:])
    dated = re.search(rf"(^|[^\w])((19|20)[0-9]{{2}}|{MONTHS})([^\w]|$)", claim.lower())
    return "valid" if re.search("[0-9]", claim) or named or dated else "vague"


def test_reasons_are_those_of_the_tokens(spark):
    pick = random.Random(3)
    parts = ["And", "THE", "An", "Or,", "A", "Éa", "É", "x", "may", "Mayor", "in-May.", "dec—", "market", "2020", "word", " Ab", "A ", "_may", "\U00010400b", "aNd", "But"]
    gaps = [" ", "  ", "\t", "\n", "\x0b", " "]
    claims = ["".join(pick.choice(gaps) + pick.choice(parts) for _ in range(pick.choice([3, 4, 5, 6, 8, 39, 40, 41, 42]))) for _ in range(600)]
    claims += ["", " ", "a b c d e", " Zed b c d e", "a b c d And", "a b c d Andy", "a b c d E", "a b c d The\n", "a b c maybe decent", " ".join("w" * 40), " ".join("w" * 41)]
    got = spark.createDataFrame(list(enumerate(claims)), "n int, claim string").select("n", X.claim_reason(F.col("claim")).alias("r")).collect()
    assert {r.n: r.r for r in got} == {n: reason(c) for n, c in enumerate(claims)}


def test_no_function_of_each_token_is_interpreted(spark):
    plan = spark.range(1).select(X.claim_reason(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_quotes_are_rejected_by_marked_patterns(spark):
    pick = random.Random(5)
    parts = ["visit", "go to", "check\tout", "site.com", "x.io", "Special", "exclusive", "deal", "offer", "use", "code", "promo", "sign  up", "now", "today", "Subscribe", "hit that subscribe button", "enable", "notifications", "brought to you by", "our", "sponsor", "who", "\"What", "word", "longer words that fill"]
    texts = [" ".join(pick.choice(parts) for _ in range(12)) for _ in range(400)] + ["", " who asks", "?", "short"]
    got = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", X.quote_reason(F.col("t")).alias("r"), X.is_question(F.col("t")).alias("q")).collect()
    want = {n: "Too short" if len(t) < 50 else next((r for p, r in W.PROMOTIONS if re.search(p, t.lower())), "valid") for n, t in enumerate(texts)}
    assert {r.n: r.r for r in got} == want and len(set(want.values())) > 6
    asks = {n: "?" in t or ((t.lower().split() or [""])[0].strip(".,!?;:\"'") in W.QUESTION_WORDS and not any(x in t.lower() for x in W.NOT_QUESTIONS)) for n, t in enumerate(texts)}
    assert {r.n: r.q for r in got} == asks
    plan = spark.range(1).select(X.quote_reason(F.col("id").cast("string")), X.is_question(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("Contains(") + plan.count("Contains (") + plan.count("contains(") >= 13
