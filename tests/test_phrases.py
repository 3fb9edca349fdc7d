"""Phrases are searched as bytes, with the results of the regular expressions that they stand for."""

import random
import re

from pyspark.sql import functions as F

from evidra.functions import text as X
from evidra.functions import words as W


def test_phrases_and_words_equal_their_expressions(spark):
    rng = random.Random(1)
    listed = W.PRONOUNS + W.VAGUE + W.OPINION + W.ADVERT + W.NO_CONTEXT
    texts = ["", "it", "only $5", "ONLY $ 3", "he\tshe", "xit it's", *[" ".join(rng.choice([*listed, "É", "a.b", "word", "The"]) for _ in range(rng.randrange(1, 7))) for _ in range(300)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string")
    low = F.lower("t")
    got = {r.i: (r.a, r.w) for r in df.select("i", X.any_of(low, W.ADVERT).alias("a"), X._has_word(low, W.PRONOUNS).alias("w")).collect()}
    phrase, word = (re.compile("|".join(map(re.escape, x))) for x in (W.ADVERT, W.PRONOUNS))
    word = re.compile(f" ({word.pattern}) ")
    assert got.pop(-1) == (None, None)
    assert got == {i: (bool(phrase.search(t.lower())), bool(word.search(f" {t.lower()} "))) for i, t in enumerate(texts)}


def test_judging_tries_no_expression_at_every_character(spark):
    assert "rlike" not in str(X.quality_issue(F.col("t"))).lower()
