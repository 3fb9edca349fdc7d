"""Steps that need a model, behind one shape: a function that adds columns.  The defaults are deterministic expressions.

A replacement takes and returns a DataFrame too, for example with ``mapInArrow`` around a client made once per task.
Score distinct inputs once with ``once``; apply cheap filters before a scorer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

Scorer = Callable[[DataFrame], DataFrame]


def once(df: DataFrame, inputs: list[str], scorer: Scorer) -> DataFrame:
    """Scores each distinct input once and joins the result back."""
    scored = scorer(df.select(*inputs).distinct())
    return df.join(scored, inputs, "left")


def embed(df: DataFrame, text: str = "text", out: str = "embedding", dims: int = 64) -> DataFrame:
    """Hashed token counts, scaled to unit length; zeros for a text without tokens."""
    slots = F.transform(X.tokens(X.normalized(F.col(text))), lambda w: F.pmod(F.xxhash64(w), F.lit(dims)).cast("int"))
    base = df.drop(out)
    names = [*base.columns, out]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found = batch.column(batch.num_columns - 1)
            sizes = np.diff(np.asarray(found.offsets)) * np.asarray(found.is_valid(), np.int64) if len(found) else np.zeros(0, np.int64)
            rows = np.repeat(np.arange(len(found)), sizes)
            counts = np.bincount(rows * dims + np.asarray(found.flatten(), np.int64), minlength=len(found) * dims).reshape(-1, dims).astype(np.float64)
            norm = np.linalg.norm(counts, axis=1, keepdims=True)
            unit = np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * dims), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=names)

    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))])
    return base.select(*[F.col(f"`{c}`") for c in base.columns], slots.alias("slots of the tokens")).mapInArrow(run, schema)


def letters(df: DataFrame, text: str = "text", out: str = "embedding") -> DataFrame:
    """How often each letter from a to z stands in a text, scaled to unit length: a small embedding that SQL can spell out."""
    base = df.drop(out)
    names = [*base.columns, out]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            values = batch.column(batch.num_columns - 1).to_pylist()
            counts = np.zeros((len(values), 26))
            for i, value in enumerate(values):
                if value:
                    found = np.bincount(np.frombuffer(value.encode(), np.uint8), minlength=256)
                    counts[i] = found[97:123] + found[65:91]
            norm = np.linalg.norm(counts, axis=1, keepdims=True)
            unit = np.divide(counts, norm, out=counts, where=norm > 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * 26), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], names=names)

    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    return base.select(*[F.col(f"`{c}`") for c in base.columns], F.col(text).alias("text whose letters count")).mapInArrow(run, schema)


def rerank(df: DataFrame, claim: str = "claim", quote: str = "quote", out: str = "relevance") -> DataFrame:
    """Share of the claim's tokens that the quote has."""
    a, b = X.token_set(F.col(claim)), X.token_set(F.col(quote))
    return df.withColumn(out, F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a).cast("double")), F.lit(0.0)))


def classify_ads(df: DataFrame, text: str = "claim") -> DataFrame:
    """``is_ad`` and ``ad_confidence``; what cannot be told is content."""
    ad = X.any_of(F.lower(F.col(text)), X.W.ADVERT) | ~X.quote_reason(F.rpad(F.col(text), 200, " ")).isin("valid", "Too short")
    return df.withColumn("is_ad", F.coalesce(ad, F.lit(False))).withColumn("ad_confidence", F.when(F.col("is_ad"), 0.95).otherwise(0.0))


#: The confidence of an answer that gives none.
NO_CONFIDENCE_GIVEN = 0.8


def entail(df: DataFrame, claim: str = "claim", quote: str = "quote", supports: float = 0.7, related: float = 0.3) -> DataFrame:
    """``relationship`` by token containment, with its ``entailment_score`` and a ``reasoning``; what cannot be told is NEUTRAL."""
    share = rerank(df, claim, quote, "__share")
    relation = F.when(F.col("__share") >= supports, "SUPPORTS").when(F.col("__share") >= related, "RELATED").otherwise("NEUTRAL")
    told = F.format_string("the quote has %.0f%% of the claim's words", F.col("__share") * 100)
    return share.withColumn("relationship", relation).withColumn("reasoning", told).withColumn("entailment_score", F.col("__share")).drop("__share")


def entailment_answers(df: DataFrame, answer: str = "answer", error: str | None = None) -> DataFrame:
    """``relationship``, ``reasoning`` and ``entailment_score`` from a model's JSON answers.

    An answer without a confidence has ``NO_CONFIDENCE_GIVEN``.  Where there is no answer, or none with a known relationship, or an
    ``error``, the pair is NEUTRAL with confidence 0 and the reason why.
    """
    made = F.from_json(X.fenced(F.col(answer)), "relationship string, reasoning string, confidence string")
    relation = F.upper(X.trimmed(made["relationship"]))
    failed = F.col(error) if error else F.lit(None).cast("string")
    good = failed.isNull() & F.coalesce(relation.isin("SUPPORTS", "RELATED", "NEUTRAL", "CONTRADICTS"), F.lit(False))
    why = F.when(failed.isNotNull(), F.concat(F.lit("Error during validation: "), F.substring(failed, 1, 100))).otherwise("no readable answer")
    score = F.coalesce(made["confidence"].try_cast("double"), F.lit(NO_CONFIDENCE_GIVEN))
    return (
        df.withColumn("relationship", F.when(good, relation).otherwise("NEUTRAL"))
        .withColumn("reasoning", F.when(good, F.coalesce(made["reasoning"], F.lit(""))).otherwise(why))
        .withColumn("entailment_score", F.when(good, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))).otherwise(0.0))
    )


def validate(df: DataFrame, text: str = "claim") -> DataFrame:
    """``is_valid`` by the quality rules; what cannot be told is valid."""
    return df.withColumn("is_valid", X.quality_issue(F.col(text)).isNull())


def keywords(df: DataFrame, key: str, text: str, topics: list[str], most: int = 5) -> DataFrame:
    """The ``most`` words of highest TF-IDF per row, and the topics among its words."""
    from .claims import top_by

    words = df.select(key, F.explode(X.tokens(X.normalized(F.col(text)))).alias("word"))
    tf = words.groupBy(key, "word").agg(F.count("*").alias("tf"))
    seen = tf.groupBy("word").agg(F.count("*").alias("df"))
    total = df.agg(F.count("*")).scalar()
    ranked = top_by(tf.join(seen, "word").withColumn("weight", F.col("tf") * F.log((total + 1) / (F.col("df") + 1))), [key], [F.col("weight").desc(), F.col("word")], most)
    made = ranked.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "word"))), lambda x: x["word"]).alias("keywords"))
    named = df.select(key, F.array_intersect(X.token_set(F.col(text)), F.array(*map(F.lit, topics)) if topics else F.array().cast("array<string>")).alias("topics"))
    return named.join(made, key, "left")


#: What stands before the name of a guest, and a name: two to four capitalised words.
GUEST_CUE = r"(?:[Gg]uests?:? (?:is |are )?|[Ww]elcome,? (?:back,? )?|[Jj]oined by |[Ff]eaturing |[Ii]nterview with )"
NAME = r"\p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+){1,3}"


def guests(df: DataFrame, text: str = "text", out: str = "guests") -> DataFrame:
    """``guests``: names that a text gives after a cue such as "Guest:" or "joined by", each once, in order; without links."""
    names = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{GUEST_CUE}({NAME})"), F.lit(1)))
    return df.withColumn(out, F.transform(names, lambda n: F.struct(n.alias("name"), F.array().cast("array<string>").alias("urls"))))
