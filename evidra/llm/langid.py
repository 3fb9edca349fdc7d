"""Language identification by nearest centroids.

A text is a normalised TF-IDF vector of hashed letter n-grams (one to three characters).  The inverse document
frequencies come from all training rows; the centroids, several per language by spherical k-means, from a bounded
sample of ``SAMPLE`` training rows per language.  A text takes the language of the centroid of highest cosine, and
counts as rejected where it lies farther from it than nearly all the training texts of that centroid did.

Features are made in Arrow batches on the executors, and each language's centroids in one task from its sample.  Rows of a
sample are thinned by a hash before they are ranked, so a frequent language brings few to that task.  The model (a vector
per centroid) goes to the driver and to every task as a broadcast, bounded by languages times ``CLUSTERS`` times ``DIMS``.
Held-out rows never reach training.

Defined results: ``und`` with score 0 for a null or empty text, one without a letter, or without training rows (as of an
empty table); a text of any length counts whole; ties go to the language that sorts first; null languages are not learned;
repeated rows are predicted alike, and each may be in the sample; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import held_out, sized, table

DIMS = 4096
#: Training rows per language that the centroids are fitted on.
SAMPLE = 500
#: How many times the sample a language keeps before it is ranked.
THINNED = 2
CLUSTERS = 4
ROUNDS = 12
#: Share of a centroid's training texts that lie beyond its rejection distance.
REJECTED = 0.005
#: Characters hashed at once.
STRETCH = 1 << 18
UNKNOWN = "und"

_LETTERS = None


def _letters():
    global _LETTERS
    if _LETTERS is None:
        import numpy as np

        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)
    return _LETTERS


def grams(text: str):
    """Counts of the hashed n-grams of the lower-cased letters, other stretches being one space; None without a letter."""
    import numpy as np

    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # of other characters, the first after a letter stands for all
    codes = np.concatenate(([32], np.where(letter, codes, 32)[keep], [32])).astype(np.uint32)
    counts = np.zeros(DIMS, np.int64)
    for at in range(0, len(codes), STRETCH):
        part = codes[at : at + STRETCH + 2]
        one = part * np.uint32(2654435761)
        two = (one[:-1] ^ (part[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
        three = (two[:-1] ^ (part[2:] * np.uint32(668265263))) * np.uint32(374761393)
        for h in (one, two, three):
            counts += np.bincount((h[:STRETCH] >> np.uint32(20)).astype(np.int64), minlength=DIMS)
    return counts


def _vectors(counts, idf):
    """Rows of counts as unit TF-IDF vectors."""
    import numpy as np

    x = np.log1p(counts).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def frequencies(texts: DataFrame, text: str):
    """Number of texts with a letter, and in how many of them each dimension occurs; over all rows of ``texts``."""

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total, rows = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts = grams(value) if value else None
                if counts is not None:
                    total += counts > 0
                    rows += 1
        yield pa.RecordBatch.from_pydict({"dim": pa.array(np.arange(-1, DIMS), pa.int32()), "n": pa.array(np.concatenate(([rows], total)), pa.int64())})

    import numpy as np

    summed = texts.select(text).mapInArrow(count, "dim int, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect()
    by_dim = {r.dim: r.n for r in summed}
    return by_dim.get(-1, 0), np.array([by_dim.get(i, 0) for i in range(DIMS)], np.float64)


def _sample(train: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """(lang, counts) of at most ``SAMPLE`` training rows per language, chosen by a hash of id and text."""
    rows = train.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = sized(rows.groupBy("lang").agg(F.count("*").alias("rows")))
    drawn = F.xxhash64("key", F.xxhash64("text"))
    thin = rows.join(sizes, "lang").withColumn("drawn", drawn).where(F.pmod("drawn", F.lit(1 << 30)) * F.col("rows") < F.lit(THINNED * SAMPLE * (1 << 30)))
    order = Window.partitionBy("lang").orderBy("drawn", "key", "text")
    picked = thin.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE)

    def convert(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            made = [grams(v) if v else None for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if c is None else c.astype("<u4").tobytes() for c in made], pa.binary())], names=["lang", "counts"])

    return picked.select("lang", "text").mapInArrow(convert, "lang string, counts binary").where("counts is not null")


@dataclass
class Model:
    langs: list[str]
    idf: object
    centroids: object  # a row each
    of: object  # index of the language of a centroid
    least: object  # cosine below which a centroid rejects

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        import numpy as np

        found = [(UNKNOWN, 0.0, True)] * len(texts)
        made = [(i, c) for i, t in enumerate(texts) if t and self.langs and (c := grams(t)) is not None]
        for at in range(0, len(made), 256):
            part = made[at : at + 256]
            near = _vectors(np.stack([c for _, c in part]), self.idf) @ self.centroids.T
            best = near.argmax(axis=1)
            for (i, _), b, row in zip(part, best.tolist(), near, strict=True):
                found[i] = (self.langs[self.of[b]], float(min(max(row[b], 0.0), 1.0)), bool(row[b] < self.least[b]))
        return found


def _clusters(x):
    """Spherical k-means from deterministic far-apart seeds; centroids and the cosine of each row to its own."""
    import numpy as np

    seeds = [0]
    while len(seeds) < min(CLUSTERS, len(x)):
        seeds.append(int((x @ x[seeds].T).max(axis=1).argmin()))
    c = x[seeds]
    for _ in range(ROUNDS):
        mine = (x @ c.T).argmax(axis=1)
        c = np.stack([x[mine == k].mean(axis=0) if (mine == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    near = x @ c.T
    return c, near.argmax(axis=1), near.max(axis=1)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model of the rows that are not held out and have a language."""
    import numpy as np

    train = docs.where(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows, df = frequencies(train, text)
    idf = (np.log((1 + rows) / (1 + df)) + 0.05).astype(np.float32)

    def clustered(table):
        import numpy as np
        import pyarrow as pa

        rows = sorted(table["counts"].to_pylist())
        x = _vectors(np.stack([np.frombuffer(b, "<u4") for b in rows]).astype(np.float32), idf)
        c, mine, near = _clusters(x)
        least = [float(np.quantile(near[mine == k], REJECTED)) if (mine == k).any() else 0.0 for k in range(len(c))]
        return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(c), pa.string()), "k": pa.array(range(len(c)), pa.int32()), "centroid": pa.array([row.astype("<f4").tobytes() for row in c], pa.binary()), "least": pa.array(least, pa.float64())})

    found = _sample(train, key, text, lang).groupBy("lang").applyInArrow(clustered, "lang string, k int, centroid binary, least double").collect()
    found = sorted(found, key=lambda r: (r.lang, r.k))
    langs = sorted({r.lang for r in found})
    centroids = np.stack([np.frombuffer(bytes(r.centroid), "<f4") for r in found]) if found else np.zeros((0, DIMS), np.float32)
    return Model(langs, idf, centroids, [langs.index(r.lang) for r in found], [r.least for r in found])


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, lang_pred, score, rejected for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = shared.value.predict(batch.column(2).to_pylist())
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[key, "held_out", "lang_pred", "score", "rejected"])

    schema = T.StructType([docs.schema[key], T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text")).mapInArrow(run, schema)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))


QUERIES = {"op10_language": op10_language}
ORACLE_SQL: dict[str, str] = {}
