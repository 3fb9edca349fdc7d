"""Toxicity by weak supervision.

Voters are lexicon terms (words, and stems: the first letters of inflected words) and text patterns.  A generative label
model, fitted by expectation maximisation to labelled and unlabelled texts, estimates together how often each voter is
right when it votes, and how voters correlate within a class; a voter that echoes others counts for less, one that abstains
says nothing.  A linear classifier is then trained on the posterior labels and scores whole texts.

Labels serve to find the lexicon, set the class balance and anchor the label model, and come only from rows that are not
held out.  Terms are counted over all labelled rows, and the label model is fitted to all rows that are not held out:
every document's votes are taken once and stored, equal ones are counted together, and each round of the model passes
over these counts and brings back one sum per voter.  Sums are integers, so no order of rows changes a score.  Only the
choice of voters among the candidates and the linear classifier use a sample, of at most ``SAMPLE`` labelled rows.

Defined results: a null or empty text scores as one in which no voter votes; a text of any length is read whole; without
labelled rows of both classes all scores are 0; where no term marks toxic texts, the patterns alone vote; terms and sampled
rows that tie go by their text and hash; repeated rows score alike; labels of unknown documents and null labels are
ignored, and of several labels of one document the highest counts; an empty table gives an empty result; further input
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, sized, stored, table

#: Labelled training rows on which voters are chosen and the classifier is fitted.
SAMPLE = 10_000
#: Log-likelihood (in nats) that a term must add to become a candidate, whatever the number of texts: a term that says nothing
#: about its text passes about once in two thousand; what such terms vote is weighed by the label model and the classifier.
LEAST_GAIN = 6.0
#: Candidates, and voters among them, at most; None: all that pass.
CANDIDATES, VOTERS = None, None
STEMS = (4, 5, 6, 7)
#: Terms in enough toxic texts whose hashes (some 20 bytes each) may go to every task; more are joined by a shuffle.
TERMS = 500_000
THRESHOLD = 0.3
#: Distinct words a worker remembers.
MEMO = 500_000
#: Rounds of the label model at most; it rests when no accuracy moves by more than ``REST``.
ROUNDS, REST = 30, 1e-4
#: Correlation within a class up to which voters are no echo of each other.
ECHO = 0.5
#: What a posterior is counted in, and the certainty of a label.
UNITS, SURE = 1 << 16, 0.98
#: Rows turned into a matrix at once.
ROWS = 2048

#: Patterns that vote besides the lexicon: calls of names at the reader, shouting, runs of marks, masked words.
PATTERNS = (
    r"(?i)\byou(?:'re| are)? (?:a|an|such|all|so)\b",
    r"\b[A-Z]{4,} [A-Z]{4,} [A-Z]{4,}\b",
    r"[!?]{3,}",
    r"\b[A-Za-z]+[*#@$]{2,}[A-Za-z]*\b",
)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-case."""
    found = _WORD.findall(text.lower())  # letters, and a few signs that are counted as such
    return found if text.isascii() else [p for w in found for p in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def terms(word: str) -> list[str]:
    """The lexicon terms that a lower-case word stands for: itself, and its stems with an asterisk."""
    return [word, *[f"{word[:k]}*" for k in STEMS if len(word) >= k]]


def candidates(labelled: DataFrame) -> tuple[list[str], int, int]:
    """Terms that mark toxic texts most, by log-likelihood ratio; with the numbers of toxic and other texts.

    ``labelled`` has ``text`` and ``toxic``.  Terms must add ``LEAST_GAIN``; only those in so many toxic texts that they would if no
    other text had them are counted in the others.
    """
    n = {r.toxic: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return [], bad, good
    words = F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")), "")

    def stems(k: int):
        return F.transform(F.filter(F.col("w"), lambda x: F.length(x) >= k), lambda x: F.concat(F.substring(x, 1, k), F.lit("*")))

    def counted(toxic: int, name: str, only: DataFrame | None = None) -> DataFrame:
        each = labelled.where(F.col("toxic") == toxic).select(words.alias("w")).select(F.explode(F.array_distinct(F.concat("w", *map(stems, STEMS)))).alias("term"))
        if only is not None:  # terms that cannot become candidates do not move; by a hash, which is shorter, and lets next to no other pass
            each = each.join(only.select(F.xxhash64("term").alias("hash")), F.xxhash64("term") == F.col("hash"), "left_semi")
        return each.groupBy("term").agg(F.count("*").alias(name))

    def part(x, total):
        return F.when(x > 0, x * F.log(x / (F.col("a") + F.col("b")) / (total / (bad + good)))).otherwise(0.0)

    often = sized(counted(1, "a").where(F.col("a") * math.log((bad + good) / bad) >= LEAST_GAIN), TERMS)
    both = often.join(counted(0, "b", often), "term", "left").select("term", "a", F.coalesce("b", F.lit(0)).alias("b"))
    gain = part(F.col("a"), bad) + part(F.col("b"), good)
    found = both.where(F.col("a") >= 4 * F.col("b")).withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.col("gain").desc(), "term")
    return [r.term for r in (found if CANDIDATES is None else found.limit(CANDIDATES)).collect()], bad, good


class Voters:
    """Columns of votes: candidate terms, then patterns."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = lexicon
        self.index = {t: i for i, t in enumerate(lexicon)}
        self.memo: dict[str, tuple[int, ...]] = {}
        self.patterns = [re.compile(p) for p in PATTERNS]

    def __getstate__(self):
        return self.lexicon

    def __setstate__(self, lexicon):
        self.__init__(lexicon)

    def __len__(self) -> int:
        return len(self.lexicon) + len(PATTERNS)

    def votes(self, text: str | None) -> list[int]:
        if not text:
            return []
        memo, index = self.memo, self.index
        found: set[int] = set()
        for word in set(words_of(text)):
            hit = memo.get(word)
            if hit is None:
                hit = tuple(index[t] for t in terms(word) if t in index)
                if len(memo) >= MEMO:
                    memo.clear()
                memo[word] = hit
            if hit:
                found.update(hit)
        return sorted(found) + [len(self.lexicon) + i for i, p in enumerate(self.patterns) if p.search(text)]


def _chosen(votes, toxic) -> list[int]:
    """Columns of the voters (``toxic``: 1, 0, or -1 for unknown): each next term is the one that marks most toxic texts marked less than four times so far, few others."""
    import numpy as np

    terms_only = votes[:, : votes.shape[1] - len(PATTERNS)]
    bad, good = terms_only[toxic == 1], terms_only[toxic == 0]
    cost = 4.0 * good.sum(axis=0) * len(bad) / max(len(good), 1)
    seen, size = np.zeros(len(bad)), bad.sum(axis=0)
    left_out = np.zeros(terms_only.shape[1], bool)
    picked: list[int] = []
    while VOTERS is None or len(picked) < VOTERS:
        gain = bad[seen < 4].sum(axis=0) - cost
        gain[left_out] = -1
        best = int(gain.argmax()) if len(gain) else 0
        if not len(gain) or gain[best] < 2:
            break
        both = bad.T @ bad[:, best]
        left_out |= both > 0.8 * (size + size[best] - both)  # itself, and terms that mark nearly the same texts
        picked.append(best)
        seen += bad[:, best]
    return picked + list(range(terms_only.shape[1], votes.shape[1]))


@dataclass
class LabelModel:
    """How often each voter is right when it votes, its weight after correlations, and the share of toxic texts."""

    accuracy: object
    weight: object
    prior: float

    def posterior(self, votes, toxic=None):
        """Of signed ``votes``; a label (``toxic``: 1 or 0) speaks as one more voter, of accuracy ``SURE``."""
        import numpy as np

        a = np.clip(self.accuracy, 0.02, 0.995)
        z = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * np.log(a / (1 - a)))
        if toxic is not None:
            z = z + (2 * toxic - 1) * np.log(SURE / (1 - SURE))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def signed(votes):
    """Votes for toxic (1), for clean (-1), or none (0): a last voter speaks for clean where no lexicon voter votes."""
    import numpy as np

    lexicon = votes[:, : votes.shape[1] - len(PATTERNS)]
    return np.hstack([votes, -1.0 * ~lexicon.any(axis=1, keepdims=True)])


@dataclass
class Moments:
    """What the label model gathers of signed votes, per class of label (clean, toxic, none): the rows, the votes of each
    voter, and how often two voters vote together."""

    rows: object  # 3
    votes: object  # 3 x voters
    together: object  # 3 x voters x voters

    @classmethod
    def of(cls, cast, toxic, count) -> Moments:
        """``cast``: rows of signed votes, each ``count`` times; ``toxic``: 0, 1, or -1 for none."""
        import numpy as np

        cast = np.abs(cast)
        groups = [np.where(toxic == g, count, 0).astype(np.float64) for g in (0, 1, -1)]
        return cls(np.array([g.sum() for g in groups]), np.stack([g @ cast for g in groups]), np.stack([(cast * g[:, None]).T @ cast for g in groups]))


def fit_label_model(moments: Moments, prior: float, expected) -> LabelModel:
    """Accuracies (no voter is worse than a coin) and correlations, estimated in turn until both rest.

    ``expected(model)``: over the rows without a label, the sum of the posteriors, and of the posteriors of each voter's
    rows.  Labels anchor the estimate with certainty ``SURE``, and give the first one alone, so that sparse voters start on
    the right side.
    """
    import numpy as np

    m = len(moments.votes[0])
    sign = np.append(np.ones(m - 1), -1)
    clean, toxic, unknown = moments.votes
    anchored = SURE * toxic + (1 - SURE) * clean
    anchored_rows = SURE * moments.rows[1] + (1 - SURE) * moments.rows[0]
    model = None
    for step in range(ROUNDS):
        if step == 0:
            cast, bad, bad_rows, known = clean + toxic, anchored, anchored_rows, 2
        else:
            more_rows, more = expected(model)
            cast, bad, bad_rows, known = clean + toxic + unknown, anchored + more, anchored_rows + more_rows, 3
        accuracy = np.maximum((np.where(sign > 0, bad, cast - bad) + 0.5) / (cast + 1), 0.5)
        rows = max(moments.rows[:known].sum(), 1.0)
        share = np.array([rows - bad_rows, bad_rows]) / rows  # of the classes, and how often a voter votes in each
        means = np.stack([cast - bad, bad]) / np.maximum(np.array([[rows - bad_rows], [bad_rows]]), 1e-9)
        spread = moments.together[:known].sum(axis=0) / rows - (means.T * share) @ means
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        echo = np.clip(spread / np.outer(scale, scale) - ECHO, 0, None) / (1 - ECHO)
        np.fill_diagonal(echo, 0)
        new = LabelModel(accuracy, 1 / (1 + echo.sum(axis=1)), prior)
        if model is not None and max(np.abs(new.accuracy - model.accuracy).max(), np.abs(new.weight - model.weight).max()) < REST:
            return new
        model = new
    return model


def matrix(votes: list, width: int):
    import numpy as np

    out = np.zeros((len(votes), width))
    for i, found in enumerate(votes):
        out[i, found] = 1
    return out


def summed(patterns: DataFrame, width: int, used: list[int], cells) -> dict[int, int]:
    """Integers by cell, added up over all ``patterns`` (votes, toxic, n); ``cells(cast, toxic, n)`` gives (cell, value) arrays."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                toxic = np.array([-1 if x is None else x for x in part.column(1).to_pylist()])
                where, value = cells(signed(matrix(part.column(0).to_pylist(), width)[:, used]), toxic, np.array(part.column(2), np.float64))
                yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(np.rint(value).astype(np.int64))], names=["cell", "value"])

    return {r.cell: r.value for r in patterns.mapInArrow(run, "cell int, value long").groupBy("cell").agg(F.sum("value").alias("value")).collect()}


def moments_of(patterns: DataFrame, width: int, used: list[int]) -> Moments:
    import numpy as np

    m = len(used) + 1

    def cells(cast, toxic, n):
        found = Moments.of(cast, toxic, n)
        flat = np.concatenate([found.rows, found.votes.ravel(), found.together.ravel()])
        return np.flatnonzero(flat), flat[flat != 0]

    flat = np.zeros(3 + 3 * m + 3 * m * m)
    for cell, value in summed(patterns, width, used, cells).items():
        flat[cell] = value
    return Moments(flat[:3], flat[3 : 3 + 3 * m].reshape(3, m), flat[3 + 3 * m :].reshape(3, m, m))


def expectation(patterns: DataFrame, width: int, used: list[int]):
    """``expected`` of ``fit_label_model`` over the patterns without a label; posteriors count in ``UNITS``."""
    import numpy as np

    def expected(model: LabelModel):
        def cells(cast, toxic, n):
            weight = np.rint(model.posterior(cast) * UNITS) * n
            return np.arange(cast.shape[1] + 1), np.concatenate([[weight.sum()], weight @ np.abs(cast)])

        found = summed(patterns, width, used, cells)
        return found.get(0, 0) / UNITS, np.array([found.get(i + 1, 0) / UNITS for i in range(len(used) + 1)])

    return expected


def fit_linear(x, p, ridge: float = 1e-5, steps: int = 400):
    """Weights and bias of a logistic regression on soft labels, by accelerated gradient steps."""
    import numpy as np

    n, m = x.shape
    w = np.zeros(m + 1)
    ahead = w.copy()
    one = np.hstack([x, np.ones((n, 1))])
    rate = 4.0 / max(np.square(one).sum(axis=1).mean(), 1.0)
    decay = np.append(np.full(m, ridge), 0.0)
    for k in range(steps):
        z = 1 / (1 + np.exp(-np.clip(one @ ahead, -30, 30)))
        new = ahead - rate * (one.T @ (z - p) / n + decay * ahead)
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w[:m], float(w[m])


@dataclass
class Model:
    voters: Voters
    weights: list[float]
    bias: float | None

    def score(self, votes: Column) -> Column:
        """The score of a column of votes."""
        if self.bias is None:
            return F.lit(0.0)
        each = F.array(*map(F.lit, self.weights))
        z = F.aggregate(votes, F.lit(self.bias), lambda total, i: total + F.get(each, i))
        return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def voted(docs: DataFrame, voters: Voters, key: str, text: str) -> DataFrame:
    """(key, held_out, votes) of each row, in this order of columns."""

    def vote(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [voters.votes(v) for v in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=[key, "held_out", "votes"])

    schema = T.StructType([docs.schema[key], T.StructField("held_out", T.BooleanType()), T.StructField("votes", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text")).mapInArrow(vote, schema)


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame | None]:
    """A model, and the stored votes of all ``docs`` that it was fitted to (none without labels of both classes)."""
    import numpy as np

    known = labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    train = known.where(~held_out("key"))
    lexicon, bad, good = candidates(stored(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(train.hint("merge"), "key").select("text", "toxic"), "labelled"))
    if not bad or not good:
        return Model(Voters([]), [], None), None
    voters = Voters(lexicon)
    width = len(voters)
    votes = stored(voted(docs, voters, key, text), "votes")
    narrow = votes.where("not held_out").select(F.col(key).alias("key"), "votes").join(train, "key", "left")
    patterns = stored(narrow.groupBy("votes", "toxic").agg(F.count("*").alias("n")), "patterns")
    sample = narrow.where("toxic is not null").orderBy(F.xxhash64("key"), "key", F.xxhash64("votes")).limit(SAMPLE).collect()
    toxic = np.array([r.toxic for r in sample])
    x = matrix([r.votes for r in sample], width)
    used = _chosen(x, toxic)
    model = fit_label_model(moments_of(patterns, width, used), bad / (bad + good), expectation(patterns.where("toxic is null"), width, used))
    weights, bias = fit_linear(x, model.posterior(signed(x[:, used]), toxic))
    return Model(voters, weights.tolist(), bias), votes


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    return fitted(docs, labels, key, text)[0]


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", votes: DataFrame | None = None) -> DataFrame:
    """key, held_out, score, predicted for each row of ``docs``; ``votes``: those taken of ``docs`` already."""
    votes = voted(docs, model.voters, key, text) if votes is None else votes
    return votes.select(votes.columns[0], "held_out", model.score(F.col("votes")).alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, votes = fitted(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, votes=votes)


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE_SQL: dict[str, str] = {}
