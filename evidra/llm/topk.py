"""Exact top-k by integer inner product with no-random-access aggregation.

Every dimension is a list of candidates sorted by their component.  A query reads all lists side by side from their
profitable ends, a stretch of each at a time (many queries read a stretch together, as a matrix product over its entries, and
those that are done read no further).  What it has read of a candidate adds up to a lower bound, with the worst end
of the lists that have not shown it yet; with their current levels, to an upper bound.  Candidates whose upper bound lies
below the k-th lower one are left, and a query stops where few remain; their scores are then resolved exactly.

Queries and candidates meet in cells of bounded size: rows are dealt to blocks, query rows to chunks, by their position
in a stored table, so that every (chunk, block) pair is one group of a co-grouped map and nothing is broadcast.  A query
first searches the block that it lies in; the k-th score found there goes along to all other cells, which give up on what
cannot reach it, or at once if no candidate of the block can.  Each cell keeps k per query; a window with its partial group
limit merges the cells.

Defined results: vectors that are null or hold a null or non-finite component take no part, short (and empty) vectors are
padded with zeros, components whose scores could leave 53 bits are an error; repeated rows are candidates each, and only the
query's own row is left out; ties go to the smaller id; a null id comes last and is no query; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

K = 20
EVERY = 20
SCALE = 64
#: Candidates in a block and queries in a chunk, at most about.
BLOCK, CHUNK = 8192, 4096
#: Share of each list read after each round.
DEPTHS = (1 / 8, 1 / 2, 3 / 4, 15 / 16, 1)
#: Queries that read the lists together.
TOGETHER = 256
#: Candidates that may remain when a query stops: so many times k, or such a share of all.
FEW, FEW_SHARE = 4, 1 / 64


class Lists:
    """The sorted lists of the dimensions of some candidates, cut into the stretches that are read one after the other."""

    def __init__(self, candidates):
        import numpy as np

        self.candidates = candidates
        n = len(candidates)
        order = np.argsort(candidates, axis=0, kind="stable")
        self.values = np.take_along_axis(candidates, order, axis=0)
        place = np.empty(order.shape, np.int32)
        np.put_along_axis(place, order, np.arange(n, dtype=np.int32)[:, None], axis=0)
        self.steps = []  # how far the lists are read then, what a stretch adds (read from the smallest, from the largest), what is unread
        done = 0
        for depth in DEPTHS:
            upto = min(n, max(done + 1, int(np.ceil(depth * n))))
            if upto > done:
                rising, falling = (place >= done) & (place < upto), (place >= n - upto) & (place < n - done)
                self.steps.append((upto, np.where(rising, candidates, 0).T, np.where(falling, candidates, 0).T, (place >= upto).T.astype(np.float64), (place < n - upto).T.astype(np.float64)))
            done = upto


def qualified(lists: Lists, queries, own, k: int, bars):
    """For each query the candidates of which its ``k`` best are some, and the share of the list entries that was read.

    The queries read a stretch of all lists together, and each goes on until it has few candidates left: none of the others
    can reach the ``k``-th best lower bound, or the query's ``bars``.
    """
    import numpy as np

    n = len(lists.values)
    rise, fall = np.minimum(queries, 0), np.maximum(queries, 0)  # read from the smallest, and from the largest component
    least, most = lists.values[0], lists.values[-1]
    bars = bars.copy()
    alive: list = [None] * len(queries)
    read = np.zeros(len(queries))
    todo = np.flatnonzero((rise @ least + fall @ most) >= bars)  # the others cannot reach their bar in any list
    seen = np.zeros((len(queries), n))
    for upto, rising, falling, below, above in lists.steps:
        r, f = rise[todo], fall[todo]
        seen[todo] += r @ rising + f @ falling
        read[todo] = upto / n
        lower = seen[todo] + (r * most) @ below + (f * least) @ above
        rows = np.flatnonzero(own[todo] >= 0)
        lower[rows, own[todo][rows]] = -np.inf
        if n >= k:
            bars[todo] = np.maximum(bars[todo], np.partition(lower, n - k, axis=1)[:, n - k])
        level_r, level_f = lists.values[upto - 1], lists.values[n - upto]
        # while a candidate that no list has shown could still qualify, many can
        ready = np.flatnonzero(((r @ level_r + f @ level_f) < bars[todo]) | (upto == n))
        if not len(ready):
            continue
        upper = lower[ready] + (r[ready] * (level_r - most)) @ below + (f[ready] * (level_f - least)) @ above
        stays = np.ones(len(todo), bool)
        for i, bound in zip(ready, upper, strict=True):
            left = np.flatnonzero((bound >= bars[todo[i]]) & (bound > -np.inf))
            if upto == n or len(left) <= max(FEW * k, n * FEW_SHARE):
                alive[todo[i]], stays[i] = left, False
        todo = todo[stays]
        if not len(todo):
            break
    return [np.zeros(0, np.int64) if x is None else x for x in alive], read


def search(queries, candidates, own, ids, k: int = K, bars=None):
    """(query, candidate, score) positions of the ``k`` best candidates of each query; ``own`` is not a candidate.

    ``queries``, ``candidates``: rows of integers as doubles; ``own``: the query's own row among the candidates or -1;
    ``ids`` break ties; ``bars``: a score that the k-th best of each query is known to reach.
    """
    import numpy as np

    out: list[tuple] = []
    lists = Lists(candidates)
    bars = np.full(len(queries), -np.inf) if bars is None else bars
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    for at in range(0, len(queries), TOGETHER):
        part = slice(at, at + TOGETHER)
        found, _ = qualified(lists, queries[part], own[part], k, bars[part])
        for i, rest in enumerate(found, at):
            score = candidates[rest] @ queries[i]
            keep = score >= bars[i]
            if keep.sum() > k:
                keep &= score >= np.partition(score, len(score) - k)[len(score) - k]
            rest, score = rest[keep], score[keep]
            top = np.lexsort((rank[rest], -score))[:k]
            out += [(i, int(rest[b]), int(score[b])) for b in top]
    return out


def _matrix(column, width: int | None = None):
    import numpy as np

    column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    flat = np.asarray(column.flatten(), np.float64)
    width = width or int(np.diff(offsets).max(initial=0))
    out = np.zeros((len(column), width))
    for i, (a, b) in enumerate(zip(offsets - offsets[0], offsets[1:] - offsets[0], strict=False)):
        out[i, : b - a] = flat[a:b]
    return out


def _cell(k: int):
    def run(queries, candidates):
        import numpy as np
        import pyarrow as pa

        q, c = _matrix(queries["v"]), _matrix(candidates["v"])
        width = max(q.shape[1], c.shape[1])
        q, c = np.pad(q, ((0, 0), (0, width - q.shape[1]))), np.pad(c, ((0, 0), (0, width - c.shape[1])))
        if len(q) and len(c) and np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(width, 1) >= 2**53:
            raise OverflowError("components too large for exact scores")
        place = {row: i for i, row in enumerate(candidates["row"].to_pylist())}
        own = np.array([place.get(row, -1) for row in queries["row"].to_pylist()], np.int64)
        ids = np.array([np.inf if x is None else x for x in candidates["id"].to_pylist()], object)
        bars = np.array([-np.inf if x is None else x for x in queries["bar"].to_pylist()])
        found = search(q, c, own, ids, k, bars) if len(q) and len(c) else []
        rows, names, cid = queries["row"].to_pylist(), queries["id"].to_pylist(), candidates["id"].to_pylist()
        return pa.table(
            {
                "row": pa.array([rows[a] for a, _, _ in found], pa.int64()),
                "query_id": pa.array([names[a] for a, _, _ in found], pa.int64()),
                "vec_id": pa.array([cid[b] for _, b, _ in found], pa.int64()),
                "score": pa.array([s for _, _, s in found], pa.int64()),
            }
        )

    return run


def whole(vector: Column) -> Column:
    """floor(64 * x) of every component; null if the vector cannot take part."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))


def top_k(vectors: DataFrame, k: int = K, key: str = "vec_id", vector: str = "embedding", every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows for each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    made = vectors.select(F.col(key).cast("long").alias("id"), whole(F.col(vector)).alias("v")).where("v is not null")
    rows = stored(made.withColumn("row", F.monotonically_increasing_id()), "vectors")
    is_query = F.coalesce(F.col("id") % every == 0, F.lit(False))
    total, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    blocks = max(1, math.ceil(total / BLOCK), min(2 * spark.sparkContext.defaultParallelism, math.ceil(total / 512)))
    chunks = max(1, math.ceil(asked / CHUNK))
    # row numbers start anew in each input partition, at multiples of 2**33; their hash deals evenly
    dealt = F.xxhash64("row")
    home, chunk = F.pmod(dealt, F.lit(blocks)).cast("int"), F.pmod(dealt, F.lit(chunks)).cast("int")
    asking = rows.where(is_query).select("row", "id", "v", chunk.alias("chunk"), home.alias("home"))
    c = rows.select("row", "id", "v", home.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def cells(q: DataFrame) -> DataFrame:
        each = q.select(*[F.col(x).alias(x) for x in ("row", "id", "v", "bar", "chunk", "block")]).groupBy("chunk", "block")  # columns of its own
        return each.cogroup(c.groupBy("chunk", "block")).applyInArrow(_cell(k), "row long, query_id long, vec_id long, score long")

    found = cells(asking.select("*", F.lit(None).cast("long").alias("bar"), F.col("home").alias("block")))
    if blocks > 1:
        found = stored(found, "home")
        bars = found.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("bar"))
        others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b != F.col("home"))).alias("block")
        found = found.unionByName(cells(asking.join(bars, "row", "left").select("row", "id", "v", "bar", "chunk", others)))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {K}"""

QUERIES = {"op6_topk": op6_topk}
ORACLE_SQL = {"op6_topk": ORACLE}
