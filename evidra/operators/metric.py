"""Joins of vectors by distance in cells around pivots: rows visit the cells that may hold a partner, and no others.

Some vectors, chosen by a hash, are pivots; every row lives in the cell of its nearest one, and a cell is known by how many rows
it has and by the least and largest distance of these to the pivot.  A row that looks for partners within a radius visits a
cell only if the triangle inequality allows one there: its distance to the pivot, less or more the radius, must touch the
cell's ring, and exceed the distance to its own pivot by at most twice the radius.  That is decided before anything is sent.

Pivots and the numbers of cells go to the tasks with the function; their number is bounded (``PIVOTS``).  Large cells are cut
into parts by a hash of the id, so that no task holds more than about ``PART`` resident rows.  Visitors of a part stream by
in the same task as arrays; how many a cell has is counted, and only residents that more than ``VISITORS`` come to are copied.  A few
queries (``FEW``) go to the residents instead, which then stay where they are.  Vectors that are null take no part.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Rows per pivot, and most pivots.
CELL, PIVOTS = 512, 2048
#: Resident rows of a part of a cell.
PART = 4096
#: Visitors of a part that meet its residents in one task; more come in turns.
VISITORS = 1 << 16
#: Queries that go to all residents, which are scanned where they are.
FEW = 1024
#: Residents whose best bound those of all, and pairs whose distance is computed exactly at a time.
BOUNDING, EXACT_AT_ONCE = 2048, 1 << 16
#: Rows that are compared with all pivots or residents at a time.
TOGETHER = 1024
#: Bounds give way by this much, against rounding.
EPS = 1e-9


@dataclass
class Cells:
    """Pivots (a row each), and of their cells the number of rows, the least and largest distance to the pivot, and in how many turns visitors come."""

    pivots: object
    rows: object
    low: object
    high: object
    turns: object = None

    def parts(self):
        import numpy as np

        return np.maximum(1, -(-self.rows // PART)).astype(int)

    def far(self, x):
        """Distances of rows to all pivots."""
        import numpy as np

        square = (x**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * (x @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0))

    def reached(self, far, radius):
        """Which cells may hold a vector within ``radius`` (a number per row) of rows with these distances to the pivots."""
        slack = 1e-6 * (1 + far)  # distances by products are good to half the digits
        r = radius[:, None]
        ring = (far - r <= self.high + slack) & (far + r >= self.low - slack)
        return ring & (far - far.min(axis=1, keepdims=True) <= 2 * r + 2 * slack) & (self.rows > 0)


def matrix(column, unit: bool = False):
    """The rows of a list column as a matrix; with ``unit`` scaled to length 1 (zeros stay)."""
    import numpy as np

    x = np.asarray(column.combine_chunks().flatten() if hasattr(column, "combine_chunks") else column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    if not unit:
        return x
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def shaped(df: DataFrame, key: str, vector: str, group: str | None = None) -> DataFrame:
    """(id, g, v) of the rows that have a vector."""
    g = F.col(group).cast("long") if group else F.lit(0).cast("long")
    return df.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), g.alias("g"), F.col(vector).cast("array<double>").alias("v"))


def _settled(df: DataFrame) -> DataFrame:
    from .similarity import checkpoint_folder

    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def pivots_of(rows: DataFrame, unit: bool):
    """A pivot for every ``CELL`` rows of (id, v), at most ``PIVOTS``: those of the smallest hashes, equal ones once."""
    import numpy as np

    n = min(PIVOTS, -(-rows.count() // CELL))
    drawn = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(max(n, 1)).collect()
    if not drawn:
        return np.zeros((0, 0))
    x = np.array([r.v for r in drawn], np.float64)
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.unique(np.divide(x, size, out=np.zeros_like(x), where=size > 0) if unit else x, axis=0)


def placed(rows: DataFrame, pivots, unit: bool) -> DataFrame:
    """``rows`` with the ``cell`` of the nearest pivot and the distance ``r`` to it."""
    import numpy as np

    cells = Cells(pivots, np.ones(len(pivots)), None, None)
    names = [*rows.columns, "cell", "r"]
    at = rows.columns.index("v")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(k, TOGETHER)
                far = cells.far(matrix(part.column(at), unit))
                own = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own.astype(np.int32)), pa.array(far[np.arange(len(own)), own])], names=names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("r", T.DoubleType())]))


def summary(residents: DataFrame) -> DataFrame:
    """(cell, n, low, high) of placed rows; one row per pivot at most."""
    return residents.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("low"), F.max("r").alias("high"))


def cells_from(pivots, rows: list) -> Cells:
    """Cells by the summaries of all batches of residents."""
    import numpy as np

    made = Cells(pivots, np.zeros(len(pivots), np.int64), np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf))
    for r in rows:
        made.rows[r.cell] += r.n
        made.low[r.cell], made.high[r.cell] = min(made.low[r.cell], r.low), max(made.high[r.cell], r.high)
    return made


def _taken(visitors: DataFrame, cells: Cells, unit: bool, later: bool, nearest: int | None):
    """Visitors, some at a time, with the cells that each has to see (a matrix)."""
    import numpy as np

    v, reach = visitors.columns.index("v"), visitors.columns.index("reach")
    own = visitors.columns.index("cell") if later else None

    def run(batches):
        for batch in batches if cells.rows.any() else ():
            for k in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(k, TOGETHER)
                far = cells.far(matrix(some.column(v), unit))
                if nearest is None:
                    take = cells.reached(far, some.column(reach).to_numpy(zero_copy_only=False))
                else:
                    order = np.argsort(np.where(cells.rows > 0, far, np.inf), axis=1, kind="stable")[:, :nearest]
                    take = np.zeros(far.shape, bool)
                    take[np.arange(len(far))[:, None], order] = True
                    take &= cells.rows > 0
                if later:
                    take &= np.arange(len(cells.rows)) >= some.column(own).to_numpy()[:, None]
                yield some, take

    return run


def turned(visitors: DataFrame, cells: Cells, unit: bool, later: bool = False, nearest: int | None = None) -> Cells:
    """``cells`` with the ``turns`` that these visitors come in, by how many each cell has; a number per cell and task is counted."""
    import numpy as np

    taken = _taken(visitors, cells, unit, later, nearest)

    def run(batches):
        import pyarrow as pa

        n = np.zeros(len(cells.rows), np.int64)
        for _, take in taken(batches):
            n += take.sum(axis=0)
        to = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(to.astype(np.int32)), pa.array(n[to])], names=["to", "n"])

    turns = np.ones(len(cells.rows), int)
    if not later or cells.rows.sum() > VISITORS:  # residents that visit each other are counted already
        for r in visitors.mapInArrow(run, "to int, n long").groupBy("to").agg(F.sum("n").alias("n")).collect():
            turns[r.to] = -(-r.n // VISITORS)
    return replace(cells, turns=turns)


def visits(visitors: DataFrame, cells: Cells, unit: bool, later: bool = False, nearest: int | None = None) -> DataFrame:
    """``visitors`` (with ``reach``, the radius of each) once per part of each cell that they have to see, as ``to`` and ``part``.

    ``later`` leaves out cells before the visitor's own (``cell``); ``nearest`` takes that many nearest cells, whatever the reach.
    """
    import numpy as np

    parts = cells.parts()
    names = [*visitors.columns, "to", "part"]
    taken = _taken(visitors, cells, unit, later, nearest)

    def run(batches):
        import pyarrow as pa

        for some, take in taken(batches):
            rows, to = np.nonzero(take)
            for at in range(0, len(rows), TOGETHER):
                i, c = rows[at : at + TOGETHER], to[at : at + TOGETHER]
                n = parts[c]
                part = np.concatenate([np.arange(x) for x in n]) if len(n) else np.zeros(0, int)
                i, c = np.repeat(i, n), np.repeat(c, n)
                yield pa.RecordBatch.from_arrays([*(x.take(pa.array(i)) for x in some.columns), pa.array(c.astype(np.int32)), pa.array(part.astype(np.int32))], names=names)

    return visitors.mapInArrow(run, T.StructType([*visitors.schema.fields, T.StructField("to", T.IntegerType()), T.StructField("part", T.IntegerType())]))


def meet(visiting: DataFrame, residents: DataFrame, cells: Cells, run: Callable, schema: str) -> DataFrame:
    """``run(visitors, residents)`` for each part of each cell, in the turns of the cell."""
    parts = F.array(*[F.lit(int(x)) for x in cells.parts()] or [F.lit(1)])
    part = F.pmod(F.xxhash64("id"), F.element_at(parts, F.col("cell") + 1)).cast("int")
    turns = F.array(*[F.lit(int(x)) for x in cells.turns] or [F.lit(1)])
    homes = residents.withColumn("part", part)
    homes = homes.select(*[F.col(c).alias({"cell": "to"}.get(c, c)) for c in homes.columns], F.explode(F.sequence(F.lit(0), F.element_at(turns, F.col("cell") + 1) - 1)).alias("turn"))  # columns of their own
    coming = visiting.withColumn("turn", F.pmod(F.xxhash64("id", F.lit("turn")), F.element_at(turns, F.col("to") + 1)).cast("int"))
    return coming.groupBy("to", "part", "turn").cogroup(homes.groupBy("to", "part", "turn")).applyInArrow(run, schema)


def _partners(threshold: float):
    """Pairs (visitor, resident, cosine) at or above the threshold, of some visitors at a time, each pair in one cell only."""
    import numpy as np

    def found(a, b):
        ids_a, ids_b, xb = a["id"].to_numpy(), b["id"].to_numpy(), matrix(b["v"], True)
        for at in range(0, len(ids_a) if len(ids_b) else 0, TOGETHER):
            some = a.slice(at, TOGETHER)
            ids, home = ids_a[at : at + TOGETHER], some["cell"].to_numpy() == some["to"].to_numpy()
            score = matrix(some["v"], True) @ xb.T
            i, j = np.nonzero(score >= threshold - 1e-12)
            once = ~home[i] | (ids[i] < ids_b[j])
            i, j = i[once], j[once]
            yield ids[i], ids_b[j], np.clip(score[i, j], 0, 1)

    return found


def forest(u, v):
    """Links (smaller, larger) of ids that connect what ``u`` and ``v`` connect, less than one for each id."""
    import numpy as np

    ids, where = np.unique(np.concatenate([u, v]), return_inverse=True)
    i, j = where[: len(u)], where[len(u) :]
    root = np.arange(len(ids))
    while True:  # the smallest number spreads along links and jumps to its own
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = np.minimum(new, new[new])
        if (new == root).all():
            moved = np.flatnonzero(root != np.arange(len(ids)))
            return ids[root[moved]], ids[moved]
        root = new


def _reach(cosine: float) -> float:
    """The distance of unit vectors of a cosine."""
    if cosine <= 0:
        raise ValueError("the threshold must be above zero")
    return (2 - 2 * min(cosine, 1.0)) ** 0.5 + 1e-7


def coarser(pivots, reach: float | None):
    """Fewer pivots, if a row within whose ``reach`` something is has to visit most cells anyway, so that rows travel to fewer cells."""
    import numpy as np

    if reach is None or len(pivots) <= 2:
        return pivots
    far = np.sort(Cells(pivots, None, None, None).far(pivots[:: max(1, len(pivots) // 256)]), axis=1)[:, 1:]  # without itself
    return pivots[:: max(1, PART // CELL)] if (far - far[:, :1] <= 2 * reach).mean() > 0.5 else pivots


def settle(rows: DataFrame, unit: bool, reach: float | None = None) -> tuple[DataFrame, Cells]:
    """Rows (id, g, v) in their cells, computed once; ``reach`` is the radius of later visits, where it is known."""
    pivots = coarser(pivots_of(rows, unit), reach)
    homes = _settled(placed(rows, pivots, unit))
    return homes, cells_from(pivots, summary(homes).collect())


def has_cosine(vector) -> Column:
    """Whether a vector has a direction: it isn't zero, and all its components are finite."""
    return F.exists(vector, lambda x: x != 0) & F.forall(vector, lambda x: F.abs(x) < float("inf"))  # nan is above all


def _self_cells(vectors: DataFrame, key: str, vector: str, reach: float | None = None):
    """Unit vectors in their cells; those without a direction resemble nothing and are left out, as no bounds of a cell hold for them."""
    return settle(shaped(vectors, key, vector).where(has_cosine("v")), True, reach)


def matched(new: DataFrame, known: DataFrame, rerank, within: float = 0.15, k: int = 10, relevance: float = 0.9) -> DataFrame:
    """(claim_id, existing_id, distance, relevance) of new claims that are known from another group.

    Both are (id, g, text, v).  Of the ``k`` known claims of other groups that are nearest, closer than ``within``, the first
    that ``rerank`` (which adds ``relevance`` to claim and quote) gives at least ``relevance``; new claims without one, or
    without a group, are left out.
    """
    homes, cells = settle(shaped(known, "id", "v", "g"), False)
    near = search(shaped(new, "id", "v", "g"), lambda visiting: homes, cells, k, False, True, False, within)
    texts = near.join(new.select(F.col("id").alias("query_id"), F.col("text").alias("claim")), "query_id").join(known.select(F.col("id").alias("vec_id"), F.col("text").alias("quote")), "vec_id")
    good = rerank(texts).where(F.col("relevance") >= relevance)
    first = F.min_by(F.struct("vec_id", "score", "relevance"), "rank")
    return good.groupBy(F.col("query_id").alias("claim_id")).agg(first.alias("m")).select("claim_id", F.col("m.vec_id").alias("existing_id"), F.col("m.score").alias("distance"), "m.relevance")


def similar_pairs(vectors: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """(left_id, right_id, cosine) of all pairs with cosine at or above ``threshold``, which is above zero."""
    reach = _reach(threshold)
    homes, cells = _self_cells(vectors, key, vector, reach)
    found = _partners(threshold)

    def run(a, b):
        import numpy as np
        import pyarrow as pa

        made = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), *found(a, b)]
        u, v, score = (np.concatenate(x) for x in zip(*made, strict=True))
        return pa.table({"left_id": np.minimum(u, v), "right_id": np.maximum(u, v), "cosine": score})

    coming = homes.withColumn("reach", F.lit(reach))
    return meet(visits(coming, cells, True, later=True), homes, turned(coming, cells, True, later=True), run, "left_id long, right_id long, cosine double")


def similar_links(vectors: DataFrame, key: str, vector: str, threshold: float) -> DataFrame:
    """Links (u, v) that connect what pairs at or above ``threshold`` connect: of every cell a forest, less than a link per row."""
    reach = _reach(threshold)
    homes, cells = _self_cells(vectors, key, vector, reach)
    found = _partners(threshold)

    def run(a, b):
        import numpy as np
        import pyarrow as pa

        links = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *(forest(u, v) for u, v, _ in found(a, b))]
        u, v = forest(*(np.concatenate(x) for x in zip(*links, strict=True)))
        return pa.table({"u": u, "v": v})

    coming = homes.withColumn("reach", F.lit(reach))
    return meet(visits(coming, cells, True, later=True), homes, turned(coming, cells, True, later=True), run, "u long, v long")


def _best_of(k: int, cosine: bool, grouped: bool, other: bool):
    """The best of a part for each visitor: up to ``k`` residents within its reach, nearest first, ties to the smaller id."""

    def run(a, b):
        import numpy as np
        import pyarrow as pa

        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(ids_a) and len(ids_b):
            by_id = np.argsort(ids_b, kind="stable")
            ids_b, xa, xb = ids_b[by_id], matrix(a["v"], cosine), matrix(b["v"], cosine)[by_id]
            reach, ga, gb = a["reach"].to_numpy(), a["g"].to_numpy(zero_copy_only=False), b["g"].to_numpy(zero_copy_only=False)[by_id]
            i, j, s = [], [], []
            ga, gb = np.asarray(ga, float), np.asarray(gb, float)
            for at in range(0, len(ids_a), TOGETHER):
                x, g = xa[at : at + TOGETHER], ga[at : at + TOGETHER]
                score = x @ xb.T
                if cosine:
                    np.negative(np.clip(score, 0, 1, out=score), out=score)
                else:
                    score *= -2
                    score += (x**2).sum(axis=1)[:, None]
                    score += (xb**2).sum(axis=1)
                    np.sqrt(np.maximum(score, 0, out=score), out=score)
                if other:
                    score[ids_a[at : at + TOGETHER, None] == ids_b] = np.inf
                if grouped:
                    score[g[:, None] == gb] = np.inf
                    score[np.isnan(g)] = np.inf
                    score[:, np.isnan(gb)] = np.inf
                kth = min(k, len(ids_b)) - 1
                bars = np.partition(score[:, : max(BOUNDING, k)], kth, axis=1)[:, kth]  # no less than that of all residents
                open_ = np.flatnonzero(np.isinf(bars))
                bars[open_] = np.partition(score[open_], kth, axis=1)[:, kth]
                slack = 1e-6 * (1 + np.abs(x).max(initial=0))
                if not cosine:
                    bars = np.minimum(bars, reach[at : at + TOGETHER]) + slack
                q, near = np.nonzero((score <= bars[:, None]) & np.isfinite(score))
                exact = score[q, near]
                if not cosine:
                    for e in range(0, len(q), EXACT_AT_ONCE):
                        exact[e : e + EXACT_AT_ONCE] = np.sqrt(np.square(xb[near[e : e + EXACT_AT_ONCE]] - x[q[e : e + EXACT_AT_ONCE]]).sum(axis=1))
                    within = exact < reach[at + q]
                    q, near, exact = q[within], near[within], exact[within]
                order = np.lexsort((near, np.round(exact, 9), q))
                q, near, exact = q[order], near[order], exact[order]
                first = np.arange(len(q)) - np.searchsorted(q, q) < k
                i.append(at + q[first])
                j.append(near[first])
                s.append(exact[first])
            i, j, s = np.concatenate(i), np.concatenate(j), np.concatenate(s)
            out = [ids_a[i], ids_b[j], -s if cosine else s]
        return pa.table({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    return run


def ranked(found: DataFrame, k: int, cosine: bool) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy((-1 if cosine else 1) * F.round("score", 9), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


SCORED = "query_id long, vec_id long, score double"


def _scanned(queries, residents: DataFrame, k: int, cosine: bool, run: Callable) -> DataFrame:
    """The best that ``run`` finds of an Arrow table of a few queries among the residents of each task, which stay where they are; ``k`` per query and task."""

    def best(batches):
        import numpy as np
        import pyarrow as pa

        kept = None
        for batch in batches:
            found = run(queries, pa.table(batch.columns, names=batch.schema.names))
            if kept is not None:
                found = pa.concat_tables([kept, found])
            q, i, s = (found[c].to_numpy() for c in ("query_id", "vec_id", "score"))
            order = np.lexsort((i, np.round(-s if cosine else s, 9), q))
            q = q[order]
            kept = found.take(order[np.arange(len(q)) - np.searchsorted(q, q) < k])
        if kept is not None:
            yield from kept.to_batches()

    return residents.select("id", "g", "v").mapInArrow(best, SCORED)


def search(queries: DataFrame, homes: Callable[[DataFrame], DataFrame], cells: Cells, k: int, cosine: bool = True, grouped: bool = False, other: bool = True, within: float | None = None, probes: int | None = None) -> DataFrame:
    """(query_id, vec_id, score, rank): the ``k`` best residents of each query (id, g, v), at most 9 decimals of score apart counting alike.

    ``homes`` gives the residents that some visits (``to``, ``part``) may meet; it may leave out other cells.  ``within``
    bounds an l2 distance.  With ``probes``, only that many nearest cells are looked at; else the result is exact: the
    query's nearest cell gives its k-th distance, and only cells that this reaches are visited.  ``other`` leaves out a
    resident of the query's own id; ``grouped`` those of its group.  A few queries are sent to the cells that any of them visits.
    """
    import numpy as np

    run = _best_of(k, cosine, grouped, other)
    few = probes is None and queries.limit(FEW + 1).count() <= FEW

    def met(visitors: DataFrame, nearest: int | None) -> DataFrame:
        if few:
            whole = replace(cells, rows=np.minimum(cells.rows, 1))  # lists are chosen, not their parts
            return ranked(_scanned(visitors.toArrow(), homes(visits(visitors, whole, cosine, nearest=nearest)), k, cosine, run), k, cosine)
        visiting = visits(visitors, cells, cosine, nearest=nearest)
        return ranked(meet(visiting, homes(visiting), turned(visitors, cells, cosine, nearest=nearest), run, SCORED), k, cosine)

    if within is not None or probes is not None:
        return met(queries.withColumn("reach", F.lit(float("inf" if within is None else within))), probes)
    last = met(queries.withColumn("reach", F.lit(float("inf"))), 1).where(F.col("rank") == k)
    distance = F.when(F.col("score") > 0, F.sqrt(2 - 2 * F.col("score") + 1e-8)).otherwise(float("inf")) if cosine else F.col("score")
    bars = last.select(F.col("query_id").alias("id"), (distance * (1 + 1e-7) + 1e-7).alias("reach"))
    return met(_settled(queries.join(bars, "id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf")))).select(*queries.columns, "reach")), None)


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int, metric: str = "cosine", group: str | None = None, within: float | None = None) -> DataFrame:
    """The ``k`` best of ``vectors`` per query, other than itself (and, with ``group``, of other groups only; rows without a group have none)."""
    cosine = metric == "cosine"
    homes, cells = settle(shaped(vectors, key, vector, group), cosine, None if cosine else within)
    return search(shaped(queries, key, vector, group), lambda visiting: homes, cells, k, cosine, group is not None, True, within)


def cells_seen(visitors: DataFrame, cells: Cells, unit: bool, later: bool = False) -> tuple[int, int]:
    """How many (row, cell) visits there are, and how many there would be without bounds."""
    seen = visits(visitors, cells, unit, later).where("part = 0").count()
    rows, full = visitors.count(), int((cells.rows > 0).sum())
    return seen, rows * full if not later else rows * (full + 1) // 2
