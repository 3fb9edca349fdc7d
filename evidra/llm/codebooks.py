"""Vector codes: every vector becomes a few bytes, the index of the nearest codebook entry for each of its parts.

Codebooks are fitted by Lloyd rounds with Yinyang bounds.  The entries of a codebook are clustered into groups; of each group
a vector keeps one lower bound, below which none of the group's entries (but its own) is near.  When entries move, a bound
falls by the farthest move in its group, and only groups whose bound no longer lies above the distance to the vector's own
entry are scanned.  Components are integers, so scanned distances are exact and ties go to the lower index; bounds are
rounded so that a group with an entry as near as the own one is always scanned.  The rows are those of plain Lloyd rounds.

Each round is one pass over a stored table that holds the vectors with their codes and bounds, and writes the next one with
the sums of its tasks; the sums, whose size the parameters bound, are added up and only they reach the driver.  Codebooks
(parts * entries * components) go to the tasks with the function.

Defined results: vectors that are null or hold a null or non-finite component are dropped; shorter (and empty) vectors are
padded with zeros to the longest, and to a multiple of the number of parts; components whose distances could leave 53 bits
are an error; the first entries are the vectors of the smallest keys (null keys last, ties by the vector), fewer if there
are fewer vectors; repeated rows count each; null labels are one label; an empty table gives an empty result; other columns
take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sized, stored, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries in a group of a codebook, on average.
GROUP = 10
#: Rounds in which entries are clustered into groups, on the driver; they decide what is scanned, not what comes out.
GROUP_ROUNDS = 5
#: Tasks that add up the sums of all tasks, at most; the driver takes one row from each.
ADDERS = 64
#: Bounds are kept as 32-bit numbers and shrunk by this share, so that rounding never puts one above the true distance.
SLACK = 1e-6


@dataclass
class Book:
    """The entries of one part (entries x components, integers) and the groups that they are clustered into."""

    entries: object
    members: list = field(default_factory=list)
    #: How far each group's farthest entry has moved since the bounds were set; each entry's group.
    drift: object = None
    group_of: object = None

    def moved(self, entries) -> Book:
        import numpy as np

        steps = np.sqrt(((entries - self.entries).astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        return Book(entries, self.members, np.array([steps[m].max() for m in self.members]), self.group_of)


def clustered(entries) -> Book:
    """A codebook with its entries clustered by a few Lloyd rounds from evenly spaced ones."""
    import numpy as np

    n = len(entries)
    points = entries.astype(np.float64)
    centres = points[np.linspace(0, n - 1, max(1, n // GROUP)).astype(int)]
    for _ in range(GROUP_ROUNDS):
        near = ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.stack([points[near == g].mean(axis=0) if (near == g).any() else c for g, c in enumerate(centres)])
    members = [np.flatnonzero(near == g) for g in range(len(centres)) if (near == g).any()]
    group_of = np.empty(n, int)
    for g, m in enumerate(members):
        group_of[m] = g
    return Book(entries, members, np.zeros(len(members)), group_of)


def assign(vectors, book: Book, own=None, bounds=None):
    """Nearest entries, their squared distances and the bounds of the groups; and how many (vector, group) were scanned.

    ``own`` and ``bounds`` are those of the round before, if there was one.
    """
    import numpy as np

    n, points, entries = len(vectors), vectors.astype(np.float64), book.entries.astype(np.float64)
    lengths, squares = (points**2).sum(axis=1), (entries**2).sum(axis=1)
    least = np.full(n, np.inf)
    best = np.zeros(n, np.int64)
    low = np.zeros((n, len(book.members)))
    if own is not None:
        best, least = own.astype(np.int64), ((points - entries[own]) ** 2).sum(axis=1)
        low = bounds.astype(np.float64) - book.drift
    reach = np.sqrt(least) * (1 + 1e-9)
    scan = low <= reach[:, None]
    before, first, second, at = best, *np.full((2, n, len(book.members)), np.inf), np.full((n, len(book.members)), -1)
    for g, members in enumerate(book.members):
        rows = np.flatnonzero(scan[:, g])
        if not len(rows):
            continue
        far = lengths[rows, None] - 2 * (points[rows] @ entries[members].T) + squares[members]  # integers, exact
        place = far.argmin(axis=1)
        first[rows, g], at[rows, g] = far[np.arange(len(rows)), place], members[place]
        far[np.arange(len(rows)), place] = np.inf
        second[rows, g] = far.min(axis=1)
        nearer = (first[rows, g] < least[rows]) | ((first[rows, g] == least[rows]) & (at[rows, g] < best[rows]))
        rows = rows[nearer]
        least = least.copy()
        best = best.copy()
        least[rows], best[rows] = first[rows, g], at[rows, g]
    low = np.where(scan, np.sqrt(np.where(at == best[:, None], second, first)) * (1 - SLACK), low)
    left = np.flatnonzero(best != before) if own is not None else np.zeros(0, int)
    groups = book.group_of[before[left]]
    low[left, groups] = np.minimum(low[left, groups], reach[left] * (1 - SLACK))  # the entry that a vector left is one of its group again
    low = np.maximum(low, 0).astype(np.float32)
    return best, least, np.nextafter(low, np.float32(-1)), int(scan.sum())


def _binary(rows):
    """A binary Arrow column of the rows of a matrix."""
    import numpy as np
    import pyarrow as pa

    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(rows.tobytes())])


def _matrix(column, kind: str, width: int):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _padded(column, width: int):
    """The rows of a list column as a matrix, with zeros after the short ones."""
    import numpy as np

    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < np.diff(ends)[:, None]] = values
    return out


def _round(rows: DataFrame, books: list[Book], width: int, kind: str, last: bool) -> DataFrame:
    """One pass: codes, errors and bounds of all vectors (integers of ``kind``), and after them a row with the sums of the task."""
    first = "codes" not in rows.columns
    parts, size = len(books), len(books[0].entries)
    d, groups = width // parts, [len(b.members) for b in books]
    kept = [f for f in rows.schema.fields if f.name in ("key", "label")]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums = np.zeros((parts, size, d + 1), np.int64)
        scanned = 0
        kinds: dict = {}
        for batch in batches:
            kinds |= {k: batch.schema.field(k).type for k in ("key", "label")}
            if not batch.num_rows:
                continue
            vectors = _padded(batch.column("values"), width) if first else _matrix(batch.column("vector"), kind, width).astype(np.int64)
            own = None if first else _matrix(batch.column("codes"), "u1", parts)
            bounds = None if first else np.split(_matrix(batch.column("bounds"), "<f4", sum(groups)), np.cumsum(groups)[:-1], axis=1)
            codes, error, low = np.empty((len(vectors), parts), np.uint8), np.zeros(len(vectors)), []
            for p, book in enumerate(books):
                part = vectors[:, p * d : (p + 1) * d]
                best, least, now, n = assign(part, book, None if first else own[:, p], None if first else bounds[p])
                codes[:, p], error = best, error + least
                low.append(now)
                scanned += n
                order = np.argsort(best, kind="stable")
                used, starts = np.unique(best[order], return_index=True)
                sums[p, used, :d] += np.add.reduceat(part[order], starts, axis=0)
                sums[p, used, d] += np.diff([*starts, len(best)])
            columns = [batch.column("key"), batch.column("label"), _binary(codes), pa.array(error.astype(np.int64))]
            if not last:
                columns += [_binary(vectors.astype(kind)), _binary(np.concatenate(low, axis=1).astype("<f4")), pa.nulls(len(vectors), pa.binary()), pa.nulls(len(vectors), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if kinds and not last:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(1, kinds[k]) for k in ("key", "label")), *(pa.nulls(1, k) for k in (pa.binary(), pa.int64(), pa.binary(), pa.binary())), pa.array([sums.tobytes()], pa.binary()), pa.array([scanned], pa.int64())], names=names
            )

    made = T.StructType([T.StructField(f.name, f.dataType) for f in kept]).add("codes", "binary").add("error", "long")
    if not last:
        made = made.add("vector", "binary").add("bounds", "binary").add("sums", "binary").add("scanned", "long")
    names = made.names
    return rows.mapInArrow(run, made)


def _added(rows: DataFrame, shape: tuple):
    """The sums of all tasks, and how many (vector, group) they scanned."""
    import numpy as np

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, scanned = np.zeros(shape, np.int64), 0
        for batch in batches:
            for data, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total += np.frombuffer(data, np.int64).reshape(shape)
                scanned += n
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([scanned])], names=["sums", "scanned"])

    each = rows.where("sums is not null").select("sums", "scanned").coalesce(ADDERS).mapInArrow(add, "sums binary, scanned long").collect()
    return sum((np.frombuffer(r.sums, np.int64).reshape(shape) for r in each), np.zeros(shape, np.int64)), sum(r.scanned for r in each)


@dataclass
class Codes:
    """(key, label, codes, error) of all vectors, the final codebooks, and how many (vector, group) each round scanned."""

    rows: DataFrame
    books: list
    scanned: list[int]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    import numpy as np

    if not 0 < entries <= 256:
        raise ValueError("a code has one byte for each part: 1 to 256 entries")
    sound = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    whole = df.where(sound).select(F.col(key).alias("key"), F.col(label).alias("label"), values.alias("values"))
    n, longest, most = whole.agg(F.count("*"), F.max(F.size("values")), F.max(F.array_max(F.transform("values", F.abs)))).first()
    width = max(1, -(-(longest or 0) // parts)) * parts
    if 4 * width // parts * ((most or 0) + 1) ** 2 >= 2**53:
        raise ValueError("components are too large for exact distances")
    if not n:
        return Codes(whole.select("key", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error")), [], [])
    start = np.array([[*r[0], *[0] * (width - len(r[0]))] for r in whole.orderBy(F.col("key").asc_nulls_last(), "values").select("values").limit(entries).collect()], np.int64)
    books, rows, scanned = [clustered(x) for x in np.split(start, parts, axis=1)], whole, []
    shape = (parts, len(start), width // parts + 1)
    kind = "<i2" if most < 1 << 15 else "<i4"  # the distances of larger components would leave 53 bits
    for _ in range(rounds):
        rows = stored(_round(rows, books, width, kind, False), "codebooks")
        sums, n = _added(rows, shape)
        scanned.append(n)
        used = sums[:, :, -1:] > 0
        means = np.floor_divide(sums[:, :, :-1], np.maximum(sums[:, :, -1:], 1))
        books = [b.moved(np.where(used[p], means[p], b.entries)) for p, b in enumerate(books)]
        rows = rows.where("sums is null")
    return Codes(_round(rows, books, width, kind, True), [b.entries for b in books], scanned)


def op13_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compress(table(spark, sf_dir, "embeddings"))
    rows = stored(found.rows, "codes")
    totals = sized(rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"))
    each = rows.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return each.select(F.col("key").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))


QUERIES = {"op13_codebooks": op13_codebooks}


def _oracle() -> str:
    steps = [
        """kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "part AS (SELECT vec_id, label, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, range(0, 4) t(p))",
        "c0 AS (SELECT p, k, x AS c FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x FROM part) WHERE k < 256)",
    ]
    far = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, p, x, m // 256 AS d, m % 256 AS k FROM (SELECT vec_id, p, any_value(x) AS x, min(CAST({far} AS BIGINT) * 256 + k) AS m FROM part JOIN c{r} USING (p) GROUP BY vec_id, p))")
        if r < ROUNDS:
            steps.append(f"s{r} AS (SELECT p, k, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r}, range(1, 1025) t(i) WHERE i <= len(x) GROUP BY p, k, i)")
            steps.append(f"n{r} AS (SELECT p, k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY p, k)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (p, k))")
    last = ROUNDS
    steps.append(f"book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{last})")
    steps.append(f"done AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY vec_id)")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM done JOIN kept USING (vec_id), book"


ORACLE_SQL = {"op13_codebooks": _oracle()}
