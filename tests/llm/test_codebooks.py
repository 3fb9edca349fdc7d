"""Codes against plain Lloyd rounds, and against SQL."""

import hashlib
import math

import numpy as np
import pytest

from evidra.llm import codebooks

from .helpers import oracle, rows_of

SF = "/root/testdata/sf0.001"


def plain(vectors, parts, entries, rounds):
    """Codes, errors and codebooks of integer vectors in the order of their keys."""
    books = [x.copy() for x in np.split(vectors[:entries], parts, axis=1)]
    split = np.split(vectors, parts, axis=1)
    for r in range(rounds + 1):
        far = [((x[:, None] - b) ** 2).sum(axis=2) for x, b in zip(split, books, strict=True)]
        codes = [f.argmin(axis=1) for f in far]
        if r < rounds:
            for x, b, c in zip(split, books, codes, strict=True):
                for k in set(c.tolist()):
                    b[k] = [sum(col) // len(col) for col in x[c == k].T.tolist()]
    return np.stack(codes, axis=1), sum(f.min(axis=1) for f in far), books


def test_query(spark):
    names, rows = oracle(codebooks.ORACLE_SQL["op13_codebooks"], SF)
    df = codebooks.op13_codebooks(spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, rows)


@pytest.mark.parametrize("spread", [2, 40, 2000])
def test_bounds_change_nothing(spread):
    """Many ties at a small spread; groups are skipped in later rounds."""
    rng = np.random.default_rng(spread)
    centres = rng.integers(-spread, spread + 1, (60, 6))
    points = centres[rng.integers(0, 60, 3000)] + rng.integers(-1, 2, (3000, 6))
    book = codebooks.clustered(points[:90].copy())
    own = low = None
    skipped = 0
    for _ in range(6):
        own, least, low, n = codebooks.assign(points, book, own, low)
        far = ((points[:, None] - book.entries) ** 2).sum(axis=2)
        assert own.tolist() == far.argmin(axis=1).tolist() and least.tolist() == far.min(axis=1).tolist()
        rest = far.astype(float)
        rest[np.arange(len(points)), own] = np.inf
        for g, members in enumerate(book.members):
            assert (low[:, g] <= np.sqrt(rest[:, members].min(axis=1))).all()
        skipped += n < len(points) * len(book.members)
        new = book.entries.copy()
        for k in set(own.tolist()):
            new[k] = [sum(c) // len(c) for c in points[own == k].T.tolist()]
        book = book.moved(new)
    assert skipped >= 4


def test_rows(spark):
    """Nulls, non-finite components, short vectors, repeated rows, null keys and labels, negative floors, clashing names."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.01, 10)], ["a", "b", None][i % 3], i) for i in range(400)]
    rows += [(None, [0.5] * 10, "a", 0), (400, [-0.0001] * 3, "b", 0), (401, [], None, 0), rows[7], rows[7]]
    odd = [(500, None, "a", 0), (501, [math.nan] * 10, "a", 0), (502, [math.inf] + [0.0] * 9, "b", 0), (503, [None] * 10, None, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label string, codes int").repartition(5)
    made = codebooks.compress(df, entries=16, rounds=3)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    vectors = np.array([[math.floor(1024 * x) for x in r[1]] + [0] * (12 - len(r[1])) for r in order], np.int64)
    codes, errors, books = plain(vectors, 4, 16, 3)
    want = sorted(((r[0] is None, r[0] or 0), r[2] or "", bytes(c.tolist()), int(e)) for r, c, e in zip(order, codes, errors, strict=True))
    assert sorted(((r.key is None, r.key or 0), r.label or "", bytes(r.codes), r.error) for r in made.rows.collect()) == want
    assert [b.tolist() for b in made.books] == [b.tolist() for b in books]
    assert made.digest() == hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    assert len(made.scanned) == 3 and made.scanned[-1] <= made.scanned[0]


@pytest.mark.parametrize("scale", [1, 40, 4000])
def test_components_of_all_sizes(spark, scale):
    rng = np.random.default_rng(scale)
    rows = [(i, [float(x) for x in rng.normal(0, scale, 4)], 1) for i in range(60)]
    made = codebooks.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), parts=2, entries=8, rounds=2)
    codes, errors, books = plain(np.array([[math.floor(1024 * x) for x in r[1]] for r in rows], np.int64), 2, 8, 2)
    assert sorted((r.key, bytes(r.codes), r.error) for r in made.rows.collect()) == [(i, bytes(c.tolist()), int(e)) for i, (c, e) in enumerate(zip(codes, errors, strict=True))]


def test_few_and_none(spark):
    df = spark.createDataFrame([(2, [1.0, 2.0], 1), (1, [3.0, 4.0], 1)], "vec_id long, embedding array<float>, label int")
    made = codebooks.compress(df)
    assert sorted((r.key, bytes(r.codes), r.error) for r in made.rows.collect()) == [(1, b"\0\0\0\0", 0), (2, b"\1\1\0\0", 0)]
    assert codebooks.compress(df.where("vec_id > 5")).rows.collect() == []
    with pytest.raises(ValueError, match="too large"):
        codebooks.compress(spark.createDataFrame([(1, [1e30], 1)], df.schema))
