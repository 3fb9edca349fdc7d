import random
import re

import xxhash

from evidra.llm import simhash

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items):
    """items: (id, fingerprint); smallest reachable id by breadth-first search."""
    names = {}
    left = list(range(len(items)))
    while left:
        todo, group = [left.pop()], []
        while todo:
            i = todo.pop()
            group.append(i)
            near = [j for j in left if ((items[i][1] ^ items[j][1]) & (1 << 64) - 1).bit_count() <= 2]
            left = [j for j in left if j not in near]
            todo += near
        ids = [items[i][0] for i in group if items[i][0] is not None]
        for i in group:
            names[i] = min(ids, default=None)
    return [names[i] for i in range(len(items))]


def test_fingerprints():
    rng = random.Random(2)
    for text in ["", " \t\n", "One", "ÄB Cd", "a b c", *[" ".join(rng.choice(["A", "b", "É", "dd", "e\x0bf", " "]) for _ in range(rng.randrange(60))) for _ in range(200)]]:
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def near(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value - (1 << 64) if value >> 63 else value


def test_tree_finds_every_group():
    rng = random.Random(4)
    for size in (3, 10, 60):
        for _ in range(40):
            centre = rng.getrandbits(64)
            values = list({near(rng, centre, rng.randrange(5)) for _ in range(size)})
            found = dict(simhash.tree_links(values))
            roots = [found.get(v, v) for v in values]
            want = brute_components(list(enumerate(values)))
            assert len(set(zip(roots, want, strict=True))) == len(set(roots)) == len(set(want))


def test_links_and_components_on_random_fingerprints(spark):
    rng = random.Random(7)
    values = set()
    for _ in range(30):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):  # chains, so that groups are wider than the radius
            v = near(rng, v & (1 << 64) - 1, rng.randrange(1, 4))
            values.add(v)
    items = [(i, v) for i, v in enumerate(values)] + [(500 + i, v) for i, v in enumerate(list(values)[:20])]
    rows = spark.createDataFrame(items, "doc_id long, fp long")
    named = {r.fp: r.component_id for r in simhash.grouped(rows, "doc_id").collect()}
    assert [named[v] for _, v in items] == brute_components(items)


def test_nulls_empties_repeats(spark):
    long = "many words " * 50_000
    rows = [(None, None, "a"), (4, "", "a"), (3, "  ", "a"), (None, "alone here now", "a"), (8, long, "a"), (8, long, "a"), (9, long, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    out = sorted((str(r.doc_id), r.fingerprint == "0" * 16, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert out == [("3", True, 3), ("4", True, 3), ("8", False, 8), ("8", False, 8), ("9", False, 8), ("None", False, None), ("None", True, 3)]
    kept = simhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in texts]
    want = {i: (f"{fp:016x}", c) for (i, fp), c in zip(prints, brute_components(prints), strict=True)}
    rows = simhash.op5_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(want)
