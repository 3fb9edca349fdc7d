import random

import corpus_pipeline
from evidra.llm import near


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute_kept(items, similarity=0.8):
    """items: (id, text); the smallest id of each group that pairs at or above ``similarity`` connect."""
    sets = [(i, brute_set(t)) for i, t in items]
    kept, left = [], sets
    while left:
        todo, group, left = [left[0]], [], left[1:]
        while todo:
            i, s = todo.pop()
            group.append(i)
            near = [x for x in left if len(s & x[1]) >= similarity * len(s | x[1])]
            left = [x for x in left if x not in near]
            todo += near
        kept.append(min(group))
    return sorted(kept)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_stage_keeps_one_of_each_group_at_the_threshold(spark):
    rng = random.Random(5)
    items = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 300))]
        items.append(" ".join(words))
        for _ in range(rng.randrange(4)):  # chains on both sides of the threshold
            words = edited(rng, words, rng.randrange(max(2, len(words) // 25)))
            items.append(" ".join(words).title() + " \n")
    shared = [f"s{i}" for i in range(40)]  # a passage shared by unlike texts joins none of them
    items += [" ".join(shared + [f"t{i}x{j}" for j in range(40)]) for i in range(20)] + ["", "  ", "one two", "One  two"]
    rng.shuffle(items)
    rows = list(enumerate(items))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, source string").repartition(3)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, df, "")
    assert kept.columns == df.columns
    want = brute_kept(rows)
    assert len(want) < len(rows) and sorted(r.doc_id for r in kept.collect()) == want


def test_a_filter_that_lets_all_pass_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(near, "FILTER_BITS", 64)
    rng = random.Random(3)
    items = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(80)]
    items += [" ".join(edited(rng, t.split(), 2)) for t in items[:40]]
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in near.deduplicated(df).collect()) == brute_kept(list(enumerate(items)))


def test_bucket_torn_by_its_star_is_compared_across(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(400)]
    family = []
    for at in range(12):  # each differs from its neighbours by one word in a window, so only neighbours reach 0.8
        words = list(base)
        for j in range(at * 2, at * 2 + 10):
            words[(j * 37) % 400] = f"v{j}"
        family.append(" ".join(words))
    rng.shuffle(family)
    rows = list(enumerate(family))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in near.deduplicated(df).collect()) == brute_kept(rows)


def test_nulls_and_repeats(spark):
    rows = [(None, None), (4, ""), (3, "  "), (None, "alone here now"), (8, "many words " * 5000), (8, "many words " * 5000), (9, "many words " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in near.deduplicated(df).collect()) == ["3", "8", "None"]
    assert near.deduplicated(df.limit(0)).count() == 0


def test_clashing_columns_and_the_operator_that_calls(spark):
    from evidra.llm import simhash

    rows = [(1, "one two three four five six", "a", "b", 1.5), (2, "one two three four five six", "c", "d", 2.5), (3, "other words", "e", "f", 3.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __row string, set_id string, bands double").withColumn("__fp", near.F.lit("own"))
    for out in (simhash.deduplicated(df, similarity=0.8), simhash.deduplicated(df)):
        assert out.columns == df.columns
        assert sorted(map(tuple, out.collect())) == [(*rows[0], "own"), (*rows[2], "own")]


def test_copies_of_one_text_need_no_pairs(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(1, 9)))) for i in range(300)]
    df = spark.createDataFrame([*rows, (999, " ".join(base))], "doc_id long, text string").repartition(4)
    compared = []
    whole = near._compared

    def counting(pairs, sets):
        compared.append(pairs.count())
        return whole(pairs, sets)

    near._compared = counting
    try:
        kept = sorted(r.doc_id for r in near.deduplicated(df).collect())
    finally:
        near._compared = whole
    assert kept == brute_kept([*rows, (999, " ".join(base))])
    assert sum(compared) < 301 * 20  # of 45,150 pairs
