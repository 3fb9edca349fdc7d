"""Cases in which an operator once did less than its whole job."""

import random

from evidra.operators import evidence, sequences, similarity


def test_chunks_cover_a_very_long_text():
    text = "Some words here. " * 100_000
    spans = sequences.chunk_spans(text, 1000, 100, 50)
    assert len(spans) > 1001 and spans[-1][1] == len(text)
    assert all(a < c <= b for (a, b), (c, _) in zip(spans, spans[1:], strict=False))
    assert sequences.chunk_spans("a. " * 10, 5, 0, 20)[-1][1] == 30  # a margin beyond the size


def test_null_blocks_are_one_block(spark):
    df = spark.createDataFrame([(1, "a b c", None), (2, "a b c", None), (3, "a b c", "x"), (4, "a b c", "x"), (5, "a b c", "")], "id long, text string, source string")
    assert sorted((r.left_id, r.right_id) for r in similarity.jaccard_join(df, "id", "text", 0.8, "source").collect()) == [(1, 2), (3, 4)]


def test_spans_of_all_lengths_meet(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 2, None]), s := rng.randrange(3000), s + int(2 ** (rng.random() * 12)) - (rng.random() < 0.05) * 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g long, s long, e long")
    want = set()
    for i, g, s, e in rows:
        for j, h, t, f in rows:
            if i < j and g is not None and g == h and e > s and f > t and min(e, f) - max(s, t) >= 0.3 * min(e - s, f - t) and min(e, f) > max(s, t):
                want.add((i, j))
    assert {(r.left_id, r.right_id) for r in evidence.overlapping(df, "g", "id", "s", "e", 0.3).collect()} == want
    assert evidence.overlapping(df, "g", "id", "s", "e", 0.3).count() == len(want)


def test_copies_pair_with_their_first(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a b c d e", "e d c b a", "A, b c d e!", "a b c d e f", "f e d c b a", "", None])], "id long, text string")
    got = {(r.left_id, r.right_id, round(r.jaccard, 3)) for r in similarity.jaccard_join(df, "id", "text", 0.8, stars=True).collect()}
    assert got == {(0, 1, 1.0), (0, 2, 1.0), (3, 4, 1.0), (0, 3, 0.833)}
    assert similarity.jaccard_join(df, "id", "text", 0.8).count() == 3 + 1 + 6


def test_links_follow_folded_quotes_in_both_ways(spark):
    quotes = [
        (1, 10, 0, 50, "alpha beta gamma delta", 0.5),
        (1, 11, 20, 60, "alpha beta gamma delta epsilon", 0.9),  # overlaps 10, which grows and takes the longer text
        (1, 12, 100, 120, "quite another thing", 0.4),
        (1, 13, 100, 120, "quite another thing", 0.3),  # the same span: absorbed, yet of a span that is kept
        (2, 20, 100, 120, "of a second episode", 0.4),
    ]
    schema = "episode_id long, quote_id long, start_pos long, end_pos long, text string, score double"
    df = spark.createDataFrame(quotes, schema).selectExpr("*", "'s' AS speaker", "cast(1 AS bigint) AS ts")
    links = spark.createDataFrame([(7, 10), (7, 11), (8, 11), (8, 12), (9, 13), (9, 20)], "claim_id long, quote_id long")
    kept = evidence.folded(df, "episode_id")
    spans = {r.quote_id: (r.start_pos, r.end_pos, r.text, r.score, sorted(r.merged)) for r in kept.collect()}
    assert spans == {10: (0, 60, "alpha beta gamma delta epsilon", 0.9, [10, 11]), 12: (100, 120, "quite another thing", 0.4, [12, 13]), 20: (100, 120, "of a second episode", 0.4, [20])}
    assert {tuple(r) for r in evidence.remapped(links, df, kept, "episode_id").collect()} == {(7, 10), (8, 10), (8, 12), (9, 12), (9, 20)}
    assert {tuple(r) for r in evidence.remapped(links, df, kept, "episode_id", "exact").collect()} == {(8, 12), (9, 12), (9, 20)}
