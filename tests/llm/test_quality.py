import random

from evidra.llm import quality

from .helpers import same

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_words string"


def brute_repeats(words):
    grams = {}
    for i in range(len(words) - 2):
        grams.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)})


def test_oracle(spark):
    same(quality.op1_quality_rules(spark, SF), quality.ORACLE_SQL["op1_quality_rules"], SF)


def test_repeats_against_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab cd e".split()) for _ in range(rng.randrange(40))) for _ in range(300)] + ["a b c " * 4000, "x " * 9000]
    df = spark.createDataFrame([(i, t, None, None, "kept") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.n_repeat_words for r in quality.judged(df).collect()}
    assert got == {i: brute_repeats(t.split()) for i, t in enumerate(texts)}


def test_nulls_empties_repeats_and_clashes(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(None, None, None, None, "x"), (1, "", "en", None, "x"), (2, text, None, "s", "x"), (2, text, None, "s", "x"), (3, text + " $$$$$$$$$$" * 100, None, "s", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in quality.judged(df).collect())
    assert out == [("1", 0, True, False), ("2", 80, False, True), ("2", 80, False, True), ("3", 180, True, False), ("None", 0, True, False)]
    kept = quality.quality_filter(df)
    assert kept.columns == df.columns and kept.count() == 2
    assert quality.judged(df.limit(0)).count() == 0


def test_thresholds_follow_each_group(spark):
    rng = random.Random(1)
    quiet = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)), "en", "quiet", "") for i in range(300)]
    code = [(1000 + i, " ".join(f"w{rng.randrange(10**6)} |" for _ in range(60)), "en", "tables", "") for i in range(300)]
    odd = [(9999, " ".join(f"w{rng.randrange(10**6)} |" for _ in range(60)), "en", "quiet", "")]
    out = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(quiet + code + odd, SCHEMA)).collect()}
    assert not out.pop(9999) and all(out.values())


def test_no_size_of_a_group_is_a_limit(spark):
    rng = random.Random(7)

    def doc(i, marks, source):
        return (i, " ".join(f"w{rng.randrange(10**6)}{' |' * (k % 10 < marks)}" for k in range(60)), "en", source, "")

    many = [doc(i, 0, "plain") for i in range(500)]
    own = [doc(1000 + i, 4, "tables") for i in range(260)]
    fences = []
    for n in (150, 199, 200, 201, 260):
        df = spark.createDataFrame(many + own[:n], SCHEMA)
        counted = quality.text_counts(df.select("doc_id", "text", "lang", "source")).withColumn("base_failed", quality.base_failed())
        scored = counted.withColumn("__s", quality.F.struct(*[c.alias(k) for k, c in quality._signals().items()]))
        found = {r["__source"]: r["__fences"]["symbols"] for r in quality.thresholds(quality.sketches(scored, "lang", "source")).collect()}
        fences.append(found["tables"])
    assert fences[1] == fences[2] == fences[3]  # around what was a limit once
    assert fences == sorted(fences)  # the more documents say so, the more their own marks are taken as usual
