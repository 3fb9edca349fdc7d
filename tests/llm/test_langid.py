import math
import random
import zlib

import pytest

from evidra.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.op10_language(spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.lang_pred in set(lang.values()) for r in rows)
    assert sum(r.rejected for r in rows) < 0.05 * len(rows)


def test_grams_in_stretches(monkeypatch):
    text = "Some words, ünd möre; 123 " * 50
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert (langid.grams(text) == whole).all()


def test_nulls_empties_and_foreign_text(spark):
    train = [(i, "the cat and the dog ran over there" if i % 2 else "le chat et le chien sont dans la rue", "en" if i % 2 else "fr", 0.0) for i in range(40)]
    odd = [(None, "the dog", None, 0.0), (101, None, "en", 0.0), (102, "12 !?", "en", 0.0), (103, "", None, 0.0), (104, "щщщ юююю", None, 0.0), (104, "щщщ юююю", None, 0.0), (105, "la rue " * 60_000, None, 0.0)]
    docs = spark.createDataFrame(train + odd, "doc_id long, text string, lang string, score double")
    out = langid.predict(docs, langid.fit(docs)).collect()
    by = {r.doc_id: r for r in out}
    assert by[None].lang_pred == "en" and by[105].lang_pred == "fr"
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (101, 102, 103))
    assert by[104].rejected and by[104].score < by[1].score and len(out) == 47
    empty = docs.limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert langid.predict(docs.limit(3), langid.fit(empty)).first().lang_pred == "und"


def plain_grams(text):
    """Counts by dimension of 1-, 2- and 3-grams, character by character."""
    low = "".join(c if c.isalpha() else " " for c in text.lower())
    if not low.strip():
        return None
    codes = [32]
    for i, c in enumerate(low):
        if c != " " or (i and low[i - 1] != " "):
            codes.append(ord(c))
    codes.append(32)
    m, counts = 0xFFFFFFFF, {}
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            h = codes[i] * 2654435761 & m
            if n > 1:
                h = (h ^ (codes[i + 1] * 2246822519 & m)) * 3266489917 & m
            if n > 2:
                h = (h ^ (codes[i + 2] * 668265263 & m)) * 374761393 & m
            counts[h >> 20] = counts.get(h >> 20, 0) + 1
    return counts


def unit(v):
    norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
    return {k: x / norm for k, x in v.items()}


def cosine(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def plain_centroids(xs):
    seeds = [0]
    while len(seeds) < min(langid.CLUSTERS, len(xs)):
        far = [max(cosine(x, xs[s]) for s in seeds) for x in xs]
        seeds.append(far.index(min(far)))
    cs = [xs[s] for s in seeds]
    for _ in range(langid.ROUNDS):
        mine = [max(range(len(cs)), key=lambda k: (cosine(x, cs[k]), -k)) for x in xs]
        for k in range(len(cs)):
            if k in mine:
                total = {}
                for x, j in zip(xs, mine, strict=True):
                    if j == k:
                        for d, v in x.items():
                            total[d] = total.get(d, 0.0) + v
                cs[k] = unit(total)
    return cs


def test_equals_plain_nearest_centroids(spark):
    rng = random.Random(6)
    syllables = {"aa": ["ba", "be", "bi", "lo"], "bb": ["ba", "ku", "ke", "ro"], "cc": ["zé", "xö", "lo", "be"]}
    rows = [(i, " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 12))) + rng.choice(["", ". 12!", " ok"]), lang) for i, lang in enumerate(rng.choices(list(syllables), k=90))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    made = [(plain_grams(t), lang) for t, lang in train]
    df = {}
    for counts, _ in made:
        for d in counts:
            df[d] = df.get(d, 0) + 1

    def vector(counts):
        return unit({d: math.log1p(n) * (math.log((1 + len(made)) / (1 + df.get(d, 0))) + 0.05) for d, n in counts.items()})

    def packed(counts):  # the order in which the operator meets a language's texts
        return b"".join(min(counts.get(d, 0), 65535).to_bytes(2, "little") for d in range(langid.DIMS))

    centroids = [(lang, c) for lang in sorted(syllables) for c in plain_centroids([vector(counts) for counts, _ in sorted(((c, x) for c, x in made if x == lang), key=lambda p: packed(p[0]))])]
    out = {r.doc_id: r for r in langid.predict(docs, langid.fit(docs)).collect()}
    for i, t, _ in rows:
        near = [(cosine(vector(plain_grams(t)), c), lang) for lang, c in centroids]
        best = max(s for s, _ in near)
        assert out[i].score == pytest.approx(best, abs=1e-4)
        assert out[i].lang_pred in {lang for s, lang in near if s > best - 1e-4}


def test_one_id_on_very_many_rows_is_bounded_and_ties_go_to_the_first_language(spark):
    rows = [(1, "same words here", "bb")] * 2000 + [(3, "same words here", "aa")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    train = docs.where(~langid.held_out("doc_id"))
    assert train.count() == 4000
    assert {r["count"] for r in langid._sample(train, "doc_id", "text", "lang").groupBy("lang").count().collect()} == {langid.SAMPLE}
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(docs)).collect()} == {"aa"}
