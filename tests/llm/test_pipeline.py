"""Each stage against brute force on the smallest tables."""

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from evidra.llm import bpe, pii, quality

from .helpers import oracle
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    whole = {r.doc_id: r for r in docs.collect()}

    names, rows = oracle(quality.ORACLE_SQL["op1_quality_rules"], SF)
    kept = {r[names.index("doc_id")] for r in rows if r[names.index("kept")]}
    step = corpus_pipeline.keep_quality(spark, docs, SF).cache()
    assert step.columns == columns and {r.doc_id for r in step.collect()} == kept

    prints = [(i, brute_fingerprint(whole[i].text or "")) for i in sorted(kept)]
    first = {c for c in brute_components(prints)}
    step = corpus_pipeline.keep_one_of_each(spark, step, SF).cache()
    assert step.columns == columns and sorted(r.doc_id for r in step.collect()) == sorted(first)

    step = corpus_pipeline.hide_personal_data(spark, step, SF).cache()
    assert step.columns == columns
    hidden = {r.doc_id: r.text for r in step.collect()}
    assert hidden == {i: pii.redacted(whole[i].text) for i in first}
    assert not any(pii.find_spans(t) for t in hidden.values())

    step = corpus_pipeline.mix_sources(spark, step, SF).cache()
    assert step.columns == columns and {r.doc_id for r in step.collect()} <= first

    path, pattern = bpe.vocabulary()
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.codec(path, pattern).ranks, special_tokens={})
    last = corpus_pipeline.tokenize(spark, step, SF).collect()
    assert len(last) == step.count()
    for r in last:
        assert r.ids == ref.encode_ordinary(hidden[r.doc_id]) and r.roundtrip_ok and r.n_tokens == len(r.ids)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "ids", "n_tokens"} <= set(out.columns)


def test_stages_on_nulls_empties_repeats_and_clashes(spark):
    good = " ".join(f"word{i}" for i in range(120))
    rows = [
        (None, good + " first", None, None, 5, "a"),
        (None, None, None, None, None, "b"),
        (1, "", "en", "s", 0, "c"),
        (2, good, "en", "s", 9, "d"),
        (2, good, "en", "s", 9, "d"),
        (3, (good + " ") * 400, "en", "s", 9, "e"),
        (4, " ".join(f"other{i}" for i in range(200)) + " mail ann@x.example.com", "fr", None, 9, "f"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy string").withColumn("__row", F.lit("kept"))
    docs = df
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != "tokens":
            assert out.columns == df.columns, name
        assert stage(spark, docs.limit(0), "").count() == 0, name
        if name == "near_duplicates":  # the null id's text is a near copy of 2, which has the smaller key
            assert sorted(str(r.doc_id) for r in out.collect()) == sorted({str(r.doc_id) for r in docs.collect()} - {"None"})
        docs = out.cache()
        assert docs.where("__row <> 'kept'").count() == 0
    rows = docs.collect()
    assert rows and all(r.roundtrip_ok and r.n_tokens == len(r.ids) for r in rows)
    assert not any("ann@x" in (r.text or "") for r in rows) and {r["copy"] for r in rows} <= set("adef")


def test_quality_and_mixing_stages_against_their_sql(spark, tmp_path):
    from evidra.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.mix_sources(spark, docs, SF)
    names, rows = oracle(mixing.ORACLE_SQL["op9_mixing"], SF)
    at = names.index("doc_id")
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[at] for r in rows)
