import hashlib
import random

import tiktoken

from evidra.llm import bpe

SF = "/root/testdata/sf0.001"


def reference():
    path, pattern = bpe.vocabulary()
    codec = bpe.codec(path, pattern)
    return codec, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.ranks, special_tokens={})


def test_codec_equals_tiktoken():
    codec, ref = reference()
    rng = random.Random(1)
    bits = ["a", "the", "ing", " ", "  ", "\n", "\t", "1", "23", "é", "ß", "中", "문", "🙂", "\x1c", "\x85", "\xa0", " ", "​", "'s", "'LL", "!!", "\x00", "́", "²", "_", "<|", "\r\n", "　"]
    for _ in range(5000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        ids = codec.encode(text)
        assert ids == ref.encode_ordinary(text), text
        assert codec.decode(ids).decode() == text
    for text in ("a" * 30_000, " " * 30_000 + "x", "ab" * 9000, "aaaaaaaab" * 3000):
        assert codec.encode(text) == ref.encode_ordinary(text)


def test_memo_overflow_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 5)
    codec, ref = reference()
    text = "some words come back, some words never do: some words"
    assert codec.encode(text * 20) == ref.encode_ordinary(text * 20)


def test_rows(spark):
    path, pattern = bpe.vocabulary()
    df = spark.createDataFrame([(1, "Hello wörld", "x"), (2, None, "y"), (3, "", "z"), (3, "", "z"), (None, "a", None)], "doc_id long, text string, ids string")
    coded = bpe.encode(df, path, pattern)
    assert sorted(coded.columns) == ["doc_id", "ids", "text"]
    back = bpe.decode(coded, path, pattern)
    assert sorted((r.text or "").encode() for r in back.collect()) == sorted(bytes(r.data) for r in back.collect())
    assert bpe.encode(df.limit(0), path, pattern).count() == 0
    assert bpe.digests(df, path, pattern).count() == 5


def test_query(spark):
    _, ref = reference()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op4_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = ref.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_clashing_columns_stay(spark):
    path, pattern = bpe.vocabulary()
    df = spark.createDataFrame([(1, "a b", "x", "y", "z", "old")], "doc_id long, text string, __coded string, coded string, __in string, ids string")
    row = bpe.encode(df, path, pattern, checked="ok").first()
    assert row.asDict() == {"doc_id": 1, "text": "a b", "__coded": "x", "coded": "y", "__in": "z", "ids": bpe.codec(path, pattern).encode("a b"), "ok": True}


def test_pairs_are_decided_as_merging_decides():
    codec, ref = reference()
    rng = random.Random(2)
    tokens = [i for i in codec.token if codec.halves[i]]
    for _ in range(3000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        assert codec.pairs[a * codec.ids + b] == (ref._core_bpe.encode_single_piece(codec.token[a] + codec.token[b]) == [a, b])
