"""Id files against the tokenizers library and plain arithmetic."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from evidra.llm import planes

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, start, n_tokens, ids_crc32) and ids of rows (doc_id, text) in the order of their ids."""
    library, at, found = Tokenizer.from_file(planes.vocabulary()), 0, []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, planes.END_ID]
        found.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    return found


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in planes.op12_planes(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert got == [x[:4] for x in brute(sorted((r[0], r[1]) for r in docs))]


def test_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr("evidra.llm.bpe.MEMO", 3000)  # generations come and go
    library, mine = Tokenizer.from_file(planes.vocabulary()), planes.Encoder(planes.vocabulary())
    rng = random.Random(2)
    bits = ["a", "the", "ing", " ", "  ", "\n", "\t", "1", "23", "é", "中", "🙂", "\x1c", "\x85", "\xa0", " ", "'s", "'LL", "!!", "\x00", "²", "_", "<|endoftext|>", "<|", "\r\n", "x" * 200]
    for _ in range(400):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(8)]
        for text in texts:
            assert np.frombuffer(mine.packed(text), np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 8, 9, 1000):
        for top in (1, 300, 50_000, 2**32):
            ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            parts = planes.split(ids, kind)
            assert len(parts) == (4 if kind == "byte" else 32)
            if n:
                assert planes.joined([p if p.strip(b"\0") else b"" for p in parts], n, kind).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files(spark, tmp_path, monkeypatch, kind):
    rows = [(7, "b"), (None, "null key"), (3, None), (3, ""), (5, "long text, " * 40_000), (7, "b"), (-2, "x <|endoftext|> y"), (9, "a\n\nb"), (None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, ids string").repartition(3)
    path = f"file://{tmp_path}/{kind}"
    planes.write_tokens(docs, path, planes.vocabulary(), planes=kind)
    back = planes.read_tokens(spark, path)
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32, r.ids) for r in back.collect())
    texts = {}
    for key, text in rows:
        texts.setdefault(((key is not None), key or 0), []).append(text or "")
    assert [x[0] for x in got] == sorted(k for k, v in texts.items() for _ in v)
    library = Tokenizer.from_file(planes.vocabulary())
    at = 0
    for key, start, n, crc, ids in got:
        assert (start, n, crc) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += n
    for key, values in texts.items():
        assert sorted(x[4] for x in got if x[0] == key) == sorted([*library.encode(v, add_special_tokens=False).ids, planes.END_ID] for v in values)
    assert {r.doc_id for r in back.where("doc_id >= 5 and doc_id < 9").collect()} == {5, 7}
    assert {r.doc_id for r in back.where(F.col("doc_id").isin(-2, 9, 400)).collect()} == {-2, 9}
    assert back.where("doc_id is null").count() == 2
    with pytest.raises(Exception, match="holds ids already"):
        planes.write_tokens(docs, path, planes.vocabulary())
    planes.write_tokens(docs.where("doc_id = 9"), path, planes.vocabulary(), mode="overwrite")
    assert [(r.doc_id, r.start) for r in planes.read_tokens(spark, path).collect()] == [(9, 0)]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    planes.write_tokens(docs, f"file://{tmp_path}/none", planes.vocabulary())
    assert planes.read_tokens(spark, f"file://{tmp_path}/none").collect() == []


def test_small_files_and_blocks(tmp_path, monkeypatch):
    """Files roll over, blocks hold parts of documents, and a reader fetches the blocks that it needs only."""
    import pyarrow as pa

    monkeypatch.setattr(planes, "BLOCK", 16)
    monkeypatch.setattr(planes, "FILE_IDS", 100)
    monkeypatch.setattr(planes, "FILE_DOCS", 12)
    monkeypatch.setattr("pyspark.TaskContext.get", classmethod(lambda cls: type("C", (), {"partitionId": lambda self: 0})()))
    rng = np.random.default_rng(4)
    docs = [(k, rng.integers(0, 50_000, rng.integers(0, 60)).tolist()) for k in range(80)]
    writer = planes.PlaneWriter(f"file://{tmp_path}/w", "byte", False)
    batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int64()), pa.array([x for _, x in part], pa.list_(pa.int32()))], names=["key", "ids"]) for part in (docs[:33], docs[33:34], docs[34:])]
    message = writer.write(iter(batches))
    assert len(message.files) > 5 and all(f["n_docs"] <= 12 for f in message.files)
    writer.commit([message, None])
    reader = planes.PlaneReader(f"file://{tmp_path}/w", True)
    got = [(k, s, x) for part in reader.partitions() for b in reader.read(part) for k, s, x in zip(*(b.column(i).to_pylist() for i in (0, 1, 4)), strict=True)]
    starts = np.cumsum([0, *(len(x) for _, x in docs)]).tolist()
    assert sorted(got) == [(k, s, x) for (k, x), s in zip(docs, starts, strict=False)]
    one = planes.PlaneReader(f"file://{tmp_path}/w", True)
    one.among = {40}
    parts = one.partitions()
    assert len(parts) == 1 and [b.column(4).to_pylist() for p in parts for b in one.read(p)] == [[docs[40][1]]]
    name = f"{tmp_path}/w/{parts[0].file['name']}"
    data = bytearray(open(name, "rb").read())
    data[len(planes.MAGIC) + 12] ^= 0xFF
    open(name, "wb").write(data)
    with pytest.raises(Exception, match=r"checksum|frame|decompress"):
        [b for p in reader.partitions() for b in reader.read(p)]


def test_texts_are_encoded_where_they_are_written(spark, tmp_path):
    """One Python worker a task: no step before the writer hands ids from process to process."""
    docs = spark.createDataFrame([(k, f"words of {k}, and more") for k in range(40)], "doc_id long, text string")
    plain = planes.PlaneWriter(f"file://{tmp_path}/w", "byte", False, planes.vocabulary(), planes.END_ID)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["one two", None])], names=["key", "text"])
    (keys, lists), = plain._with_ids(iter([batch]))
    assert keys == [1, 2] and lists.to_pylist() == [x[4] for x in brute([(1, "one two"), (2, None)])]
    called = []
    whole, planes.encode = planes.encode, lambda *a, **k: called.append(a) or whole(*a, **k)
    try:
        planes.write_tokens(docs, f"file://{tmp_path}/t", planes.vocabulary())
    finally:
        planes.encode = whole
    assert not called and planes.read_tokens(spark, f"file://{tmp_path}/t").count() == 40
