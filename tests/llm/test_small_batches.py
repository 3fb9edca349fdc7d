"""What goes to a Python worker and back is bounded in bytes, and a text that is replaced travels once each way."""

import pyarrow as pa
import pytest

from evidra.llm import bpe, common, near, pii, simhash

TEXT = "mail a@b.example or call +49 170 1234567 " + "of words " * 400


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})


@pytest.fixture
def fresh(spark):
    """A session without a setting for the bytes of a batch."""
    was = spark.conf.get(common.BATCH_SETTING, None)
    spark.conf.unset(common.BATCH_SETTING)
    yield spark
    spark.conf.unset(common.BATCH_SETTING) if was is None else spark.conf.set(common.BATCH_SETTING, was)


def docs(spark, n=3000):
    return spark.range(n, numPartitions=1).selectExpr("id as doc_id", f"'{TEXT}' as text", "1 as n_chars")


@pytest.mark.parametrize(
    "operator",
    [pii.redact, pii.digests, lambda df: near.with_sets(df.select("doc_id", "text"), "text", "bands"), lambda df: simhash.with_fingerprint(df), lambda df: bpe.encode(df, *bpe.vocabulary())],
    ids=["redact", "digests", "sets", "fingerprints", "ids"],
)
def test_batches_are_bounded_in_bytes(fresh, operator):
    operator(docs(fresh, 1)).collect()
    found = docs(fresh).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in found) == 3000
    assert max(r["size"] for r in found) < 1.1 * common.BATCH_BYTES  # all rows at once are 11 MB


def test_a_long_row_goes_alone_and_whole(fresh):
    rows = fresh.range(3, numPartitions=1).selectExpr("id as doc_id", "concat(repeat('x ', 3000000), 'a@b.example') as text")
    assert {r.text[-8:] + str(len(r.text)) for r in pii.redact(rows).collect()} == {" <EMAIL>6000007"}
    assert [r.n for r in rows.mapInArrow(sizes, "n long, size long").collect()] == [1, 1, 1]


def test_a_setting_of_the_session_stays(fresh):
    fresh.conf.set(common.BATCH_SETTING, "9m")
    assert pii.redact(docs(fresh, 2)).count() == 2
    assert fresh.conf.get(common.BATCH_SETTING) == "9m"


def test_a_replaced_text_travels_once_each_way(spark, monkeypatch):
    rows = docs(spark, 600)
    seen, own = [], type(rows).mapInArrow

    def noted(self, func, schema, *args, **named):
        seen.append((len(self.columns), schema.fieldNames()))
        return own(self, func, schema, *args, **named)

    monkeypatch.setattr(type(rows), "mapInArrow", noted)
    made = pii.redact(rows)
    assert seen == [(3, ["doc_id", "n_chars", "redacted"])]
    assert made.columns == rows.columns
    assert {(r.text, r.n_chars) for r in made.collect()} == {(pii.redacted(TEXT), len(pii.redacted(TEXT)))}
    kept = common.arrow_column(rows, "text", "size", "long", lambda values: pa.array(map(len, values)))
    assert seen[1] == (3, ["doc_id", "text", "n_chars", "size"])  # a column that stays is sent once
    assert {(r.text, r["size"]) for r in kept.collect()} == {(TEXT, len(TEXT))}
