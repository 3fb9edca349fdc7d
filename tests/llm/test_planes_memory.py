"""Workers outlive tasks: what a task remembers of words goes with it."""

from evidra.llm import planes


def test_memos_are_emptied_after_a_task(spark):
    path = planes.vocabulary()
    docs = spark.createDataFrame([(i, f"words number {i} of many") for i in range(50)], "doc_id long, text string").coalesce(1)

    def held(batches):
        import pyarrow as pa

        from evidra.llm import planes

        for _ in batches:
            e = planes._LOADED.get(path)
            yield pa.RecordBatch.from_pydict({"n": [len(e.words) + len(e.parts) + len(e.words.older) if e else 0]})

    for _ in range(3):
        assert planes.encode(docs, path).count() == 50
        planes.encode(docs, path).collect()
    assert {r.n for r in spark.range(8).repartition(8).mapInArrow(held, "n long").collect()} == {0}
