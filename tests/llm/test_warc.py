import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql.datasource import EqualTo, StringContains

from evidra.llm import warc

from .helpers import same

SF = "/root/testdata/sf0.001"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    want = set()
    for r in pages:
        data = (r.html or "").encode()
        again = first[r.html or ""] != r.page_id
        want.add((r.page_id, len(data), digest(data), "revisit" if again else "response", first[r.html or ""] if again else None))
    rows = warc.op8_warc(spark, SF).collect()
    assert {tuple(r) for r in rows} == want and len(rows) == len(pages)


def test_round_trip_nulls_repeats_and_pushdown(spark, tmp_path):
    big = "é" * 400_000 + os.urandom(200_000).hex()
    rows = [(3, "http://a\r\nX: y", "same", "z"), (2, None, "same", "z"), (2, None, "same", "z"), (None, "u", None, "z"), (5, "http://b", "", "z"), (6, "http://b/c", big, "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    path = f"file://{tmp_path}/w"
    warc.write_pages(pages, path)
    back = warc.read_archive(spark, path)
    got = sorted((str(r.page_id), r.record_type, r.refers_to, bytes(r.payload).decode()[:9]) for r in back.collect())
    assert got == [("2", "response", None, "same"), ("2", "revisit", 2, ""), ("3", "revisit", 2, ""), ("5", "response", None, ""), ("6", "response", None, "é" * 9), ("None", "revisit", 5, "")]
    assert bytes(back.where("page_id = 6").first().payload).decode() == big
    lazy = warc.read_archive(spark, path, "none").where("record_type = 'revisit' and page_id is not null and target_uri like 'http%'")
    assert [(r.page_id, r.payload) for r in lazy.collect()] == [(3, None)]
    reader = warc.WarcReader(path, "all", True)
    ours, rest = EqualTo(("record_type",), "revisit"), StringContains(("target_uri",), "x")
    assert list(reader.pushFilters([ours, rest])) == [rest] and reader.tests == [("record_type", "in", ("revisit",))]
    for name in os.listdir(tmp_path / "w"):  # any gzip reader can read the files
        if name.endswith(".gz"):
            assert gzip.open(tmp_path / "w" / name).read().startswith(b"WARC/1.1")
    few = warc.revisits(pages, 5).where("record_type = 'revisit'")
    assert few.count() == 0
    warc.write_pages(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read_archive(spark, f"file://{tmp_path}/none").count() == 0


def test_foreign_files(spark, tmp_path):
    one = warc.record("response", 1, "http://a", b"x" * 20_000, 20_000, digest(b"x" * 20_000), None)
    two = warc.record("revisit", 2, "http://a", b"", 20_000, digest(b"x" * 20_000), 1)
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.warc").write_bytes(one + two)
    (tmp_path / "f/b.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two) + gzip.compress(one))
    back = warc.read_archive(spark, f"file://{tmp_path}/f")
    assert sorted((r.page_id, len(r.payload)) for r in back.collect()) == [(1, 20_000)] * 3 + [(2, 0)] * 2
    assert warc.read_archive(spark, f"file://{tmp_path}/f", "none").where("record_type in ('revisit')").count() == 2


def test_unwanted_payloads_are_not_inflated():
    data = b"".join(warc.member(warc.record("response", i, "u", os.urandom(60_000), 60_000, "D", None)) for i in range(50))
    fetched = []

    class File:
        def read_at(self, n, at):
            fetched.append(n)
            return data[at : at + n]

    window = warc._Window(File(), len(data))
    warc_window, warc.WINDOW = warc.WINDOW, 8192
    try:
        assert [c["page_id"] for c, _ in warc.records(window, lambda c: int(c["page_id"] % 2))] == list(range(1, 50, 2))
    finally:
        warc.WINDOW = warc_window
    assert sum(fetched) < len(data) / 3


def test_oracle(spark):
    same(warc.op8_warc(spark, SF), warc.ORACLE_SQL["op8_warc"], SF)


def test_appends_add_up_and_an_overwrite_replaces(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"text {i}") for i in range(6)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    warc.write_pages(pages.where("page_id < 3"), path)
    warc.write_pages(pages.where("page_id >= 3"), path)
    assert sorted(r.page_id for r in warc.read_archive(spark, path).collect()) == [0, 1, 2, 3, 4, 5]
    warc.write_pages(pages.where("page_id = 4"), path, mode="overwrite")
    assert [r.page_id for r in warc.read_archive(spark, path).collect()] == [4]
    assert sum(x.endswith(".gz") for x in os.listdir(tmp_path / "w")) == 1
    warc.write_pages(pages.where("page_id = 5"), path)
    assert sorted(r.page_id for r in warc.read_archive(spark, path).collect()) == [4, 5]


def test_many_repeats_of_one_page_give_one_response(spark, tmp_path):
    rows = [(7, "u", "same")] * 400 + [(7, None, "same"), (9, "v", "same"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    path = f"file://{tmp_path}/w"
    warc.write_pages(pages, path)
    back = warc.read_archive(spark, path).collect()
    assert len(back) == len(rows) and [(r.page_id, r.target_uri) for r in back if r.record_type == "response"] == [(7, "u")]
    assert {r.refers_to for r in back if r.record_type == "revisit"} == {7}


def _read(path, data):
    path.write_bytes(data)
    with pytest.raises(ValueError, match="ends within a record"):
        with open(path, "rb") as file:
            list(warc.records(warc._Window(_Local(file), len(data)), lambda cols: 2))


class _Local:
    def __init__(self, file):
        self.file = file

    def read_at(self, n, at):
        self.file.seek(at)
        return self.file.read(n)


def test_truncated_files(tmp_path):
    """A cut anywhere in the last record is an error, whether it is compressed, with or without lengths, or plain."""
    body = os.urandom(3000).hex().encode()
    raw = warc.record("response", 1, "http://a", body, len(body), digest(body), None)
    whole = warc.member(raw)
    for before in (b"", warc.member(raw)):
        for cut in (3, 15, 20, 30, 60, 200, len(whole) // 2, len(whole) - 1):
            _read(tmp_path / "cut.gz", before + whole[:cut])
    foreign = gzip.compress(raw)
    for cut in (3, 15, 60, 200, len(foreign) // 2, len(foreign) - 1):
        _read(tmp_path / "cut.gz", foreign + foreign[:cut])
    for cut in (1, 40, raw.index(b"\r\n\r\n") + 2, raw.index(b"\r\n\r\n") + 4, 3000, len(raw) - 5):
        _read(tmp_path / "cut", raw + raw[:cut])
    for kept in (raw, raw[:-4], raw + b"\r\n", raw + b"\r\n" * 30):  # only blank lines are missing, or too many
        (tmp_path / "ok").write_bytes(kept)
        with open(tmp_path / "ok", "rb") as file:
            assert [p for _, p in warc.records(warc._Window(_Local(file), len(kept)), lambda cols: 2)] == [body]


def test_truncated_table(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://{k}", "text " * 900 + str(k)) for k in range(5)], "page_id long, url string, html string").coalesce(1)
    warc.write_pages(pages, f"file://{tmp_path}/w")
    name = next(x for x in os.listdir(tmp_path / "w") if x.endswith(".gz"))
    data = (tmp_path / "w" / name).read_bytes()
    (tmp_path / "w" / name).write_bytes(data[:-40])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_archive(spark, f"file://{tmp_path}/w", "none").collect()
