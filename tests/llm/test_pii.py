"""Spans against plain left-to-right regular expressions."""

import random
import re

from evidra.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((m.start(), rank, kind, m.end()))
    return [(s, k, e) for s, _, k, e in sorted(spans)]


def base(text):
    return [x for x in pii.find_spans(text) if x[1] in pii.BASE]


def test_base_equals_patterns_on_random_strings():
    rng = random.Random(5)
    bits = ["1", "22", "255", "256", "0", ".", ".", "-", " ", "@", "a", "b.c", "+", "(", ")", "é", "x@y.z", "+1 (555) 010-2030", "4111 1111 1111 1111", "10.0.0.1", "9807915762804490", "_", "%"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert base(text) == brute(text), text


def test_added_kinds():
    text = 'see https://a.example.com/x?y=1, token = "24be64439e3e49cf46b2d7c9" IBAN: DE89 3704 0044 0532 0130 00 ok account no: 12345678.'
    found = [(k, text[s:e]) for s, k, e in pii.find_spans(text) if k not in pii.BASE]
    assert found == [("url", "https://a.example.com/x?y=1"), ("secret", "24be64439e3e49cf46b2d7c9"), ("account", "DE89 3704 0044 0532 0130 00"), ("account", "12345678")]


def test_long_texts_stay_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "+1" + "(" * 200_000, "1 " * 100_000):
        assert base(text) == [] if "." not in text else base(text)


def test_redaction_and_rows(spark):
    rows = [(1, "write to ann@x.example.com or +1 (555) 010-2030", 7), (2, None, 0), (3, "", 0), (3, "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = sorted((r.doc_id, r.text, r.n_chars) for r in pii.redact(df).collect() if r.text is not None)
    assert out == [(1, "write to <EMAIL> or <PHONE>", 27), (3, "", 0), (3, "", 0)]
    assert pii.redact(df).columns == df.columns
    spans = {r.doc_id: [(x.kind, x.start, x.end) for x in r.pii_spans] for r in pii.with_spans(df).collect()}
    assert spans[2] == [] and spans[1][0] == ("email", 9, 26)
    assert pii.digests(df.limit(0)).count() == 0
    assert {r.n_email for r in pii.digests(df).collect()} == {0, 1}


def test_query_against_patterns(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = pii.op7_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in want) for k in pii.BASE]


def test_cues_without_an_end_take_no_longer_than_their_length():
    import time

    cues = [*pii.SCHEMES, *pii.ACCOUNT_CUES, *pii.SECRET_CUES, "token=", "secret: ", "http://a", "a@", "+1 ", "1.", "12-", "a.b@c.", "token=1", "password=."]
    for cue in cues:
        began = time.process_time()
        pii.find_spans(cue * (1_000_000 // len(cue)))
        assert time.process_time() - began < 5, cue


def test_clashing_columns_and_long_rows(spark):
    long = "x " * 300_000 + "ann@x.example.com"
    rows = [(1, long, len(long), "a", "b", "c"), (2, None, 0, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, __redacted string, __in string, redacted string")
    out = {r.doc_id: r for r in pii.redact(df).collect()}
    assert pii.redact(df).columns == df.columns
    assert out[1].text == "x " * 300_000 + "<EMAIL>" and tuple(out[1])[3:] == ("a", "b", "c") and out[2].text is None
    assert pii.digests(df.withColumnRenamed("__in", "spans")).where("doc_id = 1").first().spans == f"email:600000:{len(long)}"
