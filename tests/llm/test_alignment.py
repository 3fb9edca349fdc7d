"""Alignments composed from segments against whole texts, token by token."""

import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from evidra.llm import alignment

SF = "/root/testdata/sf0.001"


def whole_text(a, b, bytes_a, bytes_b, text):
    """Groups and links of one text by the definition, or None."""
    if not text:
        return None
    data = (" " + text).encode()
    ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spans = []
    for own, table in zip(ids, (bytes_a, bytes_b), strict=True):
        ends = [0]
        for i in own:
            ends.append(ends[-1] + len(table[i]))
        if b"".join(table[i] for i in own) != data:
            return None
        spans.append(list(zip(ends, ends[1:])))
    shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for high in shared:
        groups.append("|".join(",".join(str(i) for i, (s, e) in zip(own, span, strict=True) if low <= s and e <= high) for own, span in zip(ids, spans, strict=True)))
        low = high
    links = [(x, y) for x, (s, e) in zip(ids[0], spans[0], strict=True) for y, (f, g) in zip(ids[1], spans[1], strict=True) if s < g and f < e]
    return len(ids[0]), len(ids[1]), groups, links


def brute(docs):
    paths = alignment.vocabularies()
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    made = alignment.aligner(*paths)
    found = [(k, whole_text(a, b, made.bytes_a, made.bytes_b, t)) for k, t in docs]
    counts = Counter(x for _, r in found if r for x in r[3])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(n, most.get(y, 0))
    rows = []
    for key, r in found:
        if r is None:
            rows.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            n = [counts[x] for x in r[3]]
            rows.append((key, r[0], r[1], len(r[2]), len(r[3]), sum(counts[x] == most[x[1]] for x in r[3]), sum(n), hashlib.sha256(";".join(r[2]).encode()).hexdigest()))
    return rows, counts, most


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r))


def test_query(spark):
    docs = [(r.doc_id, (r.text or "")[:3000]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]  # the plain way takes the square of a text's length
    got = alignment.align(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), *alignment.vocabularies())
    rows, counts, most = brute(docs)
    assert order(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.rows.collect()) == order(rows)
    assert {(r.a, r.b): (r["count"], r.is_best) for r in got.pairs.collect()} == {x: (n, n == most[x[1]]) for x, n in counts.items()}
    whole = alignment.op11_alignment(spark, SF)
    assert whole.count() == len(docs) and set(whole.columns) == {"doc_id", *COLUMNS}


BITS = ["a", "the", "ing", " ", "  ", "\n", "\t", "\r", "1", "23", "é", "中", "🙂", "\x1c", "\x85", "\xa0", " ", "　", "'s", "'LL", "!!", "\x00", "²", "_", "<|endoftext|>", "<s>", "<0x0A>", "<unk>", "\r\n", "\n\n", "﻿", "​", ";", "{"]


def test_segments_compose():
    """Tokens of random texts are those of their segments, for both vocabularies; and of every single character."""
    made = alignment.aligner(*alignment.vocabularies())
    assert set(made.cuts) == set(" \n\t")
    rng = random.Random(6)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 30))) for _ in range(6000)]
    texts += [f"{chr(c)} a{chr(c)}b" for c in (0xFFFD, 0xFFFE, 0xFFFF, 0x10FFFF, 0x1F600, 0x9FFF, 0xAC00)]
    texts += [f"x{chr(c)}y {chr(c)}{chr(c)}\n{chr(c)} " for c in [*range(0x3000), *range(0xE000, 0x11000, 7), *range(0x1F000, 0x1FA00, 5)] if chr(c) != alignment.MARK]
    for text in texts:
        parts = made.segments(" " + text)
        assert "".join(parts) == " " + text
        tokens = list(made.tokens(parts))
        assert [i for a, _ in tokens for i in a] == made.a.encode(" " + text, add_special_tokens=False).ids, text
        assert [i for _, b in tokens for i in b] == made.b.encode(text), text
        made.align(parts)


def test_rows(spark, monkeypatch):
    """Nulls, empties, marks, repeats, long texts, null keys; bundles of one document and of many."""
    rng = random.Random(7)
    docs = [(k, "".join(rng.choice(BITS) for _ in range(rng.randrange(40)))) for k in range(60)]
    docs += [(60, None), (61, ""), (62, "a▁b the"), (63, " "), (64, "\n"), (64, "\n"), (None, "the end"), (65, "word " * 300), (66, "x" * 400)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, codes int")
    rows = brute(docs)[0]
    for size in (1, 100, 1 << 20):
        monkeypatch.setattr(alignment, "BUNDLE", size)
        got = alignment.align(df.repartition(3), *alignment.vocabularies()).rows
        assert order(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.collect()) == order(rows)
    whole = alignment.align(df, *alignment.vocabularies(), whole=True).rows
    digests = {hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "" for r in whole.collect()}
    assert digests == {r[-1] for r in rows}


def test_empty_table(spark):
    got = alignment.align(spark.createDataFrame([], "doc_id long, text string"), *alignment.vocabularies())
    assert got.rows.collect() == [] and got.pairs.collect() == []


def test_other_vocabularies_are_refused(tmp_path):
    import public_tokenizers

    with pytest.raises(ValueError, match="cut before white space"):
        alignment.Aligner(public_tokenizers.path("word_bpe_49k.json"), alignment.vocabularies()[1])
