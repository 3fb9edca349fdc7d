"""Alignment of two tokenizers over a corpus: which tokens of one cover the same bytes as which of the other.

A text (with a space before it) is cut into segments before runs of white space, at places that no token of either
vocabulary runs across; that is verified when the vocabularies are loaded.  So the tokens of a text are those of its
segments one after the other, all segment borders are borders of both tokenizers, and each distinct segment is tokenized and
aligned once, however often it occurs.  Byte offsets where tokens of both end cut the tokens into groups; within one, the
tokens whose byte ranges overlap are linked.

Texts are read once, into bundles of bounded size: some documents as numbers of their distinct segments, which are tokenized
and aligned there.  What a bundle knows of its documents by itself is written at once; of the counts over the corpus it needs
those of its distinct id pairs only, so these go out with their counts, are summed, and come back in equi-joins whose one
side is unique, which adaptive execution can split where a pair is frequent.  A bundle with the counts of its pairs is all
that a task holds.  A lost executor repeats its tasks; the stages are stored.

Defined results: texts that are null, empty or hold U+2581 (which the second vocabulary takes for a space, so its bytes
differ) have no tokens, and zeros; a text of any length is aligned whole, in a bundle of its own if it is longer than one;
repeated rows are documents each; null keys stay null; an empty table gives an empty result; strings of special tokens are plain
text; other columns, whatever their names, take no part.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import byte_characters
from .common import stored, table
from .planes import joined, split

#: Characters of the texts in a bundle, about; a longer text is a bundle of its own.
BUNDLE = 8 << 20
#: Segments that are aligned together.
TOGETHER = 16_384
#: The character that stands for a space in pieces.
MARK = "▁"
#: White space before whose runs a text may be cut, if the vocabularies allow it.
CUTS = " \n\t"


class Aligner:
    """Two tokenizers, and where a text may be cut for both: a byte-level BPE file of the tokenizers library and a sentencepiece model."""

    def __init__(self, byte_level: str, pieces: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        with open(byte_level, encoding="utf-8") as file:
            spec = json.load(file)
        self.a, self.b = Tokenizer.from_file(byte_level), SentencePieceProcessor(model_file=pieces)
        self.a.encode_special_tokens = True
        kind = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or spec.get("truncation") or spec.get("padding") or (kind.get("type"), kind.get("use_regex"), kind.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError(f"{byte_level}: only byte-level tokenizers with the usual pieces can be cut before white space")
        if any(not x["special"] for x in spec.get("added_tokens", [])):
            raise ValueError(f"{byte_level}: added tokens that are no special ones might run across a cut")
        back = byte_characters()
        plain = {x["content"] for x in spec.get("added_tokens", [])}
        self.bytes_a = {i: x.encode() if x in plain else bytes(map(back.__getitem__, x)) for x, i in self.a.get_vocab().items()}
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace(MARK, " ").encode() for i, x in enumerate(names)]
        self.length_a, self.length_b = (np.array([len(x) for x in xs], np.int64) for xs in ([self.bytes_a[i] for i in range(max(self.bytes_a) + 1)], self.bytes_b))
        self.text_a, self.text_b = (np.array([[f"{i}{mark}" for i in range(len(xs))] for mark in (",", last)], object) for xs, last in ((self.length_a, "|"), (self.length_b, ";")))
        self._verify(pieces, names)
        self.space = self.b.piece_to_id(MARK)
        self.cuts = "".join(c for c in CUTS if self._safe(c, [x for i, x in enumerate(names) if not self.b.is_byte(i)]))
        # A segment is a run of white space and what follows up to the next run that begins with a character to cut before.
        self.segments = re.compile(rf"\s*+\S++(?:[^\S{self.cuts}]\s*+\S*+)*+|\s+").findall if self.cuts else lambda text: [text]

    def _verify(self, path: str, names: list[str]) -> None:
        """Texts reach the merges as they are, but for spaces; and every byte has a piece."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        how, of = model.normalizer_spec, model.trainer_spec
        ok = not how.precompiled_charsmap and not how.normalization_rule_tsv and how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces
        if not (ok and of.byte_fallback and not of.treat_whitespace_as_suffix and of.model_type == of.BPE and sum(map(self.b.is_byte, range(len(names)))) == 256):
            raise ValueError(f"{path}: only BPE models with byte fallback that leave texts as they are can be cut before white space")

    @staticmethod
    def _safe(c: str, names: list[str]) -> bool:
        """Whether no piece has ``c`` after a character that is no white space, nor (unless it is a space) after a space."""
        across = re.compile(rf"[^\s{MARK}]{MARK}") if c == " " else re.compile(rf"(?:[^\s]|{MARK}){re.escape(c)}")
        return not any(map(across.search, names))

    def tokens(self, segments: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of both tokenizers for each segment as it stands within a text."""
        first = [x.ids for x in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        # The second tokenizer puts a space before all that it gets: the segment's own one, or one to be dropped again.
        second = self.b.encode([x[1:] if x[0] == " " else x for x in segments], num_threads=1)
        for text, a, b in zip(segments, first, second, strict=True):
            if text[0] != " ":
                if b[0] != self.space:
                    raise ValueError(f"a piece runs across the cut before {text[:20]!r}")
                b = b[1:]
            yield a, b if text != " " else [self.space]

    def align(self, segments: list[str]) -> Aligned:
        import numpy as np

        made = [self._align(segments[at : at + TOGETHER]) for at in range(0, len(segments), TOGETHER)]
        return Aligned([g for x in made for g in x.groups], *(np.concatenate([getattr(x, f.name) for x in made]) for f in fields(Aligned)[1:]))

    def _align(self, segments: list[str]) -> Aligned:
        """Some segments at once, as stretches of one long text."""
        import numpy as np

        both = list(self.tokens(segments))
        sides = []
        for k, length in ((0, self.length_a), (1, self.length_b)):
            n = np.fromiter((len(x[k]) for x in both), np.int64, len(both))
            ids = np.fromiter(chain.from_iterable(x[k] for x in both), np.int64, int(n.sum()))
            sides.append((n, ids, np.cumsum(length[ids])))
        (n_a, a, ends_a), (n_b, b, ends_b) = sides
        told = np.cumsum(np.fromiter((len(x) if x.isascii() else len(x.encode()) for x in segments), np.int64, len(segments)))
        for n, _, ends in sides:
            if not (ends[np.cumsum(n) - 1] == told).all():
                raise ValueError("the tokens of a segment do not have its bytes")
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n_groups = np.diff(np.searchsorted(cuts, told, side="right"), prepend=0)
        # The tokens of B that overlap one of A: from the first that ends after its start to the first that ends at its end or later.
        first = np.searchsorted(ends_b, ends_a - self.length_a[a], side="right")
        n_links = np.searchsorted(ends_b, ends_a, side="left") - first + 1
        at = np.arange(n_links.sum()) - np.repeat(np.cumsum(n_links) - n_links, n_links) + np.repeat(first, n_links)
        links = np.repeat(a, n_links) << 32 | b[at]
        # Groups as text: every token with the mark that comes after it, those of A before those of B in each group.
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        written = np.concatenate([self.text_a[(ends_a == cuts[group_a]).astype(int), a], self.text_b[(ends_b == cuts[group_b]).astype(int), b]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        flat, ends = written[order].tolist(), np.cumsum(n_a + n_b).tolist()
        groups = ["".join(flat[s:e]) for s, e in zip([0, *ends], ends, strict=False)]
        return Aligned(groups, n_a, n_b, n_groups, np.add.reduceat(n_links, np.cumsum(n_a) - n_a), links)


@dataclass
class Aligned:
    """Of each segment: its groups as text, with ";" after each, and the numbers of tokens, groups and links; all links as packed id pairs."""

    groups: list[str]
    n_a: object
    n_b: object
    n_groups: object
    n_links: object
    links: object


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, pieces: str) -> Aligner:
    """The worker's pair of tokenizers, loaded once."""
    if (byte_level, pieces) not in _LOADED:
        _LOADED[byte_level, pieces] = Aligner(byte_level, pieces)
    return _LOADED[byte_level, pieces]


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class _Numbers(dict):
    """Numbers by first use."""

    def __missing__(self, key):
        self[key] = len(self)
        return len(self) - 1


def _pack(numbers) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(b"".join(split(numbers, "byte")))


def _unpack(data: bytes):
    import zstandard

    whole = zstandard.ZstdDecompressor().decompress(data)
    n = len(whole) // 4
    return joined([whole[k * n : (k + 1) * n] for k in range(4)], n, "byte")


#: What a bundle knows of its documents by itself, and what the counts of the corpus add.
OWN, COUNTED = ("n_a", "n_b", "n_groups", "n_links"), ("n_best", "count_sum")


def _bundle(number: int, keys, lengths: list[int], codes, segments: list[str], make: Aligner, whole: bool):
    """A row of ``bundles``."""
    import numpy as np
    import pyarrow as pa

    found = make.align(segments)
    groups, sizes = found.groups, found.n_links
    pairs, of = np.unique(found.links, return_inverse=True)
    counts = np.bincount(of, np.repeat(np.bincount(codes, minlength=len(segments)), sizes), len(pairs)).astype(np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    own = [np.add.reduceat(x[codes], starts) for x in (found.n_a, found.n_b, found.n_groups, sizes)]
    listed = codes.tolist()
    texts = ("".join(map(groups.__getitem__, listed[s:e]))[:-1] for s, e in zip(starts.tolist(), ends.tolist(), strict=True))
    texts = list(texts) if whole else [hashlib.sha256(x.encode()).hexdigest() for x in texts]
    lists = [(keys, None), *((x, pa.int64()) for x in own), (texts, pa.string()), (lengths, pa.int32()), (pairs, pa.int64()), (counts, pa.int64())]
    columns = [pa.array([number], pa.int64()), *(pa.array([_pack(x.astype(np.uint32))], pa.binary()) for x in (codes, sizes, of))]
    for values, kind in lists:
        values = values if kind is None else pa.array(values, kind)
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
    return pa.RecordBatch.from_arrays(columns, names=["bundle", "codes", "sizes", "of", "keys", *OWN, "groups", "lengths", "pairs", "counts"])


def bundles(docs: DataFrame, byte_level: str, pieces: str, whole: bool) -> DataFrame:
    """Documents (key, text) in bundles.  Of the documents: keys, OWN sums, groups (or digests of them), numbers of segments.

    ``codes`` are the segments of all documents as numbers of the distinct ones; these have ``sizes`` links each, which are
    numbers (``of``) of the bundle's distinct ``pairs``, with the ``counts`` of these.
    """
    kind = docs.schema["key"].dataType

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        make = aligner(byte_level, pieces)
        number = TaskContext.get().partitionId() << 32
        keys, lengths, codes, seen, chars = [], [], [], _Numbers(), 0

        def made():
            return _bundle(number, pa.concat_arrays(keys), lengths, np.concatenate(codes), list(seen), make, whole)

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                if chars and chars + len(text) > BUNDLE:
                    yield made()
                    number += 1
                    keys, lengths, codes, seen, chars = [], [], [], _Numbers(), 0
                parts = make.segments(" " + text)
                codes.append(np.fromiter(map(seen.__getitem__, parts), np.int64, len(parts)))
                lengths.append(len(parts))
                keys.append(batch.column(0).slice(i, 1))
                chars += len(text)
        if chars:
            yield made()

    schema = T.StructType([T.StructField("bundle", T.LongType())])
    for name in ("codes", "sizes", "of"):
        schema = schema.add(name, T.BinaryType())
    schema = schema.add("keys", T.ArrayType(kind))
    for name, of in (*((c, T.LongType()) for c in OWN), ("groups", T.StringType()), ("lengths", T.IntegerType()), ("pairs", T.LongType()), ("counts", T.LongType())):
        schema = schema.add(name, T.ArrayType(of))
    return docs.mapInArrow(run, schema)


def composed(rows: DataFrame, kind: T.DataType, name: str) -> DataFrame:
    """Documents of bundles that came back with the ``counted`` pairs (code, count, is_best)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(k)[r] for k, n in enumerate(batch.schema.names)}
                pairs = row["counted"].values
                place = pairs.field("code").to_numpy()
                weight = np.empty((2, len(place)), np.int64)
                weight[0, place], weight[1, place] = pairs.field("is_best").to_numpy(zero_copy_only=False), pairs.field("count").to_numpy()
                codes, sizes, of = (_unpack(row[c].as_py()).astype(np.int64) for c in ("codes", "sizes", "of"))
                lengths = row["lengths"].values.to_numpy()
                per_segment = np.add.reduceat(weight[:, of], np.cumsum(sizes) - sizes, axis=1)
                sums = np.add.reduceat(per_segment[:, codes], np.cumsum(lengths) - lengths, axis=1)
                yield pa.RecordBatch.from_arrays([row["keys"].values, *(row[c].values for c in OWN), *(pa.array(x) for x in sums), row["groups"].values], names=names)

    schema = T.StructType([T.StructField("key", kind), *[T.StructField(c, T.LongType()) for c in (*OWN, *COUNTED)], T.StructField(name, T.StringType())])
    names = schema.names
    return rows.mapInArrow(run, schema)


@dataclass
class Alignment:
    """A row per document, and a row (a, b, count, is_best) per pair of ids that are linked anywhere."""

    rows: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, byte_level: str, pieces: str, key: str = "doc_id", text: str = "text", whole: bool = False) -> Alignment:
    """The sums of OWN and COUNTED per document and a digest of its groups, or with ``whole`` the groups themselves."""
    each = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    sound = F.coalesce((F.col("text") != "") & ~F.contains("text", F.lit(MARK)), F.lit(False))
    bundled = stored(bundles(each.where(sound), byte_level, pieces, whole), "bundles")
    parts = bundled.select("bundle", F.posexplode(F.arrays_zip("pairs", "counts")).alias("code", "of")).select("bundle", "code", F.col("of.pairs").alias("pair"), "of.counts")
    counts = parts.groupBy("pair").agg(F.sum("counts").alias("count"))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    best = counts.groupBy(b.alias("of")).agg(F.max("count").alias("most"))
    pairs = stored(counts.join(best, b == F.col("of")).select("pair", "count", (F.col("count") == F.col("most")).alias("is_best")), "pairs")
    counted = parts.select("bundle", "code", "pair").join(pairs, "pair").groupBy("bundle").agg(F.collect_list(F.struct("code", "count", "is_best")).alias("counted"))
    rows = composed(bundled.drop("pairs", "counts").join(counted, "bundle"), each.schema["key"].dataType, "groups" if whole else "groups_sha256")
    none = each.where(~sound).select("key", *[F.lit(0).cast("long").alias(c) for c in (*OWN, *COUNTED)], F.lit("").alias(rows.columns[-1]))
    told = pairs.select(F.shiftright("pair", 32).cast("int").alias("a"), b.cast("int").alias("b"), "count", "is_best")
    return Alignment(rows.unionByName(none).withColumnRenamed("key", key), told)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), *vocabularies()).rows


QUERIES = {"op11_alignment": op11_alignment}
ORACLE_SQL: dict[str, str] = {}
