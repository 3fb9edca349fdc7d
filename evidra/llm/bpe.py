"""Byte-level BPE encoding and decoding that reproduces exact merges in linear time.

Bytes are read as Latin-1 characters, so one pyahocorasick automaton over the vocabulary finds every token at every
position of a piece.  The encoder takes the longest tokens, and steps back to shorter ones when two neighbours are not
what merging would leave side by side.  A sequence in which every adjacent pair is compatible *is* the merge result,
and compatibility depends on two tokens only, so it is memoised; a position from which nothing fits is marked once and
never tried again, which keeps the work linear.

The operators stream Arrow batches and hold two memos of bounded bytes per Python worker; a lost executor only repeats
its tasks.

Defined results: a null text encodes as an empty one; an empty text gives no ids; a text of any length is encoded whole,
in time linear in it; an id outside the vocabulary, or a null in an id list, is an error in ``decode``; null id lists
decode to empty bytes; repeated rows stay repeated; an empty table gives an empty result; input columns named like an
output are replaced, all others are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_column, replacing, table, unused

#: Bytes that a generation of a worker's memo of stretches, and of token pairs, may hold; each keeps two generations.
MEMO = 48 << 20
#: Longer stretches are encoded each time.
MEMO_CHARS = 128
#: What an entry of a memo takes besides its key and value.
ENTRY_BYTES = 80

#: Unicode white space.  No piece runs from another character into one of these, nor from a letter or digit into a mark of
#: ASCII, so a text falls into stretches (white space, then a word or the rest) that can be cut into pieces one by one, and
#: a stretch seen before need not be cut again.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ASCII_MARKS = r"!-/:-@\[-`{-~"
STRETCH = f"[{SPACE}]*+(?:[^\\W_]++(?:(?=[{ASCII_MARKS}])|[^{SPACE}]*+)|[^{SPACE}]++)|[{SPACE}]+"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in set(shown)]
    return {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(rest)}


class Memo(dict):
    """Values made on first use, up to so many bytes; of the generation before, those asked for again survive."""

    def __init__(self, make, size_of):
        self.make, self.size_of = make, size_of
        self.older: dict = {}
        self.held = 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        size = self.size_of(key, value)
        if size:
            if self.held + size > MEMO:
                self.older = self.copy()
                self.clear()
                self.held = 0
            self.held += size
            self[key] = value
        return value


class Codec:
    """Encoder and decoder for the ranks of one tiktoken file; ids are the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.stretches = re.compile(STRETCH).findall
        self.token = {i: b for b, i in ranks.items()}
        self.text = {i: str(i) for i in self.token}
        self.ids = max(self.token, default=0) + 1
        self.whole = {b.decode("latin-1"): i for b, i in ranks.items()}  # by the Latin-1 characters of the bytes
        self.length = [0] * self.ids
        self.halves = {i: self._halves(b, i) for b, i in ranks.items()}
        self.joined = {pair[0] * self.ids + pair[1]: i for i, pair in self.halves.items() if pair and pair[0] >= 0}
        self.byte = {chr(x): ranks.get(bytes([x]), -1) for x in range(256)}
        self.automaton = ahocorasick.Automaton()
        merging = set()
        for text, i in self.whole.items():
            self.length[i] = len(text)
            if self.halves[i]:  # a token that merging never arrives at can only be a whole piece
                merging.add(text)
                if len(text) > 1:
                    self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * self.ids  # the longest token that a token begins with
        for text in merging:
            self.shorter[self.whole[text]] = next((self.whole[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in merging), -1)
        self.pairs = Memo(self._adjacent, lambda key, value: ENTRY_BYTES + 32)
        self.known = Memo(self._stretch, lambda key, value: ENTRY_BYTES + 100 + len(key) + len(value) if len(key) <= MEMO_CHARS else 0)

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as file:
            ranks = {base64.b64decode(b): int(i) for b, i in map(bytes.split, filter(None, file))}
        return cls(ranks, pattern)

    def _halves(self, data: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token: a byte has none (-1, -1); None if merging never arrives at it."""
        if len(data) == 1:
            return -1, -1
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:  # merge the neighbours of lowest rank, leftmost first
            least, at = min((self.ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1))
            if least >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _adjacent(self, key: int) -> bool:
        """Whether merging leaves these two tokens, packed into one number, side by side.

        Undoes the later merge of the tokens at their border, again and again: they stay apart unless the two that then
        touch there would have merged before that.
        """
        left, right = divmod(key, self.ids)
        halves, joined, ids = self.halves, self.joined, self.ids
        until = ids  # ranks that the merges undone so far came before
        while True:
            if joined.get(left * ids + right, ids) < until:
                return False
            a, b = halves[left][1], halves[right][0]
            if a < 0 and b < 0:
                return True
            if b < 0 or (a >= 0 and left > right):
                left, until = a, left
            else:  # of equal ranks, the left one was merged first
                right, until = b, right + 1

    def _piece(self, piece: str) -> list[int]:
        data = piece if piece.isascii() else piece.encode().decode("latin-1")
        whole = self.whole.get(data)
        if whole is not None:
            return [whole]
        n, length, pairs, ids, shorter = len(data), self.length, self.pairs, self.ids, self.shorter
        longest = list(map(self.byte.__getitem__, data))
        for end, one in self.automaton.iter(data):  # longer tokens end later
            longest[end + 1 - length[one]] = one
        taken: list[int] = []
        dead: set[int] = set()
        at, last, one = 0, -1, longest[0]
        while True:
            if one < 0:
                if not taken:
                    raise ValueError(f"the vocabulary has no tokens for {piece[:40]!r}")
                dead.add(at)
                one = taken.pop()
                at -= length[one]
                last = taken[-1] if taken else -1
            elif (end := at + length[one]) not in dead and (last < 0 or pairs[last * ids + one]):
                taken.append(one)
                if end == n:
                    return taken
                at, last, one = end, one, longest[end]
                continue
            one = shorter[one]

    def _stretch(self, text: str) -> bytes:
        """The ids as four bytes each, which join to those of a text."""
        pieces = self.find(text)
        return array("i", self._piece(pieces[0]) if len(pieces) == 1 else chain.from_iterable(map(self._piece, pieces))).tobytes()

    def packed(self, text: str) -> bytes:
        """The ids of ``text`` as four bytes each."""
        return b"".join(map(self.known.__getitem__, self.stretches(text)))

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_LOADED: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a vocabulary file, loaded once."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec.load(path, pattern)
    return _LOADED[path, pattern]


def vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and piece pattern of a public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", checked: str | None = None) -> DataFrame:
    """``df`` with the token ids of each text; ``checked`` names a further column, whether they decode to the text."""

    def convert(values: list):
        import numpy as np
        import pyarrow as pa

        make = codec(path, pattern)
        found, good = [], []
        for v in values:
            ids = np.frombuffer(make.packed(v or ""), np.int32)
            found.append(ids)
            good.append(not checked or make.decode(ids.tolist()) == (v or "").encode())
        offsets = np.zeros(len(found) + 1, np.int32)
        np.cumsum([len(x) for x in found], out=offsets[1:])
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))
        if not checked:
            return lists
        return pa.StructArray.from_arrays([lists, pa.array(good, pa.bool_())], ["ids", "ok"])

    if not checked:
        return arrow_column(df, text, ids, "array<int>", convert)
    rest = replacing(df, ids, checked)
    (coded,) = unused(df, "coded")
    both = arrow_column(df, text, coded, "struct<ids:array<int>,ok:boolean>", convert)
    return both.select(*[F.col(f"`{c}`") for c in rest.columns], F.col(coded)["ids"].alias(ids), F.col(coded)["ok"].alias(checked))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """``df`` with the bytes that each id list stands for."""

    def convert(values: list):
        import pyarrow as pa

        make = codec(path, pattern)
        return pa.array([make.decode(v or ()) for v in values], pa.binary())

    return arrow_column(df, ids, data, "binary", convert)


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of tokens and digests of the ids and of the bytes that these ids decode to.

    Encoding, decoding and hashing happen in one pass, so no id list crosses a process or is kept.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        make = codec(path, pattern)
        for batch in batches:
            rows: list[list] = [[], [], []]
            for value in batch.column(1).to_pylist():
                ids = make.encode(value or "")
                rows[0].append(len(ids))
                rows[1].append(hashlib.sha256(",".join(map(make.text.__getitem__, ids)).encode()).hexdigest())
                rows[2].append(hashlib.sha256(make.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows, (pa.int64(), pa.string(), pa.string()))], names=[key, *names])

    kept = df.schema[key]
    schema = T.StructType([kept, T.StructField(names[0], T.LongType()), *[T.StructField(n, T.StringType()) for n in names[1:]]])
    return df.select(key, text).mapInArrow(run, schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), *vocabulary())


QUERIES = {"op4_bpe": op4_bpe}
ORACLE_SQL: dict[str, str] = {}
