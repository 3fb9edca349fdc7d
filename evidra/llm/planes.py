"""Token ids in binary files of bit or byte planes: ``write_tokens`` writes them, ``read_tokens`` reads them back.

Ids are cut into blocks of fixed size.  A block is transposed, so that the first bytes (or bits) of all its ids come
together, then the second ones and so on; each such plane is compressed by zstandard on its own, and a plane of zeros takes
no room.  A file ends with a chunk index (place, number of ids, plane sizes and checksum of every block) and a table of its
documents (key and number of ids), so a reader that wants some documents fetches the blocks that hold them and no others.

Documents are dealt to tasks by ranges of their key, sorted there and encoded and written as they stream by: texts cross
the network once, and go to the one Python worker that encodes and writes; ids never travel.  A task holds one block and the document table of one file.  The commit orders the files by
their first keys, adds up where each begins and publishes one manifest; files of lost or repeated tasks are in no manifest
and never read.  Reading takes a task per file, files being of bounded size.

Encoding keeps two memos of bounded bytes per worker, from words and from the stretches in them (letters, or the rest)
to their ids (``write_tokens`` keeps them from task to task, having one worker a task; ``encode`` empties them after a task, as its workers change roles with those of the next step), which join to those of the text because no piece of a byte-level tokenizer runs across; what they do not know
goes to the tokenizers library.  Texts that hold the string of an added token, and
all texts of another kind of tokenizer, go to the library whole.

Defined results: a null text is an empty one, and has the end id alone; a text of any length is encoded whole and may run
over many blocks; documents of equal keys are ordered by a hash of their text, and repeated rows are documents each; null
keys come first; an empty table gives a folder that reads as an empty table; other columns, whatever their names, are not
written; a folder is written once, unless it is overwritten; a block that does not have its checksum is an error.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from .bpe import ENTRY_BYTES, MEMO_CHARS, STRETCH, Memo, byte_characters
from .common import ROWS_AT_ONCE, arrow_column, shared_dir, table
from .storage import file_system, manifests, publish

MAGIC = b"IDPLANE1"
#: Ids in a block, and most ids and documents in a file (a longer document still is in one file).
BLOCK, FILE_IDS, FILE_DOCS = 1 << 16, 1 << 25, 1 << 19
LEVEL = 3
#: Ids in an Arrow batch that is read, about.
BATCH_IDS = 1 << 21
END_ID = 2
#: Letters before this one are letters in every version of Unicode.
LETTERS = "\u0250"


def _size(key: str, value: bytes) -> int:
    return 2 * ENTRY_BYTES + len(key) + len(value) if len(key) <= MEMO_CHARS else 0


class Encoder:
    """Ids of texts as the tokenizers library gives them without adding special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kind = spec.get("pre_tokenizer") or {}
        self.library = Tokenizer.from_file(path)
        self.merged = self.library.model.tokenize
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.cuts = not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding") and (kind.get("type"), kind.get("use_regex"), kind.get("add_prefix_space")) == ("ByteLevel", True, False)
        self.stretches = re.compile(STRETCH).findall
        self.words, self.parts = Memo(self._word, _size), Memo(self._part, _size)
        self.letters = "".join(sorted(byte_characters(), key=byte_characters().get))  # by byte, as a table that decodes

    def _whole(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, text: str) -> bytes:
        """Letters with at most a space before them are one piece, which goes to the merges at once."""
        core = text[1:] if text[:1] == " " else text
        return self._letters(text) if core.isalpha() and (core.isascii() or max(core) < LETTERS) else self._whole(text)

    def _letters(self, text: str) -> bytes:
        return array("I", [t.id for t in self.merged(charmap_decode(text.encode(), "strict", self.letters)[0])]).tobytes()

    def _text(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, self.stretches(text)))

    def _word(self, text: str) -> bytes:
        """The ids of a space and a word that begins with no white space."""
        if text.isalpha() and (text.isascii() or max(text) < LETTERS):  # one stretch, and known to be letters
            return self.parts[" " + text]
        if not text or text[0].isspace():
            raise KeyError(text)
        return self._text(" " + text)

    def release(self) -> None:
        """Empties the memos: a worker that waits or does other work holds the vocabulary alone."""
        for memo in (self.words, self.parts):
            memo.clear()
            memo.older, memo.held = {}, 0

    def packed(self, text: str) -> bytes:
        """The ids of ``text``, four bytes each."""
        if not self.cuts or any(a in text for a in self.added):
            return self._whole(text)
        words = text.split(" ")  # a space goes to the character after it, if that is no white space; so a text may be cut before it
        try:
            return self._text(words[0]) + b"".join(map(self.words.__getitem__, islice(words, 1, None)))
        except KeyError:
            return self._text(text)


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


#: Encoders of the workers that write; their memos stay.
_WRITING: dict[str, Encoder] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _lists(by: Encoder, values: list, end: int | None):
    """An Arrow array of the ids of each text, ``end`` after them."""
    import numpy as np
    import pyarrow as pa

    last = b"" if end is None else struct.pack("<I", end)
    made = [by.packed(v or "") + last for v in values]
    offsets = np.zeros(len(made) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in made], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", end: int | None = END_ID) -> DataFrame:
    """``df`` with the ids of each text, ``end`` after them, instead of the text."""
    return arrow_column(df, text, ids, "array<int>", lambda values: _lists(encoder(path), values, end), drop=True, done=lambda: encoder(path).release())


def split(ids, planes: str) -> list[bytes]:
    """The planes of some ids (unsigned 32-bit integers): 4 of bytes or 32 of bits, lowest first."""
    import numpy as np

    of_bytes = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [x.tobytes() for x in of_bytes.T]
    bits = np.unpackbits(of_bytes, axis=1, bitorder="little")
    return [x.tobytes() for x in np.packbits(bits.T, axis=1, bitorder="little")]


def joined(parts: list[bytes], n: int, planes: str):
    """The ids that ``split`` cut; an empty plane stands for zeros."""
    import numpy as np

    size = n if planes == "byte" else -(-n // 8)
    rows = np.stack([np.frombuffer(p, np.uint8) if p else np.zeros(size, np.uint8) for p in parts])
    if planes == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, count=n, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)


class _File:
    """A file being written: blocks as they fill, then the document table and the chunk index."""

    def __init__(self, system, folder: str, planes: str):
        import zstandard

        self.name, self.planes = f"ids-{uuid.uuid4().hex}.planes", planes
        self.squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
        self.out = system.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.out.write(MAGIC)
        self.at, self.blocks, self.ids = len(MAGIC), [], 0
        self.waiting, self.n_waiting = [], 0
        self.keys, self.counts = [], []

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def _block(self, ids) -> None:
        start, sizes = self.at, [self._put(self.squeeze(p)) if p.strip(b"\0") else 0 for p in split(ids, self.planes)]
        self.blocks.append([start, len(ids), zlib.crc32(ids.tobytes()), sizes])

    def add(self, keys: list, counts: list[int], ids) -> None:
        import numpy as np

        self.keys += keys
        self.counts += counts
        self.ids += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            held, full = np.concatenate(self.waiting), self.n_waiting // BLOCK * BLOCK
            for i in range(0, full, BLOCK):
                self._block(held[i : i + BLOCK])
            self.waiting, self.n_waiting = [held[full:].copy()], len(held) - full

    def close(self) -> dict:
        import numpy as np

        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        docs = [self.at]
        for values in ([k or 0 for k in self.keys], self.counts):
            docs.append(self._put(self.squeeze(np.array(values, "<i8").tobytes())))
        nulls = sum(k is None for k in self.keys)  # they come first
        index = self.squeeze(json.dumps({"planes": self.planes, "blocks": self.blocks, "docs": docs, "n_docs": len(self.keys), "n_null": nulls}).encode())
        self._put(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()
        return {"name": self.name, "bytes": self.at, "n_docs": len(self.keys), "n_ids": self.ids, "first": self.keys[0], "last": self.keys[-1]}


def _rank(key: int | None) -> tuple:
    return (key is not None, key or 0)


@dataclass
class Written(WriterCommitMessage):
    task: int
    files: list[dict]


class PlaneWriter(DataSourceArrowWriter):
    """Takes rows (key long, ids array<int>), or with a ``vocabulary`` (key long, text string), whose keys ascend within a task and from task to task."""

    def __init__(self, path: str, planes: str, overwrite: bool, vocabulary: str | None = None, end: int | None = None):
        if planes not in ("byte", "bit"):
            raise ValueError(f"planes are of bytes or bits, not {planes!r}")
        self.path, self.planes, self.overwrite = path, planes, overwrite
        self.vocabulary, self.end = vocabulary, end

    def _with_ids(self, batches: Iterator) -> Iterator:
        """Keys and lists of ids, a few texts at a time."""
        for batch in batches:
            if self.vocabulary is None:
                yield batch.column(0).to_pylist(), batch.column(1)
                continue
            if self.vocabulary not in _WRITING:
                _WRITING[self.vocabulary] = Encoder(self.vocabulary)
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield part.column(0).to_pylist(), _lists(_WRITING[self.vocabulary], part.column(1).to_pylist(), self.end)

    def write(self, batches: Iterator) -> Written:
        import numpy as np
        from pyspark import TaskContext

        system, folder = file_system(self.path)
        files, out = [], None
        for keys, lists in self._with_ids(batches):
            if lists.null_count:
                raise ValueError("a list of ids is null")
            ends = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False).view(np.uint32)
            at = 0
            while at < len(keys):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = _File(system, folder, self.planes)
                upto = int(np.searchsorted(ends, ends[at] + FILE_IDS - out.ids, side="right")) - 1
                upto = min(max(upto, at + 1), at + FILE_DOCS - len(out.keys), len(keys))
                out.add(keys[at:upto], np.diff(ends[at : upto + 1]).tolist(), ids[ends[at] : ends[upto]])
                at = upto
                if out.ids >= FILE_IDS or len(out.keys) >= FILE_DOCS or at < len(keys):
                    files.append(out.close())
                    out = None
        if out is not None:
            files.append(out.close())
        return Written(TaskContext.get().partitionId(), files)

    def commit(self, messages: list) -> None:
        system, folder = file_system(self.path)
        system.create_dir(folder, recursive=True)
        older = manifests(system, folder)
        if older and not self.overwrite:
            raise ValueError(f"{self.path} holds ids already")
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.task) for f in m.files]
        start = 0
        for before, f in zip([None, *files], files, strict=False):
            if before and _rank(before["last"]) > _rank(f["first"]):
                raise ValueError("keys do not ascend from task to task")
            f["start"] = start
            start += f["n_ids"]
        publish(system, folder, files, older)
        for f in (f for x in older.values() for f in x):
            system.delete_file(f"{folder}/{f['name']}")

    def abort(self, messages: list) -> None:
        system, folder = file_system(self.path)
        for f in (f for m in messages if m for f in m.files):
            system.delete_file(f"{folder}/{f['name']}")


@dataclass
class FilePart(InputPartition):
    file: dict


class PlaneReader(DataSourceReader):
    """Rows of whole documents; predicates on the key choose files by the manifest, and blocks by the chunk index."""

    def __init__(self, path: str, with_ids: bool):
        self.path, self.with_ids = path, with_ids
        self.least, self.most, self.among = None, None, None

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) != ("doc_id",) or not isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                yield f
                continue
            values = {v for v in f.value if v is not None} if isinstance(f, In) else {f.value}
            if isinstance(f, (EqualTo, In)):
                self.among = values if self.among is None else self.among & values
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                least = f.value + isinstance(f, GreaterThan)
                self.least = least if self.least is None else max(least, self.least)
            else:
                most = f.value - isinstance(f, LessThan)
                self.most = most if self.most is None else min(most, self.most)

    def _all(self) -> bool:
        return self.least is None and self.most is None and self.among is None

    def _may_hold(self, f: dict) -> bool:
        if self._all():
            return True
        if f["last"] is None:
            return False
        first, last = (float("-inf") if f["first"] is None else f["first"]), f["last"]
        return (self.least is None or last >= self.least) and (self.most is None or first <= self.most) and (self.among is None or any(first <= v <= last for v in self.among))

    def partitions(self):
        system, folder = file_system(self.path)
        found = [f for x in manifests(system, folder).values() for f in x if self._may_hold(f)]
        return [FilePart(f) for f in found] or [FilePart({})]

    def _wanted(self, keys, nulls: int):
        import numpy as np

        if self._all():
            return np.arange(len(keys))
        take = np.arange(len(keys)) >= nulls
        take &= True if self.least is None else keys >= self.least
        take &= True if self.most is None else keys <= self.most
        return np.flatnonzero(take & (True if self.among is None else np.isin(keys, list(self.among))))

    def read(self, part: FilePart):
        import numpy as np
        import pyarrow as pa

        if not part.file:
            return
        system, folder = file_system(self.path)
        with system.open_input_file(f"{folder}/{part.file['name']}") as file:
            keys, counts, nulls, fetch = _open(file, part.file["bytes"])
            starts = np.concatenate([[0], np.cumsum(counts)])
            wanted = self._wanted(keys, nulls)
            at = 0
            while at < len(wanted):
                upto = at + max(1, int(np.searchsorted(np.cumsum(counts[wanted[at : at + FILE_DOCS]]), BATCH_IDS, side="right")))
                some = wanted[at:upto]
                lists = [fetch(int(starts[i]), int(starts[i + 1])) for i in some]
                columns = [
                    pa.array(keys[some], pa.int64(), mask=some < nulls),
                    pa.array(part.file["start"] + starts[some], pa.int64()),
                    pa.array(counts[some], pa.int64()),
                    pa.array([zlib.crc32(x) for x in lists], pa.int64()),
                ]
                if self.with_ids:
                    offsets = np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists).view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])
                at = upto


def _open(file, size: int):
    """Keys and counts of a file's documents, how many keys are null, and a function that fetches a range of ids."""
    import numpy as np
    import zstandard

    inflate = zstandard.ZstdDecompressor().decompress
    tail = file.read_at(16, size - 16)
    if tail[8:] != MAGIC:
        raise ValueError("not a file of id planes, or cut off")
    n = struct.unpack("<Q", tail[:8])[0]
    index = json.loads(inflate(file.read_at(n, size - 16 - n)))
    at, one, two = index["docs"]
    keys = np.frombuffer(inflate(file.read_at(one, at)), "<i8")
    counts = np.frombuffer(inflate(file.read_at(two, at + one)), "<i8")
    ends = np.cumsum([0, *(b[1] for b in index["blocks"])])
    last: dict = {}

    def block(k: int):
        if k not in last:
            at, n, crc, sizes = index["blocks"][k]
            data, parts = file.read_at(sum(sizes), at), []
            for s in sizes:
                parts.append(inflate(data[:s]) if s else b"")
                data = data[s:]
            ids = joined(parts, n, index["planes"])
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError(f"block {k} does not have its checksum")
            last.clear()
            last[k] = ids
        return last[k]

    def fetch(start: int, end: int):
        first = int(np.searchsorted(ends, start, side="right")) - 1
        parts = []
        while start < end:
            upto = min(end, int(ends[first + 1]))
            parts.append(block(first)[start - ends[first] : upto - ends[first]])
            start, first = upto, first + 1
        return np.ascontiguousarray(np.concatenate(parts)) if parts else np.zeros(0, np.uint32)

    return keys, counts, index["n_null"], fetch


class PlaneSource(DataSource):
    """Options: path; for writing, planes ("byte" or "bit"), and vocabulary and end where texts are written instead of ids; ids ("true" or "false"), whether reading returns them."""

    @classmethod
    def name(cls) -> str:
        return "idplanes"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if self._with_ids() else "")

    def _with_ids(self) -> bool:
        return self.options.get("ids", "true") == "true"

    def reader(self, schema) -> PlaneReader:
        return PlaneReader(self.options["path"], self._with_ids())

    def writer(self, schema, overwrite: bool) -> PlaneWriter:
        end = self.options.get("end", "")
        return PlaneWriter(self.options["path"], self.options.get("planes", "byte"), overwrite, self.options.get("vocabulary"), int(end) if end else None)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PlaneSource)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", end: int | None = END_ID, planes: str = "byte", mode: str = "append") -> None:
    """The ids of all texts, in ascending order of ``key``; ``mode`` append needs an empty folder, overwrite replaces."""
    register(docs.sparkSession)
    rows = docs.select(F.col(key).cast(T.LongType()).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    dealt = rows.repartitionByRange("key", "hash").sortWithinPartitions("key", "hash", "text").drop("hash")
    dealt.write.format("idplanes").option("planes", planes).option("vocabulary", vocabulary).option("end", "" if end is None else str(end)).mode(mode).save(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if wanted, ids of every document."""
    register(spark)
    return spark.read.format("idplanes").option("ids", str(ids).lower()).load(path)


def op12_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/evidra-planes-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary())
    return read_tokens(spark, path, ids=False)


QUERIES = {"op12_planes": op12_planes}
ORACLE_SQL: dict[str, str] = {}
