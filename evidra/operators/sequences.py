"""Operators that walk a text from left to right: overlapping chunks, and speaker-marked transcripts.

Where each step depends on the one before, rows go through Arrow batches; a text stays in one row, so tasks hold a batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

#: Bytes and rows of texts that are walked at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 22, 1024

_ENDING = re.compile(r"[.!?]\s+")


def exploded(df: DataFrame, column: str, schema: str, walk: Callable[[str | None], list[dict]]) -> DataFrame:
    """``df`` without ``column``, a row for each dict that ``walk`` makes of it; texts are walked some at a time."""
    rest = [c for c in df.columns if c != column]
    added = T._parse_datatype_string(schema)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, min(at + SLICE_ROWS, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))))
                part = batch.slice(at, upto - at)
                made = [walk(v) for v in part.column(part.num_columns - 1).to_pylist()]
                index = pa.array([i for i, rows in enumerate(made) for _ in rows], pa.int64())
                flat = [row for rows in made for row in rows]
                kept = [c.take(index) for c in part.columns[:-1]]
                new = [pa.array([row[f.name] for row in flat], pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in added]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=[*rest, *added.names])
                at = upto

    return df.select(*rest, column).mapInArrow(run, T.StructType([df.schema[c] for c in rest] + added.fields))


def chunk_spans(text: str | None, size: int = 16_000, overlap: int = 1000, margin: int = 500, drop_contained_tail: bool = False) -> list[tuple[int, int]]:
    """Spans that end at the sentence boundary nearest the size, and begin ``overlap`` before the last end.

    A boundary is looked for on both sides, so a chunk may be longer than ``size`` by the margin.  After the end of the
    text one more chunk, contained in the one before, follows where that is longer than the overlap.
    A text of any length is covered: a chunk ends after it begins (``size`` is positive), so the walk always advances.
    """
    if not text or not text.strip():
        return []
    n = len(text)
    if n <= size:
        return [(0, n)]
    spans: list[tuple[int, int]] = []
    at = 0
    while at < n:
        goal = at + size
        if goal >= n:
            end = n
        else:
            low = max(0, goal - margin)
            ends = [low + m.end() for m in _ENDING.finditer(text[low : min(n, goal + margin)])]
            end = min((e for e in ends if e > at), key=lambda e: (abs(e - goal), e), default=goal)
        spans.append((at, end))
        at = end - overlap if end - overlap > at else end
    if drop_contained_tail and len(spans) > 1 and spans[-1][1] <= spans[-2][1]:
        spans.pop()
    return spans


def chunks(df: DataFrame, text: str = "text", size: int = 16_000, overlap: int = 1000, margin: int = 500, drop_contained_tail: bool = False, texts: bool = True) -> DataFrame:
    """chunk_no, chunk_text, clean_start, clean_end per chunk; without ``texts`` spans alone."""

    def walk(value: str | None) -> list[dict]:
        return [{"chunk_no": i, "chunk_text": value[a:b] if texts else None, "clean_start": a, "clean_end": b} for i, (a, b) in enumerate(chunk_spans(value, size, overlap, margin, drop_contained_tail))]

    return exploded(df, text, "chunk_no long, chunk_text string, clean_start long, clean_end long" if texts else "chunk_no long, clean_start long, clean_end long", walk)


def shared_with_next(chunked: DataFrame, key: str) -> DataFrame:
    """Text that each chunk shares with the next; empty where they are apart."""
    from pyspark.sql.window import Window

    order = Window.partitionBy(key).orderBy("chunk_no")
    both = chunked.select(key, "chunk_no", "chunk_text", "clean_start", "clean_end", F.lead("clean_start").over(order).alias("s"), F.lead("clean_end").over(order).alias("e")).where("s is not null")
    length = F.greatest(F.least("clean_end", "e") - F.col("s"), F.lit(0))
    return both.select(key, "chunk_no", F.substring("chunk_text", (F.col("s") - F.col("clean_start") + 1).cast("int"), length.cast("int")).alias("shared"))


#: The markers of the three transcript formats.
MARKERS = {
    "numbered": re.compile(r"^(\d+)\s+\(([^)]+)\):", re.MULTILINE),
    "named": re.compile(r"^([A-Za-z][A-Za-z0-9\s]*?):\s*\n\s*\[([^\]]+)\]", re.MULTILINE),
    "lettered": re.compile(r"^Speaker\s+([A-Z])\s+\(([^)]+)\):", re.MULTILINE),
}
HEADER_VENDOR = "AssemblyAI"


def without_header(text: str) -> str:
    """From the first line that starts with "Speaker"; else, under a vendor header, from the fifth line."""
    lines = text.split("\n")
    first = next((i for i, line in enumerate(lines) if line.strip().startswith("Speaker")), None)
    if first is None:
        first = 4 if HEADER_VENDOR in lines[0] and len(lines) > 4 else 0
    return "\n".join(lines[first:])


def segment_rows(text: str | None, kind: str) -> list[dict]:
    """Segments between markers: number, speaker, stamp, stripped text and its raw span."""
    if not text or not text.strip():
        return []
    if kind == "lettered":
        text = without_header(text)
    found = list(MARKERS[kind].finditer(text))
    if not found:
        return [{"seg_no": 0, "speaker": "Speaker_Unknown", "stamp": "", "clean_text": text.strip(), "raw_start": 0, "raw_end": len(text)}]
    ends = [m.start() for m in found[1:]] + [len(text)]
    who = {"numbered": "Speaker_{}", "named": "{}", "lettered": "Speaker_{}"}[kind]
    return [{"seg_no": i, "speaker": who.format(m[1].strip()), "stamp": m[2], "clean_text": text[m.end() : e].strip(), "raw_start": m.end(), "raw_end": e} for i, (m, e) in enumerate(zip(found, ends, strict=True))]


def parsed(df: DataFrame, kind: str = "numbered", text: str = "text") -> DataFrame:
    """A row per segment with its time in seconds."""
    if kind not in MARKERS:
        raise ValueError(f"unknown transcript format {kind!r}; known: {', '.join(MARKERS)}")
    rows = exploded(df, text, "seg_no long, speaker string, stamp string, clean_text string, raw_start long, raw_end long", lambda v: segment_rows(v, kind))
    seconds = {"numbered": X.seconds_short, "named": X.seconds_clock, "lettered": X.seconds_long}[kind](F.col("stamp"))
    return rows.withColumn("seconds", seconds).drop("stamp")


def full_text(segments: DataFrame, key: str) -> DataFrame:
    """Segments of each text joined by blank lines."""
    ordered = F.sort_array(F.collect_list(F.struct("seg_no", "clean_text")))
    return segments.groupBy(key).agg(F.array_join(F.transform(ordered, lambda s: s["clean_text"]), "\n\n").alias("full_text"))


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Stripped text of [start, end); empty for an invalid range."""
    valid = (start >= 0) & (end > start) & (end <= F.length(text))
    return F.when(valid, X.trimmed(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))).otherwise("")


def chosen_transcript(first: Column, second: Column, third: Column) -> tuple[Column, Column]:
    """The first of three transcripts that is neither null nor empty, and its format."""
    a, b, c = (F.nullif(x, F.lit("")) for x in (first, second, third))
    return F.coalesce(a, b, c), F.when(a.isNotNull(), "numbered").when(b.isNotNull(), "named").when(c.isNotNull(), "lettered")
