"""Personal data: anchors found by one Aho-Corasick pass, boundaries expanded and validated by local parsers.

One automaton holds all anchors: at-signs, plus signs, digits, address schemes and identifier cues.  Each hit hands its
position to a deterministic parser that looks only around it, or remembers the stretch that it walked, so the cost is
linear in the text.  Email, ip, card and
phone spans equal those of a left-to-right scan with their patterns; urls, accounts and secrets are added.

Rows are independent: batches stream through and a lost executor only repeats its tasks.

Defined results: a null or empty text has no spans (and stays as it is when redacted); a text of any length is read
whole; offsets are code points, end exclusive; overlapping spans of different kinds are all listed, ties by the order of
the kinds, and redacted as one; repeated rows are treated alike; an empty table gives an empty result; an input column
named like an output is replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_column, replacing, small_batches, table, unused

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}

SCHEMES = ("http://", "https://", "ftp://", "www.")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "api-key", "access_key", "bearer")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`{}|\\^]+")
_HOST = re.compile(r"[^/?#:]*")
_IBAN = re.compile(r"[\s:#=.\"'-]{0,6}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_NUMBER = re.compile(r"(?:\x20?(?:number|no|nr))?[\s:#=.\"']{0,6}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])", re.IGNORECASE)
_SECRET = re.compile(r"[\"']?(?:\s{0,3}[:=]\s{0,3}|\x20)[\"']?([A-Za-z0-9_\-./+=]{12})")
_VALUE = re.compile(r"[A-Za-z0-9_\-./+=]+")
_DIGIT = re.compile("[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN (shortened until its check digits hold) or a number right after a cue."""
    if found := _IBAN.match(text, at):
        start, end = found.span(1)
        while end - start >= 15:
            if _mod97(text[start:end]):
                return start, end
            end -= 1
            while text[end - 1] == " ":
                end -= 1
    if found := _NUMBER.match(text, at):
        return found.span(1)
    return None


class _Runs:
    """The stretch of characters of one class that a position lies in, and where it ends without trailing marks.

    Each stretch is walked once, however many cues ask for it from left to right.
    """

    def __init__(self, text: str, pattern: re.Pattern, trailing: str):
        self.text, self.pattern, self.trailing = text, pattern, trailing
        self.begin = self.end = self.stop = self.digit = -1

    def at(self, start: int) -> int | None:
        """Where the stretch ends without trailing marks; None if none starts here."""
        if not self.begin <= start < self.end:
            found = self.pattern.match(self.text, start)
            if not found:
                return None
            self.begin, self.end = found.span()
            self.stop = self.end
            while self.stop > start and self.text[self.stop - 1] in self.trailing:
                self.stop -= 1
        return max(self.stop, start)

    def has_digit(self, start: int, stop: int) -> bool:
        """Whether [start, stop) of the stretch last asked for has a digit."""
        if self.digit < start:
            found = _DIGIT.search(self.text, start, self.end)
            self.digit = found.start() if found else self.end
        return self.digit < stop


_AUTOMATON = None


def _anchors():
    """The worker's automaton; its values name the parser to call."""
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        made = ahocorasick.Automaton()
        for word, kind in [("@", "@"), ("+", "+"), *[(d, "0") for d in "0123456789"], *[(s, "url") for s in SCHEMES]]:
            made.add_word(word, (kind, len(word)))
        for cues, kind in ((ACCOUNT_CUES, "account"), (SECRET_CUES, "secret")):
            for cue in cues:
                for word in {cue, cue.upper(), cue.capitalize()}:
                    made.add_word(word, (kind, len(word)))
        made.make_automaton()
        _AUTOMATON = made
    return _AUTOMATON


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of everything found, by start, then kind as listed."""
    found: list[tuple[int, str, int]] = []
    until = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    ip_end = card_end = 0
    digit = -2
    urls, values = _Runs(text, _URL, ".,;:!?)]"), _Runs(text, _VALUE, ".")
    for end, (kind, size) in _anchors().iter(text):
        if kind == "0":
            if end != digit + 1 and end >= ip_end and (m := _IP.match(text, end)):  # only the first digit of a run can start one
                ip_end = m.end()
                if all(map(_byte, m.groups())):
                    found.append((end, "ip", ip_end))
            digit = end
            if end >= card_end and (m := _CARD.match(text, end)):
                card_end = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((end, "card", card_end))
        elif kind == "@":
            start = end
            while start > until["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < end and (m := _DOMAIN.match(text, end + 1)):
                until["email"] = m.end()
                found.append((start, "email", m.end()))
        elif kind == "+":
            if end >= until["phone"] and (m := _PHONE.match(text, end)):
                until["phone"] = m.end()
                if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                    found.append((end, "phone", m.end()))
        elif kind == "url":
            start = end + 1 - size
            if start >= until["url"] and (stop := urls.at(end + 1)) is not None:
                host = _HOST.match(text, end + 1, stop)[0]
                if "." in host.strip(".") or host == "localhost":
                    until["url"] = stop
                    found.append((start, "url", stop))
        elif kind == "account":
            if end >= until["account"] and (span := _account(text, end + 1)):
                until["account"] = span[1]
                found.append((span[0], "account", span[1]))
        elif end >= until["secret"] and (m := _SECRET.match(text, end + 1)):
            stop = values.at(m.start(1))
            if stop - m.start(1) >= 12 and values.has_digit(m.start(1), stop):
                until["secret"] = stop
                found.append((m.start(1), "secret", stop))
    found.sort(key=lambda x: (x[0], ORDER[x[1]]))
    return found


def redacted(text: str) -> str:
    """``text`` with each stretch of touching spans replaced by the name of its longest kind."""
    parts: list[str] = []
    done = 0
    group: list[tuple[int, str, int]] = []

    def close() -> None:
        nonlocal done
        if group:
            longest = max(group, key=lambda x: x[2] - x[0])
            parts.extend((text[done : group[0][0]], f"<{longest[1].upper()}>"))
            done = max(x[2] for x in group)
            group.clear()

    reach = -1
    for span in find_spans(text):
        if span[0] >= reach:
            close()
        group.append(span)
        reach = max(reach, span[2])
    close()
    return "".join((*parts, text[done:]))


def with_spans(df: DataFrame, text: str = "text", spans: str = "pii_spans") -> DataFrame:
    """``df`` with an array of (kind, start, end) per row."""

    def convert(values: list):
        import pyarrow as pa

        rows = [[{"kind": k, "start": s, "end": e} for s, k, e in find_spans(v)] if v else [] for v in values]
        return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

    return arrow_column(df, text, spans, "array<struct<kind:string,start:bigint,end:bigint>>", convert)


def redact(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``df``, same columns in the same order, with personal data in ``text`` replaced and ``n_chars`` counted anew."""

    def convert(values: list):
        import pyarrow as pa

        return pa.array([redacted(v) if v else v for v in values], pa.string())

    (made,) = unused(df, "redacted")
    changed = arrow_column(df, text, made, "string", convert, drop=True)
    clean = {text: F.col(made)}
    if n_chars and n_chars in df.columns:
        clean[n_chars] = F.length(made).cast(df.schema[n_chars].dataType)
    return changed.select(*[clean.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def digests(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the counts of the base kinds, a digest of their spans, and all spans as a string."""
    counts = [f"n_{k}" for k in BASE]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            tallies: list[list[int]] = [[] for _ in BASE]
            base, every = [], []
            for value in batch.column(1).to_pylist():
                spans = find_spans(value) if value else []
                for kind, tally in zip(BASE, tallies, strict=True):
                    tally.append(sum(x[1] == kind for x in spans))
                told = [(k, f"{k}:{s}:{e}") for s, k, e in spans]
                base.append(hashlib.sha256(",".join(x for k, x in told if k in BASE).encode()).hexdigest())
                every.append(",".join(x for _, x in told))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(t, pa.int64()) for t in tallies], pa.array(base, pa.string()), pa.array(every, pa.string())], names=[key, *counts, "base_sha256", "spans"])

    small_batches(df.sparkSession)
    fields = [*[T.StructField(c, T.LongType()) for c in counts], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    return replacing(df.select(key, text), *counts, "base_sha256", "spans").mapInArrow(run, T.StructType([df.schema[key], *fields]))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op7_pii": op7_pii}
ORACLE_SQL: dict[str, str] = {}
