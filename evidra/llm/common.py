"""What the operators of this subpackage share: table access, shared storage, small Column helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words are runs of anything but these characters.
SPACE_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only where the session names none and runs on one machine, as in local tests, one is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="evidra-")
        spark.conf.set("spark.checkpoint.dir", named)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; for narrow rows that are read whole."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Compute once into a columnar table in the shared folder, so that each reader takes only the columns it needs."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/evidra-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that a Python worker holds as objects.
ROWS_AT_ONCE = 256

#: Bytes of rows that go to a Python worker at once; a longer row goes alone.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold ``BATCH_BYTES`` (or one row), unless it has a setting of its own.

    Every task holds its batches at both ends of the pipe and outside the heap; of Spark's 64 MB, an executor has no room for several.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, f"{BATCH_BYTES}b")


#: Rows of a small table (a few hundred bytes each) that may go to every task.
BROADCAST_ROWS = 20_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` computed, and marked for broadcast if it has at most ``most`` rows; else it joins by shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` names it.

    A plain alias is not enough: the optimizer may inline it into a lambda, which then computes it for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def replacing(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator is about to add: its outputs win over input columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def guarded(operator):
    """An operator that may use columns beginning with two underscores, though its input has such columns too.

    These bear other names meanwhile, and their own again in the result.
    """

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **named):
        own = [c for c in df.columns if c.startswith("__")]
        if not own:
            return operator(df, *args, **named)
        away = dict(zip(own, unused(df, *[f"in{c}" for c in own]), strict=True))
        moved = [away.get(x, x) if isinstance(x, str) else x for x in args]
        out = operator(df.withColumnsRenamed(away), *moved, **{k: away.get(x, x) if isinstance(x, str) else x for k, x in named.items()})
        return out.withColumnsRenamed({v: k for k, v in away.items()})

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept away from training: crc32 of the id as text, modulo 4, is 2.  A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def arrow_column(df: DataFrame, column: str, name: str, kind: str, convert, drop: bool = False, done: Callable[[], None] | None = None) -> DataFrame:
    """``df`` with one more column, ``convert`` of a list of values giving an Arrow array; small batches stream through.

    ``drop`` leaves out the column read, which then does not travel back; one that stays travels once.
    ``done`` is called when a task has converted its rows.
    """
    import pyarrow as pa

    small_batches(df.sparkSession)
    base = replacing(df, name).drop(*[column] * drop)
    width = len(base.columns)
    at = base.columns.index(column) if column in base.columns else width
    sent = df.select(*[F.col(f"`{c}`") for c in base.columns], *[F.col(f"`{column}`").alias(unused(base, "in")[0])] * (at == width))

    def add(batches: Iterator) -> Iterator:
        for batch in batches:
            for first in range(0, max(batch.num_rows, 1), ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                made = convert(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:width], made], names=[*part.schema.names[:width], name])
        if done is not None:
            done()

    return sent.mapInArrow(add, T.StructType([*base.schema.fields, T.StructField(name, T._parse_datatype_string(kind))]))
