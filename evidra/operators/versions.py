"""Tables with numbered versions: whole or not at all, one writer after the other, and back again.

Below the folder of a store, ``log`` holds a small JSON file per version, which lists for each table its base (folders or files of
Parquet) and the updates after it.  A version is made by one atomic step, the file with the next number, which only one
of several writers can put there; the others get a ``Conflict`` and may try again on what is then the newest version.
Numbers decide what is newest, never clocks.  What a writer left that failed, or lost, is listed nowhere and never read.

Updates by key do not rewrite a table: they are written as rows of the key and the new values, and laid over the base when it
is read, later ones over earlier ones.  ``compact`` folds them in, and rewrites only the files that hold an updated key.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Another writer made the next version first."""


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path class for a folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _log(path: str, number: int) -> str:
    return f"{path}/log/{number:020d}.json"


def newest(spark: SparkSession, path: str) -> int:
    """The number of the newest version; 0 if there is none."""
    fs, at = _files(spark, path)
    if not fs.exists(at(f"{path}/log")):
        return 0
    names = [f.getPath().getName() for f in fs.listStatus(at(f"{path}/log"))]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def tables(spark: SparkSession, path: str, version: int | None = None) -> dict[str, dict]:
    """What a version (the newest, if none is named) lists per table: ``base`` and ``updates``, paths below the store."""
    number = newest(spark, path) if version is None else version
    if number == 0:
        return {}
    told = spark.read.text(_log(path, number), wholetext=True).first()
    return json.loads(told[0])["tables"]


def _claim(spark: SparkSession, path: str, number: int, content: str) -> None:
    """Puts the file of a version there whole, unless it is there already."""
    fs, at = _files(spark, path)
    fs.mkdirs(at(f"{path}/log"))
    draft, final = at(f"{path}/log/draft-{uuid.uuid4().hex}"), at(_log(path, number))
    out = fs.create(draft, False)
    out.write(content.encode())
    out.close()
    try:
        if fs.getScheme() == "file":  # a local rename would replace what is there; a link is refused
            os.link(draft.toUri().getPath(), final.toUri().getPath())
        elif not fs.rename(draft, final):
            raise FileExistsError
    except FileExistsError:
        raise Conflict(f"version {number} of {path} was made by another writer") from None
    finally:
        fs.delete(draft, False)


def commit(spark: SparkSession, path: str, changed: dict[str, dict], after: int) -> int:
    """The version after ``after``, with the entries of ``changed`` instead of those of the same tables (None drops one)."""
    new = {**(tables(spark, path, after) if after else {}), **changed}
    told = {"after": after, "tables": {k: v for k, v in new.items() if v is not None}}
    _claim(spark, path, after + 1, json.dumps(told))
    return after + 1


def _written(df: DataFrame, path: str, name: str, folders: list[str] | None = None) -> str:
    place = f"data/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*folders) if folders else df.write).parquet(f"{path}/{place}")
    return place


#: Rows of a table, or a function that makes them of the tables written before it in the same version.
Rows = DataFrame | Callable[[dict[str, DataFrame]], DataFrame]


def _each_written(spark: SparkSession, new: dict[str, Rows], path: str, folders: dict[str, list[str] | None]):
    """The name, place and rows of each table, written one after the other."""
    made: dict[str, DataFrame] = {}
    for name, rows in new.items():
        df = rows(made) if callable(rows) else rows
        place = _written(df, path, name, folders.get(name))
        made[name] = spark.read.schema(df.schema).parquet(f"{path}/{place}")
        yield name, place, df


def write(new: dict[str, Rows], path: str, after: int | None = None, folders: dict[str, list[str]] | None = None) -> int:
    """All tables as one new version; tables that are not named stay as they are.  ``folders``: columns that a table is partitioned by.

    ``after`` is the version that the caller has seen, by default the newest as this begins: a version that another
    writer made meanwhile is a ``Conflict``.  If a table fails to be written, there is no new version.
    """
    spark = next(iter(new.values())).sparkSession
    seen = newest(spark, path) if after is None else after
    by = folders or {}
    return commit(spark, path, {k: {"base": [place], "updates": [], "schema": df.schema.json(), "folders": by.get(k)} for k, place, df in _each_written(spark, new, path, by)}, seen)


def append(rows: dict[str, Rows], path: str, after: int | None = None) -> int:
    """Rows beside those of tables, whose files stay, as one version.  Updates made before must not touch new rows, so they are folded in first."""
    spark = next(iter(rows.values())).sparkSession
    seen = newest(spark, path) if after is None else after
    for name in rows:
        if tables(spark, path, seen)[name]["updates"]:
            seen = compact(spark, path, name, seen)
    now = tables(spark, path, seen)
    return commit(spark, path, {k: now[k] | {"base": [*now[k]["base"], place]} for k, place, _ in _each_written(spark, rows, path, {k: now[k].get("folders") for k in rows})}, seen)


def rollback(spark: SparkSession, path: str, version: int, after: int | None = None) -> int:
    """A new version with the tables of an old one."""
    seen = newest(spark, path) if after is None else after
    if not 0 < version <= seen:
        raise LookupError(f"{path} has no version {version}")
    _claim(spark, path, seen + 1, json.dumps({"after": seen, "tables": tables(spark, path, version)}))
    return seen + 1


def transact(spark: SparkSession, path: str, change: Callable[[int], int], tries: int = 5) -> int:
    """``change(version)``, which makes the version after it; tried again on the newest one where others came first."""
    for left in reversed(range(tries)):
        try:
            return change(newest(spark, path))
        except Conflict:
            if not left:
                raise
    raise ValueError("tries must be positive")


def _base(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    from functools import reduce

    from pyspark.sql.types import StructType

    reader = spark.read.schema(StructType.fromJson(json.loads(entry["schema"])))
    places = [p if p.startswith("file:") or "://" in p else f"{path}/{p}" for p in entry["base"]]
    if entry.get("folders"):  # the folders of each write begin at its own root
        return reduce(DataFrame.unionByName, [reader.parquet(p) for p in places])
    return reader.parquet(*places)


def _overlay(spark: SparkSession, path: str, entry: dict) -> DataFrame | None:
    """(key, its new values as a struct per updated column): of several updates of a key's column, the last."""
    each = None
    for k, u in enumerate(entry["updates"]):
        rows = spark.read.parquet(f"{path}/{u['path']}")
        made = rows.select(F.col(u["key"]).alias("__key"), *[F.struct(F.lit(k).alias("n"), F.col(c).alias("value")).alias(f"__new_{c}") for c in u["columns"]])
        each = made if each is None else each.unionByName(made, allowMissingColumns=True)
    if each is None:
        return None
    names = [c for c in each.columns if c != "__key"]
    return each.groupBy("__key").agg(*[F.max_by(c, f"{c}.n").alias(c) for c in names])


def _laid(base: DataFrame, over: DataFrame | None, key: str | None) -> DataFrame:
    if over is None:
        return base
    changed = {c.removeprefix("__new_") for c in over.columns if c != "__key"}
    joined = base.join(over, F.col(key) == F.col("__key"), "left")
    return joined.select(*[F.when(F.col(f"__new_{c}").isNotNull(), F.col(f"__new_{c}.value")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in base.columns])


def _key(entry: dict) -> str | None:
    return entry["updates"][0]["key"] if entry["updates"] else None


def read(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """A table as of a version, by default the newest: its base with all updates."""
    entry = tables(spark, path, version).get(name)
    if entry is None:
        raise LookupError(f"{path} has no table {name}")
    return _laid(_base(spark, path, entry), _overlay(spark, path, entry), _key(entry))


def update(changes: DataFrame, path: str, name: str, key: str, after: int | None = None) -> int:
    """New values by key: all columns of ``changes`` but ``key`` replace those of the rows that have it.

    No file of the table is touched.  Of several rows of one key, the largest counts (by the columns in their order); null
    keys, and keys that the table lacks, change nothing.
    """
    spark = changes.sparkSession
    seen = newest(spark, path) if after is None else after
    entry = tables(spark, path, seen)[name]
    if entry["updates"] and _key(entry) != key:
        seen = compact(spark, path, name, seen)
        entry = tables(spark, path, seen)[name]
    columns = [c for c in changes.columns if c != key]
    last = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*columns)).alias("__last")).select(key, *[F.col(f"__last.{c}").alias(c) for c in columns])
    made = {"path": _written(last, path, f"{name}-update"), "key": key, "columns": columns}
    return commit(spark, path, {name: entry | {"updates": [*entry["updates"], made]}}, seen)


def lacking(changes: DataFrame, path: str, name: str, key: str) -> DataFrame:
    """Keys of ``changes`` that the table has no row for, each once."""
    from .store import missing

    return missing(changes.where(F.col(key).isNotNull()), read(changes.sparkSession, path, name), key)


def compact(spark: SparkSession, path: str, name: str, after: int | None = None) -> int:
    """A version without updates: files that hold an updated key are written anew with them, all others stay.

    The names of a table's files pass through the driver, as in the log; its rows do not.
    """
    seen = newest(spark, path) if after is None else after
    entry = tables(spark, path, seen)[name]
    over = _overlay(spark, path, entry)
    if over is None:
        return seen
    if entry.get("folders"):
        return commit(spark, path, {name: entry | {"base": [_written(read(spark, path, name, seen), path, name, entry["folders"])], "updates": []}}, seen)
    base = _base(spark, path, entry)
    key = _key(entry)
    placed = base.select(F.col(key).alias("__at"), F.col("_metadata.file_path").alias("__file"))
    every = {r[0] for r in base.select("_metadata.file_path").distinct().collect()}
    touched = {r[0] for r in placed.join(over.select("__key"), F.col("__at") == F.col("__key"), "left_semi").select("__file").distinct().collect()}
    stay = sorted(every - touched)
    new = []
    if touched:
        some = _base(spark, path, entry | {"base": sorted(touched)})
        new = [_written(_laid(some, over, key), path, name, entry.get("folders"))]
    return commit(spark, path, {name: entry | {"base": [*stay, *new] or entry["base"], "updates": []}}, seen)


def history(spark: SparkSession, path: str) -> DataFrame:
    """(version, after, tables) of all versions."""
    rows = spark.read.text(f"{path}/log/*.json", wholetext=True)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.json", 1).cast("long")
    names = F.json_object_keys(F.get_json_object("value", "$.tables"))
    return rows.select(number.alias("version"), F.get_json_object("value", "$.after").cast("long").alias("after"), F.array_sort(names).alias("tables"))
