"""SimHash near-duplicates: 64-bit fingerprints, linked at two or fewer differing bits by BK-tree search in shards.

Equal fingerprints are merged first, so copies cost one row each.  A shard is a set of distinct fingerprints that agree
on five of seven bit blocks: two fingerprints within two bits always share one of the 21 shards of each, and at most 19
bits are left to vary in a shard, which bounds it at 2**19 members however skewed the data.  In a shard all members
search a BK-tree (children keyed by integer Hamming distance to their parent) and follow only edges within the radius.
The search is batched: a node is compared with all searches that reach it.  A shard returns a spanning star of each of
its groups, never all pairs.

The trees stay in the tasks that own the shards: sent to every task, as trees of all fingerprints they would grow with
the corpus and have no size bound.

Defined results: a null or wordless text has fingerprint zero and links like any other; a text of any length counts whole;
a null id gets a component but never names one (null where no member has an id); repeated rows are members each; ties go to
the smallest id; an empty table gives an empty result; columns of any name are kept by ``deduplicated`` and ignored by
``near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import near
from .common import arrow_column, guarded, stored, table
from .components import components

RADIUS = 2
SHINGLE_WORDS = 3
SEED = 42
#: Seven blocks; five of them agree within the radius.
BLOCK_BITS = (10, 9, 9, 9, 9, 9, 9)
#: Shingles whose bits are counted at once.
COUNT_AT_ONCE = 1 << 15


def fingerprint(text: str) -> int:
    """Majority bits of the XXH64 hashes of all word shingles, repeats included; 0 without a word."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    starts = list(accumulate(map(len, words), lambda at, size: at + size + 1, initial=0))
    if len(words) < SHINGLE_WORDS:
        return xxh64_intdigest(joined, SEED)
    hashes = [xxh64_intdigest(joined[s : e - 1], SEED) for s, e in zip(starts, starts[SHINGLE_WORDS:], strict=False)]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_AT_ONCE):
        part = np.array(hashes[at : at + COUNT_AT_ONCE], "<u8")
        votes += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint", drop: bool = False) -> DataFrame:
    """``df`` with the fingerprint of each text as a bigint."""

    def convert(values: list):
        import numpy as np
        import pyarrow as pa

        return pa.array(np.array([fingerprint(v) if v else 0 for v in values], np.uint64).view(np.int64))

    return arrow_column(df, text, name, "bigint", convert, drop)


def shard_masks() -> list[int]:
    """Bit masks of the shards, as signed 64-bit integers."""
    ends = list(accumulate(BLOCK_BITS, initial=0))
    blocks = [((1 << b) - 1) << a for a, b in zip(ends, BLOCK_BITS, strict=False)]
    masks = [sum(chosen) for chosen in combinations(blocks, len(blocks) - RADIUS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def tree_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning links (child, root) of the groups of distinct ``values`` within ``radius`` bits, found in a BK-tree."""
    if len(values) == 2:
        return [(values[1], values[0])] if ((values[0] ^ values[1]) & (1 << 64) - 1).bit_count() <= radius else []
    import numpy as np

    bits = np.array(values, np.int64).view(np.uint64)
    parent = list(range(len(values)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    everyone = np.arange(len(values))
    open_nodes = [(everyone, everyone)]  # members of a subtree, its node first, with the searches that reach it
    while open_nodes:
        members, searches = open_nodes.pop()
        node = bits[members[0]]
        apart = np.bitwise_count(bits[searches] ^ node).astype(np.int16)
        here = root(int(members[0]))
        for i in searches[apart <= radius].tolist():
            parent[root(i)] = here
        below = members[1:]
        if len(below):
            edges = np.bitwise_count(bits[below] ^ node).astype(np.int16)
            for edge in np.unique(edges):
                reach = searches[np.abs(apart - edge) <= radius]
                if len(reach):
                    open_nodes.append((below[edges == edge], reach))
    return [(values[i], values[r]) for i in range(len(values)) if (r := root(i)) != i]


def links(distinct: DataFrame) -> DataFrame:
    """(u, v) links that span every group of the distinct ``fp``; each pair within the radius is in one group."""
    spark = distinct.sparkSession
    # fingerprints are so small that adaptive execution would put very many into a task, which then makes 21 rows of each
    spread = distinct.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism))
    shards = spread.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in shard_masks()])).alias("mask", "shard"))
    full = shards.groupBy("mask", "shard").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [pair for fps in batch.column(0).to_pylist() for pair in tree_links(fps)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return full.mapInArrow(search, "u long, v long")


def grouped(rows: DataFrame, key: str) -> DataFrame:
    """(fp, root, component_id) for each distinct ``fp`` of ``rows``; component_id is the group's smallest ``key``."""
    least = rows.groupBy("fp").agg(F.min(key).alias("least"))
    tied = components(links(rows.select("fp").distinct())).withColumnRenamed("node", "fp")
    members = tied.join(least, "fp")
    named = members.join(members.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")
    return least.join(named, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))


def hex_fingerprint(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, fingerprint (16 hex digits) and component_id."""
    rows = stored(with_fingerprint(docs.select(key, text), text, "fp", drop=True), "simhash")
    # stored, the groups bring no partitioning to the join, so that it can split a fingerprint with very many rows
    return rows.join(stored(grouped(rows, key), "groups"), "fp").select(key, hex_fingerprint("fp").alias("fingerprint"), "component_id")


@guarded
def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float | None = None) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates: that of the smallest key; same columns.

    By default texts group within ``RADIUS`` bits of their fingerprints of three words; with a ``similarity``, by that
    Jaccard similarity of their five-word shingles (see ``near``).
    """
    if similarity is not None:
        return near.deduplicated(docs, key, text, similarity)
    whole = stored(with_fingerprint(docs, text, "__fp").withColumn("__row", F.monotonically_increasing_id()), "simhash")
    rows = whole.select(F.col(f"`{key}`").alias("key"), F.col("__fp").alias("fp"), "__row")
    one = stored(rows.groupBy("fp").agg(F.min(F.struct(F.col("key").isNull(), "key", "__row")).alias("first")), "least")  # before the join, so that a frequent fingerprint is one row
    first = one.join(stored(grouped(rows, "key").select("fp", "root"), "groups"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    return whole.join(first.select("first.__row"), "__row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op5_simhash": op5_simhash}
ORACLE_SQL: dict[str, str] = {}
