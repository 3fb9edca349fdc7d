"""SimHash's wider setting: near-duplicates by the similarity of word shingles, where no fingerprint radius prunes.

``simhash.deduplicated`` comes here when it is asked for a similarity.  The method is the same: a SimHash fingerprint per
text (of its distinct five-word shingles), the fingerprints in their shards, a BK-tree searched in each (``simhash.links``).
What the trees link is confirmed by the exact shingle sets.  But two texts at a Jaccard similarity of 0.8 differ in about ten
of 64 bits, where shards of equal bits would hold most of the corpus.  For what lies beyond the trees' radius, the buckets of
MinHash bands give further candidates, confirmed alike.  A pair at 0.8 agrees in a band of four minima with
probability 0.8**4, and in none of the 32 bands with less than 5e-8.  Texts that the trees tied are not compared again across their buckets.

No bucket is gathered and no bucket's pairs are listed.  Texts with equal shingle sets are merged first.  Each bucket has a
pivot, the member that meets most others over all bands, and every member is compared with its pivots: linear in the
members.  Of two members that are both similar to p, no more need be known.  If x is not, a similar y must either share
with x a shingle that p lacks, or have all that it shares with x inside p.  The first pairs meet on such shingles, on as few
of each text as the threshold allows, the rarest ones; the second are told by sizes alone, and need x to be mostly contained in p.  Copies of
one text differ from it in shingles of their own, so both are few however many the copies are.

Defined results: words are cut and lowered as in ``simhash``; a text of fewer words than a shingle is one shingle, a null
or wordless text the empty set, which equals the empty set; a text of any length counts whole; ties go to the smallest key,
null keys last, repeated rows keep one; an empty table gives an empty result; all columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import simhash
from .common import ROWS_AT_ONCE, cut, small_batches, stored
from .components import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SEED = 42
#: Bands of so many minima each.
BANDS, BAND_ROWS = 32, 4
#: Shingles whose minima are taken at once.
SHINGLES_AT_ONCE = 1 << 9
#: Word hashes that a Python worker remembers.
WORDS_KEPT = 1 << 17
#: Classes of shingles whose frequency is counted, and how often the mean a common class comes (besides so many).
CLASSES, COMMON, BESIDES = 1 << 17, 2, 64
#: Bits of a filter on texts for each of those wanted, and at most; in rows of 64, which bounds what is broadcast.
FILTER_SHARE, FILTER_BITS = 16, 1 << 26


def _mixed(x):
    """A bijection of 64-bit integers whose output bits depend on all input bits."""
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, known: dict[bytes, int], size: int = SHINGLE_WORDS):
    """Sorted distinct 64-bit hashes of the word shingles of ``text``; ``known`` remembers word hashes."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > WORDS_KEPT:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = xxh64_intdigest(w, SEED)
    each = np.array([known[w] for w in words], np.uint64)
    n = max(1, len(each) - size + 1)
    out = np.full(n, min(len(each), size), np.uint64)
    for i in range(min(len(each), size)):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + n])
    return np.unique(out)


def band_keys(shingles):
    """A 64-bit key per band of the minima of ``shingles``; none for the empty set."""
    import numpy as np

    if not len(shingles):
        return np.zeros(0, np.int64)
    salts = _mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    least = np.full(len(salts), np.iinfo(np.uint64).max, np.uint64)
    odd = salts | np.uint64(1)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        x = (shingles[at : at + SHINGLES_AT_ONCE] ^ salts[:, None]) * odd[:, None]
        x ^= x >> np.uint64(32)
        x *= odd[::-1, None]
        np.minimum(least, x.min(axis=1), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, BAND_ROWS).T:
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def set_fingerprint(shingles) -> int:
    """SimHash of a shingle set: the bits that are 1 in over half of its hashes, as a signed integer; 0 for the empty set."""
    import numpy as np

    votes = np.zeros(64, np.int64)
    for at in range(0, len(shingles), simhash.COUNT_AT_ONCE):
        part = shingles[at : at + simhash.COUNT_AT_ONCE].astype("<u8", copy=False)
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(shingles), bitorder="little").view("<i8")[0])


def with_sets(df: DataFrame, text: str, kind: str, within: str | None = None) -> DataFrame:
    """``df`` with, of its text, ``set_id``, ``fp`` (its SimHash) and ``bands``, or ``shingles`` themselves, as ``kind`` says.

    ``text`` is a column, which is left out, or a field of the struct ``within``, which stays and travels once.
    """
    small_batches(df.sparkSession)
    base = [c for c in df.columns if within or c != text]
    added = "set_id long, fp long, bands array<long>" if kind == "bands" else "shingles array<long>"

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from xxhash import xxh64_intdigest

        known: dict[bytes, int] = {}
        lists = lambda xs: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, xs)]), pa.int32()), pa.array(np.concatenate([*xs, np.zeros(0, np.int64)]).astype(np.int64)))
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = pc.struct_field(part.column(base.index(within)), text) if within else part.column(part.num_columns - 1)
                sets = [shingle_set(v, known) for v in texts.to_pylist()]
                if kind == "bands":
                    made = [pa.array(np.array([xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)), pa.array([set_fingerprint(s) for s in sets], pa.int64()), lists([band_keys(s) for s in sets])]
                else:
                    made = [lists([s.view(np.int64) for s in sets])]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(base)], *made], names=[*base, *(["set_id", "fp", "bands"] if kind == "bands" else ["shingles"])])

    schema = T.StructType([*df.select(*[F.col(f"`{c}`") for c in base]).schema.fields, *T._parse_datatype_string(added).fields])
    return df.select(*[F.col(f"`{c}`") for c in base], *([] if within else [F.col(f"`{text}`")])).mapInArrow(run, schema)


def _bit(x: str, bits: int) -> tuple[Column, Column]:
    """Row and bit of ``x`` in a filter of so many bits."""
    at = F.pmod(F.xxhash64(x), F.lit(bits))
    return (at / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({x}), 64) as int))")


def _maybe(whole: DataFrame, wanted: DataFrame, by: str) -> tuple[DataFrame, Column]:
    """``whole`` with the column ``bits`` of a filter on ``wanted``, and whether a row may be wanted; no wanted row is missed.

    The filter grows with what is wanted, up to its bound; beyond that it lets more rows pass, and the joins after it decide as ever.
    """
    word, bit = _bit(by, min(FILTER_BITS, max(64, FILTER_SHARE * wanted.count())))
    bits = wanted.groupBy(word).agg(F.bit_or(bit).alias("bits"))
    return whole.withColumn("word", word).join(F.broadcast(bits), "word", "left"), F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))


def _sets_of(wanted: DataFrame, whole: DataFrame) -> DataFrame:
    """(set_id, shingles) of the ``wanted`` set_id; texts that a filter rules out do not move."""
    marked, likely = _maybe(whole, wanted, "set_id")
    likely = marked.where(likely).select("set_id", "__row", "text")
    one = likely.select("set_id", "__row").groupBy("set_id").agg(F.min("__row").alias("__row")).join(wanted, "set_id", "left_semi")
    return stored(with_sets(likely.join(one.select("__row"), "__row", "left_semi").select("set_id", "text"), "text", "sets"), "sets")


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with both shingle sets ``sx``, ``sy`` and the size ``shared`` of their intersection."""
    x, y = (sets.select(F.col("set_id").alias(c), F.col("shingles").alias(f"s{c}")) for c in "xy")
    return pairs.join(x, "x").join(y, "y").withColumn("shared", F.size(F.array_intersect("sx", "sy")))


def _similar(shared: Column, x: Column | str, y: Column | str, similarity: float) -> Column:
    """Whether sets of sizes ``x`` and ``y`` with ``shared`` elements in common have that Jaccard similarity."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    return shared * (1 + similarity) >= similarity * (x + y) - 1e-9


def _stars(whole: DataFrame) -> DataFrame:
    """(x, y): each member x of a bucket with the bucket's pivot y, which meets most others over all bands."""
    each = whole.groupBy("set_id").agg(F.first("bands").alias("bands")).select("set_id", F.explode("bands").alias("band"))
    sizes = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(each.join(sizes, "band"), "members")
    ranked = members.join(members.groupBy("set_id").agg(F.sum("n").alias("met")), "set_id")
    pivots = ranked.groupBy("band").agg(F.max_by("set_id", F.struct("met", -F.col("set_id"))).alias("y"))
    return stored(members.select("band", F.col("set_id").alias("x")).join(stored(pivots, "pivots"), "band").where("x <> y").select("x", "y").distinct(), "stars")


def _close(whole: DataFrame) -> DataFrame:
    """(x, y) pairs of set_id that the BK-trees of SimHash's shards link, or that have one fingerprint; a star or less per group."""
    prints = stored(whole.select("set_id", "fp").distinct(), "prints")
    named = prints.groupBy("fp").agg(F.min("set_id").alias("named"))
    same = prints.join(named, "fp").where("set_id <> named").select(F.col("set_id").alias("x"), F.col("named").alias("y"))
    u, v = (named.select(F.col("fp").alias(a), F.col("named").alias(b)) for a, b in ("ux", "vy"))
    linked = simhash.links(prints.select("fp").distinct()).distinct()
    return stored(same.unionAll(linked.join(u, "u").join(v, "v").select("x", "y")), "close")


def _rare_first(shingles: Column, sets: DataFrame) -> Column:
    """``shingles`` in an order that is the same for all texts, with those of common classes last.

    Texts that share a frequent passage then do not meet on it.  The order decides what is compared, never what is found.
    """
    kind = lambda x: F.pmod(x, F.lit(CLASSES))
    loads = cut(sets.select(F.explode("shingles").alias("x")).groupBy(kind(F.col("x")).cast("int").alias("kind")).agg(F.count("*").alias("n")))
    total = loads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = [r.kind for r in loads.where(F.col("n") > COMMON * total / CLASSES + BESIDES).select("kind").collect()]  # at most CLASSES / COMMON
    if not common:
        return shingles
    return F.concat(F.filter(shingles, lambda x: ~kind(x).isin(common)), F.filter(shingles, lambda x: kind(x).isin(common)))


def links(whole: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v) links between set_id that span every group; ``whole`` has set_id, fp, bands, text and a unique __row."""
    stars = _stars(whole).withColumn("star", F.lit(True)).unionAll(_close(whole).withColumn("star", F.lit(False)))
    stars = stored(stars.groupBy("x", "y").agg(F.max("star").alias("star")), "compared")
    sets = _sets_of(cut(stars.select(F.explode(F.array("x", "y")).alias("set_id")).distinct()), whole)
    # a similar partner shares at least similarity * nx shingles with x; so many of those that y lacks need not be looked at
    own = _rare_first(F.array_except("sx", "sy"), sets)
    spared = F.greatest(F.ceil(similarity * F.col("nx") - F.col("shared") - 1e-9), F.lit(1)).cast("int")
    told = _compared(stars, sets).select("x", "y", "star", "shared", F.size("sx").alias("nx"), F.size("sy").alias("ny"), own.alias("own"))
    seen = stored(told.select("x", "y", "star", "shared", "nx", _similar(F.col("shared"), "nx", "ny", similarity).alias("near"), F.slice("own", F.lit(1), F.greatest(F.size("own") - spared + 1, F.lit(0))).alias("own")), "compared")
    near = seen.where("near").select(F.col("x").alias("u"), F.col("y").alias("v"))
    tied = stored(components(near).select(F.col("node").alias("x"), "root"), "tied")
    placed = stored(seen.where("star").drop("star").join(tied, "x", "left").withColumn("root", F.coalesce("root", "x")), "placed")
    alone = placed.where("not near")

    apart = "root <> o_root and o_nx <= nx / {0} and nx <= o_nx / {0}".format(similarity)
    meeting = placed.select("y", "x", "shared", "nx", "root", "near", F.posexplode("own").alias("at", "shingle"))
    other = placed.select("y", *[F.col(c).alias(f"o_{c}") for c in ("x", "shared", "nx", "root")])
    other_meeting = meeting.select("y", "shingle", *[F.col(c).alias(f"o_{c}") for c in ("x", "shared", "nx", "root", "at")])
    within_y = F.least("shared", "o_shared")
    still = F.least(F.col("nx") - F.col("shared") - F.col("at"), F.col("o_nx") - F.col("o_shared") - F.col("o_at"))  # what can be common from here on
    outside = meeting.where("not near").join(other_meeting, ["y", "shingle"]).where(apart).where(_similar(within_y + still, "nx", "o_nx", similarity))
    inside = alone.where(F.col("shared") >= similarity * F.col("nx") - 1e-9).join(other, "y").where(apart).where(_similar(within_y, "nx", "o_nx", similarity))
    pairs = outside.select("x", "o_x").unionAll(inside.select("x", "o_x")).select(F.greatest("x", "o_x").alias("x"), F.least("x", "o_x").alias("y")).distinct()
    late = _compared(stored(pairs, "pairs"), sets).where(_similar(F.col("shared"), F.size("sx"), F.size("sy"), similarity))
    return near.unionAll(late.select(F.col("x").alias("u"), F.col("y").alias("v")))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of ``docs`` per group of near-duplicates: that of the smallest key; same columns."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("__row"))
    whole = stored(with_sets(marked, text, "bands", "doc"), "near")
    lookup = whole.select("set_id", "fp", "bands", "__row", F.col("doc")[text].alias("text"))
    rows = whole.select(F.col("doc")[key].alias("key"), "set_id", "__row")
    tied = stored(components(links(lookup, similarity)).select(F.col("node").alias("set_id"), "root"), "groups")
    root = stored(rows.join(tied, "set_id", "left").select(F.coalesce("root", "set_id").alias("root"), "key", "__row"), "roots")
    first = root.groupBy("root").agg(F.min(F.struct(F.col("key").isNull(), "key", "__row")).alias("first"))
    lost = stored(root.select("__row").join(first.select("first.__row"), "__row", "left_anti"), "lost")
    # texts travel only if a filter says that they may be among the lost ones
    marked, doubtful = _maybe(whole.select("doc", "__row"), lost, "__row")
    kept = marked.where(~doubtful).select("doc").unionAll(marked.where(doubtful).select("doc", "__row").join(lost, "__row", "left_anti").select("doc"))
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
