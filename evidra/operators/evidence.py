"""Quotes as evidence: span overlap, order-dependent folding, remapping, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as X


def overlapping(spans: DataFrame, group: str, key: str, start: str = "start_pos", end: str = "end_pos", least: float = 0.5) -> DataFrame:
    """(left_id, right_id, overlap) of spans in a group that share at least ``least`` of the shorter.

    Spans fall into classes by the power of two of their length; a class has bins of twice its length, so a span lies in at
    most two of its own bins and in at most two of any larger class.  The shorter of two spans meets the longer in the bins
    of the longer one's class; a pair counts in the bin in which the later of them starts, so none is doubled.
    """
    made = spans.select(F.col(group).alias("g"), F.col(key).alias("id"), F.col(start).alias("s"), F.col(end).alias("e")).where("e > s").withColumn("c", F.length(F.bin(F.col("e") - F.col("s"))))
    # so many classes are there that the shorter may look into: one number per group, at most 64
    tops = made.groupBy("g").agg(F.max("c").alias("top"))

    def binned(df: DataFrame, kind: str) -> DataFrame:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(kind))
        return df.withColumn("w", width).withColumn("bin", F.explode(F.sequence(F.floor(F.col("s") / F.col("w")), F.floor((F.col("e") - 1) / F.col("w")))))

    longer = binned(made.withColumn("k", F.col("c")), "k")
    shorter = binned(made.join(tops, "g").withColumn("k", F.explode(F.sequence(F.col("c"), F.col("top")))), "k")
    a, b = shorter.alias("a"), longer.alias("b")
    first = (F.col("a.c") < F.col("b.c")) | (F.col("a.id") < F.col("b.id"))
    both = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.bin") == F.col("b.bin")) & first & (F.col("a.s") < F.col("b.e")) & (F.col("b.s") < F.col("a.e")))
    once = both.where((F.col("a.id") != F.col("b.id")) & (F.col("a.bin") == F.floor(F.greatest("a.s", "b.s") / F.col("a.w"))))
    share = X.span_overlap(F.col("a.s"), F.col("a.e"), F.col("b.s"), F.col("b.e"))
    return once.select(F.least("a.id", "b.id").alias("left_id"), F.greatest("a.id", "b.id").alias("right_id"), share.alias("overlap")).where(F.col("overlap") >= least)


QUOTE = {"quote_id": "long", "start_pos": "long", "end_pos": "long", "text": "string", "score": "double", "speaker": "string", "ts": "long"}
#: Quotes are the same if they share this much of the shorter, or this much of their words within so many characters.
OVERLAP, SIMILAR, NEAR = 0.5, 0.8, 20


def fold_quotes(rows: list[dict], overlap: float = OVERLAP, similar: float = SIMILAR, near: int = NEAR, carried: tuple[str, ...] = ()) -> list[dict]:
    """Keeps quotes from left to right: each joins the first kept one that is the same, which grows, or is kept itself.

    The longer text, the higher score and both ends' reach are kept, the speaker and time of the first, and of ``carried`` columns those of the
    quote with the higher score.  The result has ``merged``, the ids it absorbed, and comes by falling score.  Only kept quotes that
    reach beyond a quote's start, or begin less than ``near`` before it, are looked at.  Rows may bring their ``bag`` of words.
    """
    import re

    def bag(text: str | None) -> frozenset:
        return frozenset(re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", (text or "").lower())).split())

    kept: list[dict] = []
    open_to: list[int] = []  # kept ones that later quotes may still join, in order
    for row in sorted(rows, key=lambda r: (r["start_pos"], r["quote_id"])):
        row = dict(row, merged=[row["quote_id"]], bag=frozenset(row["bag"]) if "bag" in row else bag(row["text"]), text=row["text"] or "")
        at, mine = row["start_pos"], row["bag"]
        open_to = [i for i in open_to if kept[i]["end_pos"] > at or kept[i]["start_pos"] + near > at]
        for i in open_to:
            k = kept[i]
            shorter = min(k["end_pos"] - k["start_pos"], row["end_pos"] - at)
            shared = max(0, min(k["end_pos"], row["end_pos"]) - max(k["start_pos"], at))
            alike = at - k["start_pos"] < near and k["bag"] and mine and len(k["bag"] & mine) / len(k["bag"] | mine) >= similar
            if (shorter > 0 and shared / shorter >= overlap) or alike:
                longer = k if len(k["text"]) >= len(row["text"]) else row
                better = k if k["score"] >= row["score"] else row
                k.update(text=longer["text"], bag=longer["bag"], score=better["score"], merged=k["merged"] + row["merged"], end_pos=max(k["end_pos"], row["end_pos"]), **{c: better[c] for c in carried})
                break
        else:
            open_to.append(len(kept))
            kept.append(row)
    kept.sort(key=lambda r: (-r["score"], r["start_pos"], r["quote_id"]))
    return kept


def same_quotes(quotes: DataFrame, group: str, key: str, overlap: float = OVERLAP, similar: float = SIMILAR, near: int = NEAR) -> DataFrame:
    """(left_id, right_id) of quotes of a group that are the same: they overlap enough, or begin less than ``near`` apart with alike words."""
    close = quotes.select(F.col(group).alias("g"), F.col(key).alias("id"), F.col("start_pos").alias("s"), X.token_set(F.col("text")).alias("bag")).where(F.size("bag") > 0)
    place = F.floor(F.col("s") / near)
    a = close.withColumn("bin", F.explode(F.array(place - 1, place, place + 1))).alias("a")
    b = close.withColumn("bin", place).alias("b")
    met = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.bin") == F.col("b.bin")) & (F.col("a.id") < F.col("b.id")) & (F.abs(F.col("a.s") - F.col("b.s")) < near))
    alike = met.where(X.jaccard(F.col("a.bag"), F.col("b.bag")) >= similar).select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))
    return overlapping(quotes, group, key, least=overlap).select("left_id", "right_id").unionByName(alike).distinct()


#: Quotes of an episode that are folded in one task; larger episodes are cut into islands.
FOLDED_AT_ONCE = 20_000
#: Quotes of small episodes that one call folds, about.
TOGETHER = 4096
#: Characters of an episode in which islands are told apart by one task.
STRETCH = 1 << 16


def islands(quotes: DataFrame, group: str, near: int = NEAR) -> DataFrame:
    """``quotes`` with ``island``: quotes of different islands of a group never meet while the group is folded.

    A kept quote reaches as far as the farthest of those that it absorbed, and is alike to none that begins ``near`` or more
    after it.  So an island ends where no quote before reaches, by its end or by ``near``.
    """
    rows = quotes.withColumn("__reach", F.greatest("end_pos", F.col("start_pos") + near)).withColumn("__at", F.floor(F.col("start_pos") / STRETCH))
    # The farthest reach so far, by stretches (a row each) and then within each; likewise the last quote that began an island.
    in_turn = Window.partitionBy(group).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    in_order = Window.partitionBy(group, "__at").orderBy("start_pos", "quote_id")
    before, upto = in_order.rowsBetween(Window.unboundedPreceding, -1), in_order.rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(group).eqNullSafe(F.col("__bg")) & (F.col("__at") == F.col("__bat"))

    def carried(df: DataFrame, value: Column, window_of, name: str) -> DataFrame:
        sums = df.groupBy(group, "__at").agg(value.alias("__sum"))
        return df.join(sums.select(F.col(group).alias("__bg"), F.col("__at").alias("__bat"), window_of("__sum").over(in_turn).alias(name)), same).drop("__bg", "__bat")

    reached = carried(rows, F.max("__reach"), F.max, "__reached")
    reached = reached.withColumn("__reached", F.greatest("__reached", F.max("__reach").over(before)))
    begins = F.col("__reached").isNull() | (F.col("__reached") <= F.col("start_pos"))
    started = reached.withColumn("__own", F.when(begins, F.struct("start_pos", "quote_id")))
    opened = carried(started, F.max("__own"), lambda c: F.last(c, True), "__open")
    island = F.coalesce(F.last("__own", True).over(upto), F.col("__open"))
    return opened.withColumn("island", island).select(*quotes.columns, "island")


def folded(quotes: DataFrame, group: str, overlap: float = OVERLAP, similar: float = SIMILAR, near: int = NEAR, carried: tuple[str, ...] = ()) -> DataFrame:
    """``fold_quotes`` per group; a group is the quotes of one episode.  Large groups fold island by island, with the same result."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from .similarity import checkpoint_folder

    shape = T.StructType([T.StructField(group, T.LongType()), *[T.StructField(c, T._parse_datatype_string(k)) for c, k in QUOTE.items()], *[quotes.schema[c] for c in carried], T.StructField("merged", T.ArrayType(T.LongType()))])
    names = [c for c in shape.names if c != "merged"]

    def run(table):
        parts: dict = {}
        for r in table.select([*names, "bag", "island"]).to_pylist():
            parts.setdefault((r[group], tuple((r.pop("island") or {}).values())), []).append(r)
        out = [{k: v for k, v in r.items() if k != "bag"} for rows in parts.values() for r in fold_quotes(rows, overlap, similar, near, carried)]
        return pa.Table.from_pylist(out, to_arrow_schema(shape))

    checkpoint_folder(quotes.sparkSession)
    rows = quotes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in shape if f.name != "merged"], X.token_set(F.coalesce("text", F.lit(""))).alias("bag")).checkpoint()
    sizes = rows.groupBy(group).agg(F.count("*").alias("__n")).checkpoint()
    large = sizes.where(F.col("__n") > FOLDED_AT_ONCE).select(F.col(group).alias("__large"))
    whole = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    none = F.lit(None).cast("struct<start_pos:bigint,quote_id:bigint>").alias("island")
    if large.isEmpty():
        cut = rows.select("*", none)
    else:
        is_large = F.col(group).eqNullSafe(F.col("__large"))
        cut = rows.join(large, is_large, "left_anti").select("*", none).unionByName(islands(rows.join(large, is_large, "left_semi"), group, near))
    # Many small groups, or islands, to a task's call.
    return cut.groupBy(F.pmod(F.xxhash64(group, "island"), F.lit(max(1, -(-whole // TOGETHER)))).alias("__bucket")).applyInArrow(run, shape)


def remapped(links: DataFrame, originals: DataFrame, kept: DataFrame, group: str, mode: str = "lineage") -> DataFrame:
    """Claim links on folded quotes: by ``lineage`` each original follows what absorbed it; ``exact`` needs equal spans."""
    if mode == "lineage":
        target = kept.select(F.explode("merged").alias("quote_id"), F.col("quote_id").alias("kept_id"))
        return links.join(target, "quote_id").select("claim_id", "kept_id").distinct()
    spans = kept.select(group, "start_pos", "end_pos", F.col("quote_id").alias("kept_id"))
    return links.join(originals.select(group, "quote_id", "start_pos", "end_pos"), "quote_id").join(spans, [group, "start_pos", "end_pos"]).select("claim_id", "kept_id").distinct()


def confidence(score: Column) -> dict[str, Column]:
    """Aggregates per claim: 0.65 mean + 0.25 best + 0.10 of how many there are, up to five."""
    n = F.count(score)
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (n - 1) / F.lit(4.0)))
    mean, best = F.coalesce(F.avg(score), F.lit(0.0)), F.coalesce(F.max(score), F.lit(0.0))
    total = F.when(n == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.65 * mean + 0.25 * best + 0.10 * share)))
    return {"avg_relevance": mean, "max_relevance": best, "quote_count": n, "count_score": F.when(n == 0, F.lit(0.0)).otherwise(share), "final_confidence": total}


def offsets(turns: DataFrame, group: str, order: str, text: str, gap: int = 2) -> DataFrame:
    """``start_pos`` and ``end_pos`` of each turn in the turns of its group joined by ``gap`` characters."""
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length(F.coalesce(text, F.lit("")))
    start = F.coalesce(F.sum(size + gap).over(before), F.lit(0)).cast("long")
    return turns.withColumn("start_pos", start).withColumn("end_pos", (start + size).cast("long"))


def merged_groups(members: DataFrame, group: str, key: str, text: str, confidence: str, chunk: str) -> DataFrame:
    """One row per group: the member of highest confidence, then longest text, then smallest key, and all chunk ids."""
    best = F.struct(F.col(confidence), F.length(text), -F.col(key))
    return members.groupBy(group).agg(F.max_by(key, best).alias("representative"), F.max_by(text, best).alias("text"), F.sort_array(F.collect_set(chunk)).alias("chunks"), F.count("*").alias("n_members"))


def merged_claims(claims: DataFrame, links: DataFrame, quotes: DataFrame, group: str) -> tuple[DataFrame, DataFrame]:
    """Claims of a ``group`` as one, and their quotes united.

    ``claims``: claim_id, ``group`` (a number), claim, confidence, chunk_id; ``links``: claim_id, quote_id; ``quotes``: as for
    ``folded``.  Gives a row per group (the best claim, by confidence, then length, then smallest id; its chunk and all
    chunks; how many claims, quotes before and after), and the folded quotes of each group.
    """
    united = links.join(claims.select("claim_id", group), "claim_id").join(quotes.drop(group), "quote_id")
    kept = folded(united.select(group, *[c for c in quotes.columns if c != group]), group)
    best = F.struct("confidence", F.length("claim").alias("n"), -F.col("claim_id"))
    whole = claims.groupBy(F.col(group).cast("long").alias(group)).agg(F.max_by("claim_id", best).alias("claim_id"), F.max_by("claim", best).alias("claim"), F.max("confidence").alias("confidence"), F.max_by("chunk_id", best).alias("chunk_id"), F.sort_array(F.collect_set("chunk_id")).alias("chunks"), F.count("*").alias("merged_from"))
    counts = kept.groupBy(group).agg(F.sum(F.size("merged")).alias("quotes_before"), F.count("*").alias("quotes_after"))
    return whole.join(counts, group, "left").na.fill(0, ["quotes_before", "quotes_after"]), kept
