"""Mixing sources to target weights by Pfair scheduling of blocks."""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import durable, free_name

#: Documents of one source in a block.
BLOCK_DOCS = 16
#: Slots that are worked out in one row.
STRETCH = 4096
#: Slots of a cycle that is broadcast at most (some 40 MB).
BROADCAST_SLOTS = 1_000_000
#: Weights are numbers, or text such as "1/3".
Weights = dict[str, "int | float | str | Fraction"]


def tickets(weights: Weights) -> dict[str, int]:
    """Whole numbers, as small as can be, in exactly the proportions of the weights. Floats count as the decimals that they print as. Weights that are null, 0 or negative have no ticket."""
    exact = {k: Fraction(str(w)) for k, w in weights.items() if w is not None and Fraction(str(w)) > 0}
    whole = reduce(math.lcm, (w.denominator for w in exact.values()), 1)
    common = reduce(math.gcd, (int(w * whole) for w in exact.values()), 0)
    return {k: int(w * whole) // common for k, w in exact.items()}


def weighted(sizes: DataFrame, weights: Weights | None) -> DataFrame:
    """src, docs, share, slots: a source's target weight is exactly share / slots, share its tickets and slots those of all sources together.

    weights None: as many tickets as the whole part of the square root of the source's documents. A source without a weight, or of one that isn't above 0, has no share and comes after all others.
    """
    if weights is None:
        share = F.floor(F.sqrt("docs")).cast("long")
    else:
        known = {f"s{k}": n for k, n in tickets(weights).items()}
        table = F.create_map(*(F.lit(x) for kv in known.items() for x in kv)) if known else F.create_map().cast("map<string,bigint>")
        share = F.coalesce(F.get(F.array(table), F.lit(0))[F.col("src")].cast("long"), F.lit(0).cast("long"))
    return sizes.withColumn("share", share).withColumn("slots", F.sum("share").over(Window.partitionBy())).select("src", "docs", "share", "slots")


def quotient(a: Column, b: Column) -> Column:
    """a over b in whole numbers, rounded down; none is below 0."""
    return F.call_function("div", a, b)


def release(block: Column, share: Column, slots: Column) -> Column:
    """The first slot that a source's block, counted from 0, may take: its number over the weight, rounded down."""
    return quotient(block * slots, share)


def deadline(block: Column, share: Column, slots: Column) -> Column:
    """The slot before which it must have been: the next number over the weight, rounded up."""
    return quotient((block + 1) * slots + share - 1, share)


def guessed(kinds: Column, slots: Column, t: Column) -> Column:
    """How many blocks of each kind (share, members) stand before slot t, as far as that shows without the slots before: of each source the whole part of t times its weight, and what t then lacks from the blocks of the earliest deadlines.

    Those whole parts are never too many, and t minus their sum is what EDF has chosen from one further block of each source; which ones depends on the slots before, but mostly they are the most urgent."""
    floors = F.transform(kinds, lambda k: quotient(t * k["share"], slots))
    base = F.zip_with(kinds, floors, lambda k, n: k["members"] * n)
    missing = t - F.aggregate(base, F.lit(0).cast("long"), lambda s, x: s + x)
    urgent = F.array_sort(F.filter(F.transform(F.arrays_zip(kinds.alias("k"), floors.alias("n")), lambda x, i: F.when(release(x["n"], x["k"]["share"], slots) < t, F.struct(deadline(x["n"], x["k"]["share"], slots).alias("deadline"), i.alias("kind"), x["k"]["members"].alias("members")))), lambda x: x.isNotNull()))

    def spend(s: Column, u: Column) -> Column:
        n = F.least(s["left"], u["members"])
        return F.struct((s["left"] - n).alias("left"), F.concat(s["more"], F.array(F.struct(u["kind"].alias("kind"), n.alias("n")))).alias("more"))

    spent = F.aggregate(urgent, F.struct(missing.alias("left"), F.array().cast("array<struct<kind:int,n:bigint>>").alias("more")), spend)["more"]
    more = F.map_from_entries(spent)
    return F.transform(base, lambda n, i: n + F.coalesce(more[i], F.lit(0)))


def played(ranges: DataFrame) -> DataFrame:
    """ranges (kinds, slots, first, last, done: blocks of each kind before first) with turns, the kind of each slot from first to last, and after, the blocks of each kind before last + 1."""
    slots = F.col("slots")

    def bid(kind: Column, done: Column) -> Column:
        """What a share's next block asks for, when `done` blocks of it were placed."""
        nth = quotient(done, kind["members"])
        return F.struct(done.alias("done"), release(nth, kind["share"], slots).alias("release"), deadline(nth, kind["share"], slots).alias("deadline"))

    def step(state: Column, t: Column) -> Column:
        """The kind of the next turn, and the bids after it."""
        ready = F.transform(state["bids"], lambda b, i: F.when(b["release"] <= t, F.struct(b["deadline"].alias("deadline"), i.alias("kind"))))
        turn = F.transform(F.array(F.array_min(ready)["kind"]), lambda c: F.struct(F.transform(state["bids"], lambda b, i: F.when(i == c, bid(F.get(F.col("kinds"), i), b["done"] + 1)).otherwise(b)).alias("bids"), F.concat(state["turns"], F.array(c)).alias("turns")))
        return F.get(turn, F.lit(0))

    begun = F.struct(F.zip_with("kinds", "done", bid).alias("bids"), F.array().cast("array<int>").alias("turns"))
    end = ranges.withColumn("end", F.aggregate(F.sequence("first", "last"), begun, step))
    return end.select("kinds", "slots", "first", "last", "done", F.col("end.turns").alias("turns"), F.transform("end.bids", lambda b: b["done"]).alias("after"))


def cycle(sources: DataFrame, block_docs: int) -> DataFrame:
    """src, nth, slot: where the nth block of a source stands, by the earliest deadline of the blocks released; of equal deadlines the source of the larger share goes first, then the one before in order.

    The shares fill the slots, so a block is always ready and each lies within its release and deadline: at any time a source is less than one block from its target weight. After `slots` slots all
    is as at the start, so what is worked out is one cycle, or less if the documents need less. Sources of one share have the same releases and deadlines and take turns, so a step goes over the different shares only.

    The cycle is cut into ranges of STRETCH slots that are played in parallel, each from a guess of where it begins. A range that begins elsewhere than the one before has ended is played again from there, with only such ranges, until none is
    left: the first range is right from the start, and each round settles one more at least. A guess that is wrong mostly meets the right course within its range, as an urgent block comes first in both.
    """
    ranked = sources.where("share > 0").withColumn("seat", F.row_number().over(Window.partitionBy("share").orderBy("src")) - 1)
    needed = F.max(deadline(quotient(F.col("docs") + block_docs - 1, F.lit(block_docs)) - 1, F.col("share"), F.col("slots")))
    kinds = ranked.groupBy("share", "slots").agg(F.count(F.lit(1)).alias("members"), needed.alias("needed"))
    one = kinds.groupBy("slots").agg(F.reverse(F.array_sort(F.collect_list(F.struct("share", "members")))).alias("kinds"), F.least(F.max("needed"), F.first("slots")).alias("steps"))
    ranges = one.select("kinds", "slots", "steps", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps") - 1, F.lit(STRETCH).cast("long"))).alias("first"))
    ranges = ranges.repartition("first").select("kinds", "slots", "first", (F.least(F.col("first") + STRETCH, F.col("steps")) - 1).alias("last"), guessed(F.col("kinds"), F.col("slots"), F.col("first")).alias("done"))
    settled = durable(played(ranges))
    while True:
        ends = settled.select((F.col("last") + 1).alias("first"), F.col("after").alias("begin"))
        off = settled.join(ends, "first").where("done <> begin").select("kinds", "slots", "first", "last", F.col("begin").alias("done"))
        again = durable(played(off))
        if again.isEmpty():
            break
        settled = durable(settled.join(again.select("first"), "first", "left_anti").select(*again.columns).unionByName(again))
    turns = settled.select("kinds", "first", "done", F.posexplode("turns").alias("n", "kind"))
    turns = turns.select("first", F.get("kinds", F.col("kind")).alias("k"), F.get("done", F.col("kind")).alias("before"), "kind", (F.col("first") + F.col("n")).alias("slot"))
    of_range = F.row_number().over(Window.partitionBy("first", "kind").orderBy("slot")) - 1
    placed = turns.select("k.share", "k.members", "slot", (F.col("before") + of_range).cast("long").alias("done"))
    placed = placed.select("share", F.col("done") % F.col("members"), quotient(F.col("done"), F.col("members")), "slot").toDF("share", "seat", "nth", "slot")
    return placed.join(ranked.select("share", "seat", "src"), ["share", "seat"]).select("src", "nth", "slot")


def scheduled(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: Weights | None = None, block_docs: int = BLOCK_DOCS, names: dict[str, str] | None = None) -> DataFrame:
    """docs with src_key, share, slots, block, release, deadline, slot and place (its order in the mix): every row once.

    Within a source documents go by the md5 of their id as text, then by id, then by the hash of their columns, so only rows that are equal may change places. When a source has no more blocks its slots stay empty and the others go on.
    Sources without a weight (share 0) come after the last deadline of the others and take turns, a block each. A null source is a source of its own. Null ids come first in their source. Repeated rows stay. Columns of docs that
    clash with one of the new names win no place: give `names` to rename the new ones. No rows give none.

    A source with a third of all rows is ranked in parts, by the first digits of the md5, with the parts before counted ahead. The cycle (with the default weights about the square root of documents times sources) is worked out in
    ranges of slots, and broadcast only if it is small.
    """
    new = {c: c for c in ("src_key", "share", "slots", "block", "release", "deadline", "slot", "place")} | (names or {})
    digits = min(7, max(1, math.ceil(math.log(max(2, docs.count()), 16) / 2)))
    md, row, src, part, ahead, seat, nth, at, turn = (free_name(docs, x) for x in ("md5", "row", "src", "part", "ahead", "seat", "nth", "at", "turn"))
    share, slots, start, others = (free_name(docs, x) for x in ("share", "slots", "start", "others"))
    rows = docs.withColumn(md, F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))).withColumn(row, F.xxhash64(*(F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind)))
    rows = rows.withColumn(src, F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n"))).withColumn(part, F.substring(md, 1, digits))
    counts = rows.groupBy(src, part).agg(F.count(F.lit(1)).alias("c"))
    sources = weighted(counts.groupBy(F.col(src).alias("src")).agg(F.sum("c").alias("docs")), weights)
    last = F.max(F.when(F.col("share") > 0, deadline(quotient(F.col("docs") + block_docs - 1, F.lit(block_docs)) - 1, F.col("share"), F.col("slots"))))
    last = sources.agg(F.coalesce(last, F.lit(0)).alias(start), F.count_if(F.col("share") == 0).alias(others), F.coalesce(F.max("slots"), F.lit(0)).alias("cycle"))
    steps = min(last.select("cycle", start).first())
    before = F.sum("c").over(Window.partitionBy(src).orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn(ahead, F.coalesce(before, F.lit(0))).drop("c")
    order = F.when(F.col("share") == 0, F.row_number().over(Window.partitionBy(F.col("share") == 0).orderBy("src")) - 1)
    offsets = offsets.join(sources.select(F.col("src").alias(src), F.col("share").alias(share), F.col("slots").alias(slots), order.alias(turn)), src).crossJoin(F.broadcast(last.drop("cycle")))  # one row
    rows = rows.join(offsets, [src, part])
    rank = F.row_number().over(Window.partitionBy(src, part).orderBy(md, F.col(id_col), row))
    rows = rows.withColumn(seat, F.col(ahead) + rank - 1)
    block = quotient(F.col(seat), F.lit(block_docs))
    turns = cycle(sources, block_docs).select(F.col("src").alias(src), F.col("nth").alias(nth), F.col("slot").alias(at))
    turns = F.broadcast(turns) if steps <= BROADCAST_SLOTS else turns
    rows = rows.withColumn(nth, F.when(F.col(share) > 0, block % F.col(share))).join(turns, [src, nth], "left")
    of_cycle = quotient(block, F.col(share))
    slot = F.when(F.col(share) > 0, of_cycle * F.col(slots) + F.col(at)).otherwise(F.col(start) + block * F.col(others) + F.col(turn))
    begin = lambda x: F.when(F.col(share) > 0, of_cycle * F.col(slots) + x(F.col(nth), F.col(share), F.col(slots)))
    return rows.select(
        *(rows[c] for c in docs.columns),
        F.col(src).alias(new["src_key"]),
        F.col(share).alias(new["share"]),
        F.col(slots).alias(new["slots"]),
        block.alias(new["block"]),
        F.coalesce(begin(release), slot).alias(new["release"]),
        F.coalesce(begin(deadline), slot + 1).alias(new["deadline"]),
        slot.alias(new["slot"]),
        (slot * block_docs + F.col(seat) % block_docs).cast("long").alias(new["place"]),
    )


def in_mixed_order(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: Weights | None = None, block_docs: int = BLOCK_DOCS, place_col: str | None = None) -> DataFrame:
    """The rows of docs, all of them and with their columns, in the order of the mix: written out, the files in the order of their names are the mixed stream. Spark reads files by size, so a reader that needs the order
    sorts by place_col, a further column, or mixes again: the same rows give the same order."""
    kinds = ("src_key", "share", "slots", "block", "release", "deadline", "slot", "place")
    names = {k: free_name(docs, f"mix_{k}") for k in kinds}
    more = [F.col(names["place"]).alias(place_col)] if place_col else []
    return scheduled(docs, id_col, source_col, weights, block_docs, names).orderBy(names["place"]).select(*(F.col(c) for c in docs.columns), *more)
