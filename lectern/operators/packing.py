"""Items laid out on sheets, one after another, of which each may be cut at gaps."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.graphs import cut
from lectern.operators.sequences import dealt

# Fixed values, in points: what a sheet holds across and down, where it begins, the head above an item, the space below it, what has to fit below a head or without one, the shortest slice before a turn, and what counts as nothing.
WIDTH, SHEET, TOP, HEAD, ITEM_GAP, LEAST_BODY, LEAST_ROOM, LEAST_SLICE, NOTHING = 495, 762, 40, 28, 20, 30, 20, 12, 0.5
#: An item begins low on a sheet only if one part in so many of it fits there.
PARTS = 3
#: Slices in a batch that a task gives out.
BATCH = 4096


class Place(NamedTuple):
    """Where the layout of a document stands: its sheet, what of it is used, whether a head is due, and whether the item has begun."""

    doc: object = None
    item: object = None
    page: int = 1
    used: float = 0.0
    due: bool = True
    begun: bool = False

    def at(self, doc: object, item: object) -> Place:
        """The place as the next clip finds it."""
        if doc != self.doc:
            return Place(doc, item)
        return self if item == self.item else self._replace(item=item, due=True, begun=False)


#: Sorted numbers: those of a list from one place in it up to another.
Points = tuple[list[float], int, int]


def last_cut(cuts: Points, lo: float, hi: float) -> float | None:
    """The last of sorted cuts over lo and up to hi."""
    values, a, b = cuts
    i = bisect_right(values, hi, a, b) - 1
    return values[i] if i >= a and values[i] > lo else None


def has_cut(cuts: Points, lo: float, hi: float) -> bool:
    values, a, b = cuts
    i = bisect_left(values, lo, a, b)
    return i < b and values[i] <= hi


class Clip(NamedTuple):
    height: float
    scale: float
    total: float
    each: bool
    cuts: Points
    clear: Points


def too_low(used: float, due: bool, begun: bool, clip: Clip, rest: float) -> bool:
    """Whether too little of what comes would fit on the used sheet."""
    room = SHEET - used
    if room < (HEAD + LEAST_BODY if due else LEAST_ROOM):
        return True
    if not begun:
        return PARTS * (room - HEAD) < clip.total
    return clip.each and rest == clip.height and PARTS * (room - HEAD * due) < rest * clip.scale


def laid(p: Place, clip: Clip) -> tuple[Place, list[tuple]]:
    """The slices of one clip from a place on (page, top, lo, hi, headed, continued), and the place below it."""
    done, out, height, scale = 0.0, [], clip.height, clip.scale
    doc, item, page, used, due, begun = p
    while height - done > NOTHING:
        rest = height - done
        if used > 0 and too_low(used, due, begun, clip, rest):
            page, used, due = page + 1, 0.0, True
        body = (SHEET - used - HEAD * due) / scale
        if body < rest - NOTHING and used > 0 and not has_cut(clip.clear, done + LEAST_SLICE, done + body):
            page, used, due = page + 1, 0.0, True
            body = (SHEET - HEAD) / scale
        end = done + min(body, rest)
        if end < height - NOTHING:
            cuts = (last_cut(c, done, end) for c in (clip.clear, clip.cuts))
            end = next((c for c in cuts if c is not None), end)
        top = used + HEAD * due
        out.append((page, TOP + top, done, end, due, due and begun))
        used, due, begun = top + (end - done) * scale + ITEM_GAP, False, True
        done = end
        if height - done > NOTHING:
            page, used, due = page + 1, 0.0, True
    return Place(doc, item, page, used, due, begun), out


def clips_of(batch: pa.RecordBatch) -> Iterator[tuple[int, object, object, object, Clip]]:
    """(range, doc, item, clip, what is laid) of each row of a batch. Its gaps are one list of numbers for all rows."""
    def points(c: str) -> Iterator[Points]:
        gaps = batch.column(c)
        values, ends = gaps.values.to_numpy(zero_copy_only=False).tolist(), gaps.offsets.to_pylist()
        return ((values, a, b) for a, b in zip(ends, ends[1:]))

    plain = lambda c: batch.column(c).to_pylist()
    laid_out = map(Clip, *(batch.column(c).to_numpy(zero_copy_only=False).tolist() for c in ("height", "scale", "total", "each")), points("cuts"), points("clear"))
    return zip(plain("__range"), plain("doc"), plain("item"), plain("clip"), laid_out)


def runs(batches: Iterator[pa.RecordBatch], starts: dict[int, Place]) -> Iterator[tuple[int, Place, bool, list[tuple]]]:
    """(range, place, own, slices) after each clip of sorted batches; own: the document began in this range. A range begins at its place in starts, else with a new document. Slices: doc, item, clip, page, top, lo, hi, scale, headed, continued."""
    r, p, own = None, Place(), False
    for b in batches:
        for range_, doc, item, clip, what in clips_of(b):
            if range_ != r:
                r, own = range_, range_ not in starts
                p = starts.get(r, Place())
            own = own or doc != p.doc
            p, slices = laid(p.at(doc, item), what)
            yield r, p, own, [(doc, item, clip, page, top, lo, hi, what.scale, headed, continued) for page, top, lo, hi, headed, continued in slices]


def clips_in_ranges(clips: DataFrame, each: Column) -> DataFrame:
    """The clips with the scale and total height of their items, dealt over ranges of (doc, item, clip)."""
    def number(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(F.abs(v) < float("inf"), v)

    points = lambda c: F.array_sort(F.filter(F.coalesce(F.col(c).cast("array<double>"), F.array().cast("array<double>")), lambda x: x.isNotNull()))
    c = clips.select("doc", "item", "clip", F.coalesce(number("height"), F.lit(0.0)).alias("height"), number("width").alias("width"), points("cuts").alias("cuts"), points("clear").alias("clear"), F.coalesce(each, F.lit(False)).alias("each"))
    fits = F.min(F.when(F.col("width") > 0, WIDTH / F.col("width")))
    items = c.groupBy(F.col("doc").alias("__doc"), F.col("item").alias("__item")).agg(F.least(F.lit(1.0), fits).alias("scale"), F.sum("height").alias("__sum"))
    same = F.col("doc").eqNullSafe(F.col("__doc")) & F.col("item").eqNullSafe(F.col("__item"))
    j = c.join(items, same).withColumn("total", F.col("__sum") * F.col("scale")).drop("width", "__doc", "__item", "__sum")
    return dealt(j, ["doc"], ["item", "clip", "height"])


def played(ranges: DataFrame, work: Callable[[Iterator[pa.RecordBatch], pa.Schema], Iterator[pa.RecordBatch]], columns: dict[str, str]) -> DataFrame:
    """The rows, of these columns and types, that work makes of each range in order; a type may be the name of a column of ranges."""
    empty = ranges.select(*(F.col(t).alias(c) if t in ranges.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items())).limit(0)
    out = empty.toArrow().schema
    return ranges.sortWithinPartitions("__range", "doc", "item", "clip", "height", "cuts", "clear", "each").mapInArrow(lambda batches: work(batches, out), empty.schema)


def tails(ranges: DataFrame) -> tuple[dict[int, object], DataFrame]:
    """The first document of each range, and of each range the clips of its last one."""
    sides = ranges.groupBy("__range").agg(F.min(F.struct("doc"))["doc"].alias("first"), F.max(F.struct("doc"))["doc"].alias("last"))
    rows = sides.collect()  # one for each range
    last = ranges.sparkSession.createDataFrame([(x["__range"], x["last"]) for x in rows], ranges.select("__range", F.col("doc").alias("__last")).schema)
    kept = ranges.join(F.broadcast(last), "__range").where(F.col("doc").eqNullSafe(F.col("__last")))
    return {x["__range"]: x["first"] for x in rows}, cut(kept.select(*ranges.columns))


def range_starts(ranges: DataFrame) -> dict[int, Place]:
    """The place at which each range begins that goes on with the document of the one before.

    Where a range ends depends on its last document alone, so only that one is played, in all ranges in parallel, at first as if each began a document. A range that turns out to begin elsewhere than it was played from is played again; layouts that
    differ come together at the first item that both begin on a new sheet, so few are played more than twice. The driver holds one place for each range, of which there are as many as shuffle partitions.
    """
    firsts, ranges = tails(ranges)

    def ends(which: DataFrame, starts: dict[int, Place]) -> dict:
        def work(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
            rows = {}
            for r, p, own, _ in runs(batches, starts):
                rows[r] = {"r": r, **p._asdict(), "own": own}
            if rows:
                yield pa.RecordBatch.from_pylist(list(rows.values()), schema=out)

        columns = {"r": "int", "doc": "doc", "item": "item", "page": "bigint", "used": "double", "due": "boolean", "begun": "boolean", "own": "boolean"}
        return {x.r: x for x in played(which, work, columns).collect()}

    found = ends(ranges, {})
    order = sorted(found)
    from_: dict[int, Place | None] = dict.fromkeys(order)
    while True:
        starts = {}
        for a, b in zip(order, order[1:]):
            x = found[a]
            if x.doc == firsts[b]:
                starts[b] = Place(x.doc, x.item, 0, x.used, x.due, x.begun)
        anew = {r: starts.get(r) for r in order if starts.get(r) != from_[r]}
        if not anew:
            break
        found |= ends(ranges.where(F.col("__range").isin(list(anew))), {r: p for r, p in anew.items() if p})
        from_ |= anew
    for a, b in zip(order, order[1:]):
        if b in starts:
            starts[b] = starts[b]._replace(page=found[a].page + (0 if found[a].own else starts[a].page))
    return starts


def packed(clips: DataFrame, each: Column | None = None) -> DataFrame:
    """doc, item, clip, page (from 1), top, lo, hi, scale, headed, continued: the slices of clips on the sheets of each document, one after another. clips: doc, item, clip (their order), height, width, cuts, clear (sorted: offsets from a clip's top
    that fall between its lines, and those of them that no object crosses).

    An item has a head where it begins and again on every sheet that it goes over to (continued). It is scaled to the sheet as a whole if one of its clips is too wide. It turns the sheet first where less than a third of it would fit, and where what fits
    ends at no clear gap; what is cut is cut at the last clear gap that fits, else between lines, else at the end of the sheet. Where each is true, the rule of a third holds for every clip of an item.

    The clips are dealt over ranges of documents and items; a document with a third of all clips lies in as many ranges as it fills. Clips without height have no slice, widths that are null or not over 0 aren't scaled, null gaps are none; a null doc or
    item is one of its own, clips of one place follow by height and gaps, repeated rows are laid out each. No rows give none.
    """
    ranges = clips_in_ranges(clips, F.lit(False) if each is None else each)
    starts = range_starts(ranges)

    def work(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
        rows: list[tuple] = []
        for *_, slices in runs(batches, starts):
            rows += slices
            if len(rows) >= BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return played(ranges, work, {"doc": "doc", "item": "item", "clip": "clip", "page": "bigint", "top": "double", "lo": "double", "hi": "double", "scale": "double", "headed": "boolean", "continued": "boolean"})
