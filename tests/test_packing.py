"""Items on sheets, against one loop over each document."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from compare import same
from pyspark.sql import functions as F

from lectern import plans
from lectern.operators import packing

FORM = "doc string, item int, clip int, height double, width double, cuts array<double>, clear array<double>, each boolean"


class Flow:
    """The plain loop: a sheet of 842 points with margins of 40, written from the rules."""

    def __init__(self):
        self.sheet, self.y = 1, 40.0

    def turn(self):
        self.sheet, self.y = self.sheet + 1, 40.0

    def item(self, clips, each):
        out, begun, head = [], False, True
        scale = min([1.0, *(495 / c["width"] for c in clips if c["width"] and c["width"] > 0)])
        total = sum(c["height"] or 0 for c in clips) * scale
        for c in clips:
            top, foot, fresh = 0.0, c["height"] or 0.0, True
            cuts, clear = sorted(c["cuts"] or []), sorted(c["clear"] or [])
            while top < foot - 0.5:
                left = 802 - self.y
                if left < (58 if head else 20):
                    self.turn()
                    head = True
                elif begun and fresh and each and self.y > 40 and (left - 28 * head) < (foot - top) * scale / 3 - 1e-9:
                    self.turn()
                    head = True
                elif not begun and self.y > 40 and left - 28 < total / 3 - 1e-9:
                    self.turn()
                    head = True
                end = top + min((802 - self.y - 28 * head) / scale, foot - top)
                if end < foot - 0.5 and self.y > 40 and not [x for x in clear if top + 12 <= x <= end]:
                    self.turn()
                    head = True
                    continue
                at = self.y + 28 * head
                end = top + min((802 - at) / scale, foot - top)
                if end < foot - 0.5:
                    fits = [x for x in clear if top < x <= end] or [x for x in cuts if top < x <= end]
                    end = fits[-1] if fits else end
                out.append((c["item"], c["clip"], self.sheet, at, top, end, scale, head, head and begun))
                self.y, top, begun, fresh, head = at + (end - top) * scale + 20, end, True, False, False
                if top < foot - 0.5:
                    self.turn()
                    head = True
        return out


def plain(rows):
    out = []
    for doc in sorted({r["doc"] for r in rows}, key=lambda d: (d is not None, d)):
        flow, own = Flow(), [r for r in rows if r["doc"] == doc]
        for item in sorted({r["item"] for r in own}):
            clips = sorted((r for r in own if r["item"] == item), key=lambda r: (r["clip"], r["height"] or 0, r["cuts"] or []))
            out += [(doc, *s) for s in flow.item(clips, clips[0]["each"])]
    return out


def made(seed, n):
    """Clips of one document with most rows and some small ones; heights up to several sheets, wide ones, ones without gaps."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        doc = rng.choice(["big"] * 8 + ["a", "b", None])
        for k in range(rng.choice([1, 1, 2, 4])):
            h = float(rng.choice([0, 8, 30, 90, 200, 420, 700, 760, 1900]) + rng.randrange(40))
            cuts = [float(x) for x in range(rng.randrange(9, 40), int(h), rng.randrange(11, 60))]
            clear = rng.choice([cuts, cuts[::3], [], None])
            rows.append({"doc": doc, "item": i, "clip": k, "height": h, "width": rng.choice([None, 0.0, 300.0, 990.0]), "cuts": cuts or None, "clear": clear, "each": i % 2 == 0})
    return rows


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("seed, n, parts", [(1, 400, 4), (2, 150, 23), (3, 5, 64)])
def test_packed_against_one_loop(spark, seed, n, parts):
    """Few and many ranges: with 64 an item of several clips can be cut by ranges."""
    rows = made(seed, n)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = packing.packed(spark.createDataFrame(rows, FORM), F.col("each")).select("doc", "item", "clip", "page", "top", "lo", "hi", "scale", "headed", "continued").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = [(d, i, c, page, top, lo, hi, s, h, k) for d, i, c, page, top, lo, hi, s, h, k in plain(rows)]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_every_clip_is_shown_whole_once(spark):
    rows = spark.createDataFrame(made(4, 120), FORM)
    shown = packing.packed(rows).groupBy("doc", "item", "clip").agg(F.sum(F.col("hi") - F.col("lo")).alias("shown"))
    x = rows.where("height > 0.5").join(shown.withColumnRenamed("doc", "d"), ["item", "clip"], "left")
    assert x.where("shown is null or abs(shown - height) > 0.5").count() == 0


def test_odd_clips(spark):
    rows = [("x", None, None, None, None, None, None, None), ("x", 1, 1, float("inf"), float("nan"), [float("nan")], None, None), ("x", 2, 1, 50.0, float("inf"), [None], [], None), ("x", 2, 1, 50.0, float("inf"), [None], [], None), (None, None, None, 40.0, -3.0, [], [], True)]
    df = spark.createDataFrame(rows, FORM).withColumn("page", F.lit("its own")).withColumn("total", F.lit(1))
    got = packing.packed(df).collect()
    assert sorted((r.doc or "", r.page, r.top, r.hi, r.scale, r.headed) for r in got) == [("", 1, 68.0, 40.0, 1.0, True), ("x", 1, 68.0, 50.0, 1.0, True), ("x", 1, 138.0, 50.0, 1.0, False)]
    assert packing.packed(df.limit(0)).collect() == []


@pytest.mark.parametrize("first, ties", [((206, 249), (2063, 563)), ((296, 39), (901, 1501))])
def test_clips_of_one_height_follow_by_gaps_as_in_the_sql(spark, tmp_path, first, ties):
    """The last two clips are of one height, 71 or 37, with a gap every 24. The SQL rounds the number of gaps, 2.9 or 1.5, to 3 or 2, so the last one lies below the clip: only clips without other clear gaps have none before it, and they come second, where the sheet ends and nothing is cut."""
    lines = [(1, p, 0, n, 1.0) for n, p in enumerate(first, 1)] + [(1, p, 3, 3, 1.0) for p in ties]
    tables = {"orders": (("o_orderkey", "o_custkey"), [(1, 10)]), "lineitem": (("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"), lines)}
    for name, (columns, rows) in tables.items():
        pq.write_table(pa.table(dict(zip(columns, map(list, zip(*rows))))), tmp_path / f"{name}.parquet")
    df = plans.queries()["k09_packed_pages"](spark, str(tmp_path))
    assert df.count() == 4
    same(df, plans.oracle_sql()["k09_packed_pages"], str(tmp_path))


def test_where_ranges_begin_is_told_by_their_last_documents(spark):
    rows = [(d, i, c, 100.0 + c, 400.0, [50.0], [50.0], False) for d in [None, *range(30)] for i in range(3) for c in range(4)] + [(99, i, 0, 300.0, 400.0, [], None, False) for i in range(300)]
    ranges = packing.clips_in_ranges(spark.createDataFrame(rows, "doc int, item int, clip int, height double, width double, cuts array<double>, clear array<double>, each boolean"), F.lit(False))
    found = {}
    for r in ranges.select("__range", "doc").collect():
        found.setdefault(r["__range"], []).append(-1 if r.doc is None else r.doc)
    firsts, last = packing.tails(ranges)
    assert {r: -1 if d is None else d for r, d in firsts.items()} == {r: min(ds) for r, ds in found.items()}
    kept = [(r["__range"], r.doc) for r in last.select("__range", "doc").collect()]
    assert sorted(kept) == sorted((r, max(ds)) for r, ds in found.items() for d in ds if d == max(ds)) and len(kept) < len(rows)
    assert len(packing.range_starts(ranges)) > 0  # the long document goes on over ranges
