"""Questions as lines and boxes on pages: narrowing to parts, preambles that change hands, boxes that touch."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions.papers import noise
from lectern.operators.graphs import components, cut
from lectern.operators.reports import answer_lines
from lectern.operators.sequences import merged_intervals

#: Points kept above a first and below a last line.
TOP_PAD, BOTTOM_PAD = 6, 10
# Labels of parts, the end of an answer space (a mark or dots), the tariff that ends a task, the heading of a box that belongs to the task above.
LETTER, ROMAN = r"^\(([a-h])\)", r"^\(([ivx]{1,4})\)"
SPACE_END = r"\[[0-9]{1,2}\]|([.·…][ \t\n]?){20,}|^[.·…\t\n ]{12,}$"
TARIFF, EVIDENCE = r"\[[0-9]{1,3}\][ \t\n]*$", r"^Evidence[ \t\n]+[0-9]+($|[^\p{L}\p{N}_])"
#: Widest gap between two lines of one box.
BOX_GAP = 16


def place(page: Column | str = "page", y: Column | str = "top") -> Column:
    """A position on a question's pages; positions are ordered by page, then by height."""
    return F.struct(F.col(page).cast("int").alias("page") if isinstance(page, str) else page.cast("int").alias("page"), (F.col(y) if isinstance(y, str) else y).cast("double").alias("y"))


def above(pos: Column, by: float = TOP_PAD) -> Column:
    return place(pos["page"], pos["y"] - by)


def line_spans(lines: DataFrame, by: list[str]) -> DataFrame:
    """by, page, lo, hi: what the lines of each page reach over, padded."""
    return lines.groupBy(*by, "page").agg((F.min("top") - TOP_PAD).cast("double").alias("lo"), (F.max("bottom") + BOTTOM_PAD).cast("double").alias("hi"))


def by_page(lines: DataFrame) -> DataFrame:
    """q, page, lines (top, bottom, text; sorted): the lines of each page as one row, so that a page's text is shuffled once."""
    return cut(lines.groupBy("q", "page").agg(F.array_sort(F.collect_list(F.struct("top", "bottom", "text"))).alias("lines")))


def line_facts(pages: DataFrame) -> DataFrame:
    """q, page, top, bottom, nth (its place on the page), letter, roman, ends, shown: what the labels of lines (see by_page) are found by, without their text."""
    x = pages.select("q", "page", F.posexplode("lines").alias("nth", "l")).select("q", "page", "l.top", "l.bottom", "nth", "l.text")
    label = lambda pattern: F.nullif(F.regexp_extract("text", pattern, 1), F.lit(""))
    said = (F.trim("text") != "") | (F.col("bottom") - F.col("top") > 5)
    return cut(x.select("q", "page", "top", "bottom", "nth", label(LETTER).alias("letter"), label(ROMAN).alias("roman"), F.col("text").rlike(SPACE_END).alias("ends"), said.alias("shown")).repartition("q"))


def labelled(lines: DataFrame, by: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """The labels of one level, and the lead-ins between them. lines: by, page, top, nth, label, ends, shown (see line_facts), of one scope each.

    Labels: by, label, at (its place), nth (from 1), first (the place of the scope's first label), until (of the next one), lead; a label that comes again counts once, where it is first.
    A lead-in is what stands after the last answer space (a mark or dots) between two labels: it introduces the label below. lead is where that of a label begins, or null.
    Lead-ins: by, nth (of the label that they introduce), lead, until (just above that label).
    """
    w = Window.partitionBy(*by).orderBy("page", "top")
    own = lines.withColumn("__label", F.col(label)).withColumn("__pos", place())
    own = own.withColumn("__seg", F.count("__label").over(w)).withColumn("__at", F.max(F.when(F.col("__label").isNotNull(), F.col("__pos"))).over(w))  # peers of one place are counted together
    between = own.where("__seg > 0 and __pos > __at").withColumn("__key", F.struct("page", "nth", "top"))
    end = F.max(F.when(F.col("ends"), F.col("__key"))).over(Window.partitionBy(*by, "__seg"))
    leads = between.withColumn("__end", end).where((F.col("__key") > F.col("__end")) & F.col("shown")).groupBy(*by, "__seg").agg(F.min("__key").alias("__k"))
    leads = leads.select(*by, (F.col("__seg") + 1).alias("nth"), above(place(F.col("__k.page"), F.col("__k.top"))).alias("lead"))
    order = Window.partitionBy(*by).orderBy("__pos", "__label")
    marks = own.where("__label is not null").select(*by, F.col("__label").alias("label"), F.col("__pos").alias("at"), F.row_number().over(order).cast("long").alias("nth"), F.lead("__pos").over(order).alias("until"))
    marks = cut(marks.withColumn("first", F.min("at").over(Window.partitionBy(*by))).join(leads, [*by, "nth"], "left"))
    ins = marks.where("lead is not null").select(*by, "nth", "lead", above(F.col("at")).alias("until"))
    named = marks.withColumn("__again", F.row_number().over(Window.partitionBy(*by, "label").orderBy("nth"))).where("__again = 1").drop("__again")
    return named, ins


def part_ranges(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """q, letter, roman (null for the letter as a whole), level, lo, hi: the ranges of places that make up each part.

    lines: see line_facts. A part is its own stretch, from its label (or the lead-in above it) to the next label; the stems above the first label of each level that it lies in; and the lead-ins of earlier labels of these levels, as set-up carries forward.
    """
    ends = spans.groupBy("q").agg(F.min(place("page", "lo")).alias("top"), F.max_by(place("page", "hi"), "page").alias("bottom"))
    ranges = lambda df, level, lo, hi: df.select("q", "letter", "roman", F.lit(level).alias("level"), lo.alias("lo"), hi.alias("hi"))

    def pieces(parts: DataFrame, ins: DataFrame, by: list[str], names: list[str], level: int) -> tuple[DataFrame, DataFrame]:
        """What leads up to each part on its level, and its own stretch."""
        stems = ranges(parts.where(above(F.col("first")) > F.col("top")), level, F.col("top"), above(F.col("first")))
        earlier = ins.select(*(F.col(c).alias(f"__{c}") for c in by), F.col("nth").alias("__nth"), F.col("lead").alias("__lead"), F.col("until").alias("__until"))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__{c}") for c in by]) & (F.col("__nth") < F.col("nth"))
        before = ranges(parts.join(earlier, same), level, F.col("__lead"), F.col("__until"))
        own = parts.select("q", *names, F.coalesce("lead", above(F.col("at"))).alias("top"), F.coalesce("until", "bottom").alias("bottom"))
        return stems.unionByName(before), own

    scopes = ends.select("q", F.col("top").alias("from"), F.col("bottom").alias("to"))
    inside = lines.join(scopes, "q").where((place() >= F.col("from")) & (place() < F.col("to"))).select(*lines.columns)
    letters, ins = labelled(inside, ["q"], "letter")
    letters = letters.withColumnRenamed("label", "letter").withColumn("roman", F.lit(None).cast("string")).join(ends, "q")
    shared, own = pieces(letters, ins, ["q"], ["letter"], 1)
    whole = ranges(own.withColumn("roman", F.lit(None).cast("string")), 1, F.col("top"), F.col("bottom"))
    scopes = own.select("q", "letter", F.col("top").alias("from"), F.col("bottom").alias("to"))
    within = lines.drop("letter").join(scopes, "q").where((place() >= F.col("from")) & (place() < F.col("to")))
    romans, ins2 = labelled(within, ["q", "letter"], "roman")
    romans = romans.withColumnRenamed("label", "roman").join(own, ["q", "letter"])
    shared2, own2 = pieces(romans, ins2, ["q", "letter"], ["letter", "roman"], 2)
    handed = shared.drop("roman").join(own2.select("q", "letter", "roman"), ["q", "letter"])
    return reduce(DataFrame.unionByName, [shared, whole, handed.select(*shared.columns), shared2, ranges(own2, 2, F.col("top"), F.col("bottom"))])


def touching_as_one(cells: Column, gap: float) -> Column:
    """Sorted (lo, hi) of an array as one where they overlap or lie at most gap apart."""
    def grown(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        both = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))
        return F.when((F.size(done) > 0) & (x["lo"] <= F.try_element_at(done, F.lit(-1))["hi"] + gap), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.slice(cells, 2, F.greatest(F.size(cells), F.lit(1))), F.slice(cells, 1, 1), grown)


def narrowed_lines(lines: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """What narrowed gives, with lines: those that start in the slice, as an array of top, bottom and text, sorted.

    Labels are found without the text of lines; the text is shuffled once, as one row for each page, which the slices of all parts meet there. The cells of a part on a page are one row too, which is merged by itself.
    """
    pages = by_page(lines)
    if spans is None:
        edge = lambda c, f, pad: (f(F.col("lines")[c]) + pad).cast("double")
        spans = pages.select("q", "page", edge("top", F.array_min, -TOP_PAD).alias("lo"), edge("bottom", F.array_max, BOTTOM_PAD).alias("hi"))
    spans = cut(spans)
    r = part_ranges(line_facts(pages), spans).select("q", "letter", "roman", F.col("lo").alias("a"), F.col("hi").alias("b"))
    cells = r.join(spans, "q").where((F.col("page") >= F.col("a.page")) & (F.col("page") <= F.col("b.page")))
    lo, hi = F.when(F.col("page") == F.col("a.page"), F.col("a.y")).otherwise(F.col("lo")), F.when(F.col("page") == F.col("b.page"), F.col("b.y")).otherwise(F.col("hi"))
    cells = cells.select("q", "letter", "roman", "page", lo.alias("lo"), hi.alias("hi")).where("hi - lo >= 1")
    cells = cells.groupBy("q", "letter", "roman", "page").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("cells"))
    starts = lambda s: lambda x: (s["lo"] <= x["top"]) & (x["top"] < s["hi"])
    x = cells.join(pages, ["q", "page"]).withColumn("cells", F.filter("cells", lambda s: F.exists("lines", starts(s)))).where(F.size("cells") > 0)
    x = x.select("q", "letter", "roman", "page", "lines", F.explode(touching_as_one(F.col("cells"), 1)).alias("s"))
    return x.select("q", "letter", "roman", "page", "s.lo", "s.hi", F.filter("lines", starts(F.col("s"))).alias("lines"))


def narrowed(lines: DataFrame, spans: DataFrame | None = None) -> DataFrame:
    """q, letter, roman, page, lo, hi: the slices of pages that show each part of a question, with the stems and lead-ins above it. lines: q, page, top, bottom, text; spans: q, page, lo, hi (else those of the lines).

    A range of places becomes a slice of each page that it runs over, within the question's own reach there; a slice of under a point, or in which no line starts, goes; slices that touch are one. Questions without labels have no rows.
    """
    return narrowed_lines(lines, spans).drop("lines")


def part_lines(lines: DataFrame, slices: DataFrame) -> DataFrame:
    """The lines that each part shows: q, letter, roman, page, top, bottom, text."""
    s = slices.select(F.col("q").alias("__q"), F.col("page").alias("__p"), "letter", "roman", "lo", "hi")
    same = (F.col("q") == F.col("__q")) & (F.col("page") == F.col("__p")) & (F.col("lo") <= F.col("top")) & (F.col("top") < F.col("hi"))
    return lines.join(s, same).select("q", "letter", "roman", "page", "top", "bottom", "text")


def handed_over(lines: DataFrame) -> DataFrame:
    """lines (paper, block, page, top, bottom, text and others) with owner and moved: what stands below the last tariff of a task goes to the next task of the paper, as its preamble.

    What begins with an `Evidence N` heading stays with the task above, with the lines below it on the page as long as no gap is wider than BOX_GAP; so does each further such box that follows at once. A task without a tariff keeps all, and so
    does the last of a paper, and one of which the rest is blank.
    """
    own = Window.partitionBy("paper", "block")
    order = own.orderBy("page", "top", "bottom", "text")
    last = F.max(F.when(F.col("text").rlike(TARIFF), place("page", "bottom"))).over(own)
    x = lines.withColumn("__mark", last).withColumn("__tail", F.col("__mark").isNotNull() & (place() > above(F.col("__mark"), 2)))
    before = F.lag(F.struct("page", "bottom", "__tail")).over(order)
    x = x.withColumn("__before", before)
    breaks = ~F.coalesce(F.col("__before.__tail") & (F.col("__before.page") == F.col("page")) & (F.col("top") - F.col("__before.bottom") <= BOX_GAP), F.lit(False))
    ends = F.col("__tail") & breaks & ~F.col("text").rlike(EVIDENCE)
    x = x.withColumn("__ends", ends.cast("int")).withColumn("__out", F.col("__tail") & (F.max("__ends").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 1))
    x = x.withColumn("__said", F.max((F.col("__out") & (F.trim("text") != "")).cast("int")).over(own) == 1)
    blocks = lines.select("paper", "block").distinct().withColumn("__next", F.lead("block").over(Window.partitionBy("paper").orderBy("block")))
    moved = F.col("__out") & F.col("__said") & F.col("__next").isNotNull()
    x = x.join(blocks, ["paper", "block"]).withColumn("moved", moved)
    return x.withColumn("owner", F.when(F.col("moved"), F.col("__next")).otherwise(F.col("block"))).select(*lines.columns, "owner", "moved")


def owner_spans(handed: DataFrame) -> DataFrame:
    """paper, owner, page, lo, hi, own_start (for an owner that was given a preamble: the place where its own first line stands; else null)."""
    spans = line_spans(handed, ["paper", "owner"])
    own = handed.groupBy("paper", "owner").agg(F.max("moved").alias("given"), F.min(F.when(~F.col("moved"), place())).alias("own_start"))
    return spans.join(own.select("paper", "owner", F.when(F.col("given"), F.col("own_start")).alias("own_start")), ["paper", "owner"])


#: Side of a tile, and boxes of a tile that are compared pair by pair; a fuller tile is cut in four.
TILE, TILE_BOXES = 64.0, 32
EDGES = ("x0", "y0", "ex", "ey")


def tile_pairs(tiles: DataFrame, key: list[str]) -> DataFrame:
    """a_ and b_ columns of each two boxes of a tile that touch."""
    side = lambda p: tiles.select(*key, *(F.col(c).alias(f"{p}_{c}") for c in ("id", *EDGES)))
    return side("a").join(side("b").hint("merge"), key).where("a_id < b_id and a_x0 <= b_ex and b_x0 <= a_ex and a_y0 <= b_ey and b_y0 <= a_ey")


def crowd_links(tiles: DataFrame, key: list[str], side: float) -> DataFrame:
    """u, v for tiles narrower than any grown box: no box begins and ends in one, so each enters it from the left, leaves it to the right or crosses it, and likewise upright.

    Boxes of one such kind all touch, and have a link to their first. Kinds that differ in one direction are linked if their outermost boxes touch. Those that lie at opposite corners are gone through along x, with the nearest corner so far
    in hand: equal corners once, so that is a sort of what is left.
    """
    kind = lambda lo, hi, t: F.when(F.col(lo) > F.col(t) * side, "begins").when(F.col(hi) < (F.col(t) + 1) * side, "ends").otherwise("crosses")
    t = tiles.withColumns({"kx": kind("x0", "ex", "tx"), "ky": kind("y0", "ey", "ty")})
    box = F.struct("id", *EDGES)
    outer = t.groupBy(*key, "kx", "ky").agg(F.min("id").alias("least"), F.array(F.min_by(box, "x0"), F.min_by(box, "y0"), F.max_by(box, "ex"), F.max_by(box, "ey")).alias("boxes"))
    stars = t.join(outer.drop("boxes").hint("merge"), [*key, "kx", "ky"]).where("id <> least").select(F.col("id").alias("u"), F.col("least").alias("v"))
    across = tile_pairs(outer.select(*key, F.explode(F.array_distinct("boxes")).alias("b")).select(*key, "b.*"), key).select(F.col("a_id").alias("u"), F.col("b_id").alias("v"))
    left = F.col("kx") == "begins"
    down = (F.col("ky") == "begins") == left  # the corner looks along the other diagonal if not
    corners = t.where("kx <> 'crosses' and ky <> 'crosses'").select(*key, down.alias("down"), (~left).alias("late"), F.when(left, F.col("x0")).otherwise(F.col("ex")).alias("x"), F.when(F.col("ky") == "begins", F.col("y0")).otherwise(F.col("ey")).alias("y"), "id")
    corners = corners.groupBy(*key, "down", "late", "x", "y").agg(F.min("id").alias("id")).withColumn("y", F.when(F.col("down"), F.col("y")).otherwise(-F.col("y")))
    order = Window.partitionBy(*key, "down").orderBy("x", "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = corners.withColumn("near", F.min(F.when(~F.col("late"), F.struct("y", "id"))).over(order)).where(F.col("late") & (F.col("near.y") <= F.col("y")))
    return stars.unionByName(across).unionByName(met.select(F.col("id").alias("u"), F.col("near.id").alias("v")))


def touch_links(boxes: DataFrame, by: list[str], ident: str = "id", tol: float = 3, tile: float = TILE, most: int = TILE_BOXES) -> DataFrame:
    """u, v: links that connect boxes just as all pairs of boxes of one group that overlap, or lie within tol of each other both ways, would. boxes: by, ident, x0, y0, x1, y1; a box of no width or height is one; tol is above 0.

    A box is filed under each tile that it reaches, tol included. The pairs of a tile are compared, and a pair that meets in several tiles is given by one, that of the upper left corner of what the two share. A tile that a box fills
    gives a link from each other to the box, since it touches all of them. Any other tile with more than `most` boxes is cut in four, and the boxes are filed anew there, until tiles are narrower than tol, where crowd_links settles them:
    no crowded place pairs by its square. Boxes of one place count once.

    Spark takes what is exploded for as small as what it came from, so joins of boxes and tiles are merged by hint: none is sent to the driver to be broadcast.
    """
    grown = boxes.select(F.struct(*by).alias("g"), F.col(ident).alias("id"), *(F.col(c).cast("double").alias(c) for c in ("x0", "y0")), (F.col("x1").cast("double") + tol).alias("ex"), (F.col("y1").cast("double") + tol).alias("ey"))
    grown = grown.where("id is not null")
    one = cut(grown.groupBy("g", *EDGES).agg(F.min("id").alias("id")))
    out = [grown.withColumnRenamed("id", "u").join(one.withColumnRenamed("id", "v").hint("merge"), ["g", *EDGES]).where("u <> v").select("u", "v")]
    number = lambda c, side: F.floor(F.col(c) / side)
    tiles = one.select("*", F.explode(F.sequence(number("x0", tile), number("ex", tile))).alias("tx")).select("*", F.explode(F.sequence(number("y0", tile), number("ey", tile))).alias("ty"))
    key, side = ["g", "tx", "ty"], tile
    while True:
        fills = (F.col("x0") <= F.col("tx") * side) & (F.col("ex") >= (F.col("tx") + 1) * side) & (F.col("y0") <= F.col("ty") * side) & (F.col("ey") >= (F.col("ty") + 1) * side)
        kinds = tiles.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min(F.when(fills, F.col("id"))).alias("full")).where("n > 1")
        tiles = cut(tiles.join(kinds.hint("merge"), key))
        out.append(tiles.where("full is not null and id <> full").select(F.col("id").alias("u"), F.col("full").alias("v")))
        open_ = tiles.where("full is null")
        met = tile_pairs(open_.where(F.col("n") <= most), key)
        corner = (F.floor(F.greatest("a_x0", "b_x0") / side) == F.col("tx")) & (F.floor(F.greatest("a_y0", "b_y0") / side) == F.col("ty"))
        out.append(met.where(corner).select(F.col("a_id").alias("u"), F.col("b_id").alias("v")))
        crowded = open_.where(F.col("n") > most).drop("n", "full")
        if not crowded.limit(1).count():
            break
        if side < tol:
            out.append(crowd_links(crowded, key, side))
            break
        side /= 2
        half = lambda lo, hi, t, side=side: F.explode(F.sequence(F.greatest(number(lo, side), 2 * F.col(t)), F.least(number(hi, side), 2 * F.col(t) + 1)))
        tiles = crowded.withColumn("tx", half("x0", "ex", "tx")).withColumn("ty", half("y0", "ey", "ty"))
    return reduce(DataFrame.unionByName, out).distinct()


def touching_groups(boxes: DataFrame, by: list[str], ident: str = "id", tol: float = 3) -> DataFrame:
    """by, group (its smallest id), n, x0, y0, x1, y1: boxes that touch, be it through others, as one, with what they reach over. A box that touches none is a group of its own."""
    groups = components(touch_links(boxes, by, ident, tol))
    g = boxes.join(groups.hint("merge"), boxes[ident] == groups.node, "left").withColumn("group", F.coalesce("component", F.col(ident)))
    return g.groupBy(*by, "group").agg(F.count(F.lit(1)).alias("n"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


# Margins of a page, how far a clip may grow to take in a box that pokes out, and which boxes count.
PAGE_HEIGHT, HEADER_ZONE, FOOT_MARGIN, SIDES = 842.0, 55.0, 50.0, (40.0, 560.0)
GROW_DOWN, GROW_UP, SIDE_PAD, EDGE_PAD = 40.0, 20.0, 1.5, 2.0
WIDE_BOX, WIDE_FRAME, TALL_BOX = 20.0, 100.0, 700.0
#: Height of the strips of a page in which edges and boxes meet.
STRIP = 64.0
#: How far an edge moves at once and up to where, by whether it goes down; upwards positions are negative.
WAYS = {True: (GROW_DOWN, PAGE_HEIGHT - FOOT_MARGIN), False: (GROW_UP, -HEADER_ZONE)}


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends (doc, down, near, far; of each doc and way by falling near) with end, where an edge that moves to them comes to rest, and moves, how often it moves on from there.

    Positions of edges that go up are taken as negative, so both ways grow. An edge takes the farthest end that it can, and what is out of its reach is so for all edges behind it: a queue of ends in reach is all that is kept."""
    page, queue = None, deque()
    for b in batches:
        ends, moves = [], []
        for doc, down, near, far in zip(*(b.column(c).to_pylist() for c in ("doc", "down", "near", "far"))):
            if (doc, down) != page:
                page, queue = (doc, down), deque()
            reach, last = WAYS[down]
            at = min(near + EDGE_PAD, last)
            while queue and (queue[0][0] - at > reach or queue[0][1] >= at):
                queue.popleft()
            goes = at < last and queue and queue[0][0] > at
            ends.append(queue[0][2] if goes else at)
            moves.append(queue[0][3] + 1 if goes else 0)
            queue.append((near, far, ends[-1], moves[-1]))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.float64()), pa.array(moves, pa.int32())], names=[*b.schema.names, "end", "moves"])


def widened(clips: DataFrame, boxes: DataFrame) -> DataFrame:
    """clips (doc, clip, x0, y0, x1, y1) grown over boxes (doc, x0, y0, x1, y1) that poke out of them; rounds: how often a clip grew up or down.

    Sideways a clip takes in the boxes of over WIDE_BOX width that reach into its height. Down or up, an edge that cuts a box of at least WIDE_FRAME width moves to the box's end if that is near (GROW_DOWN, GROW_UP); it may cut another one there, so
    this goes on until no edge moves. Nothing grows beyond the margins. doc is a page; equal rows stay. clip: a key within doc.

    Where an edge goes from the end of a box doesn't depend on the clip. So the ends of each page, equal ones once, are settled in one pass along the page, whatever the rounds, and each edge is joined once, with the ends in its reach, by strips of a page.
    A page's ends go through one task as a stream, of which it keeps those in reach of one edge; clips and their edges are dealt by strips.
    """
    b = boxes.select("doc", *(F.col(c).cast("double").alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")))
    strips = lambda df, lo, hi: df.withColumn("strip", F.explode(F.sequence(F.floor(lo / STRIP), F.floor(hi / STRIP))))
    way = lambda down, **c: F.struct(F.lit(down).alias("down"), *((v if down else -v).alias(k) for k, v in c.items()))
    frames = b.where((F.col("bx1") - F.col("bx0") >= WIDE_FRAME) & (F.col("by1") - F.col("by0") <= TALL_BOX)).select("doc", "by0", "by1").repartition("doc")
    ends = frames.select("doc", F.explode(F.array(way(True, near=F.col("by1"), far=F.col("by0")), way(False, near=F.col("by0"), far=F.col("by1")))).alias("e")).groupBy("doc", "e.down", "e.near").agg(F.min("e.far").alias("far"))
    form = ends.withColumns({"end": F.lit(0.0), "moves": F.lit(0)}).schema
    rest = ends.sortWithinPartitions("doc", "down", F.desc("near")).mapInArrow(settled, form)
    reach, last = (F.when(F.col("down"), WAYS[True][i]).otherwise(WAYS[False][i]) for i in (0, 1))
    c = clips.select("doc", "clip", F.col("y0").cast("double").alias("y0"), F.col("y1").cast("double").alias("y1"))
    edges = c.select("doc", "clip", F.explode(F.array(way(False, y=F.col("y0")), way(True, y=F.col("y1")))).alias("e")).select("doc", "clip", "e.*").where(F.col("y") < last).withColumn("strip", F.floor(F.col("y") / STRIP))
    met = edges.join(strips(rest, F.greatest("far", F.col("near") - reach - 1), F.col("near")), ["doc", "down", "strip"]).where((F.col("far") < F.col("y")) & (F.col("y") < F.col("near")) & (F.col("near") - F.col("y") <= reach))
    best = lambda down: F.max(F.when(F.col("down") == F.lit(down), F.struct("near", "end", "moves")))
    upright = met.groupBy("doc", "clip").agg(best(False).alias("up"), best(True).alias("low"))
    wide = strips(b.where((F.col("bx1") - F.col("bx0") > WIDE_BOX) & (F.col("by1") - F.col("by0") < TALL_BOX) & (F.col("by1") >= HEADER_ZONE) & (F.col("by0") <= PAGE_HEIGHT - HEADER_ZONE)), F.col("by0"), F.col("by1"))
    side = strips(c, F.col("y0"), F.col("y1")).join(wide, ["doc", "strip"]).where("by1 > y0 and by0 < y1").groupBy("doc", "clip").agg((F.min("bx0") - SIDE_PAD).alias("left"), (F.max("bx1") + SIDE_PAD).alias("right"))
    x = clips.where("doc is not null and clip is not null").join(side, ["doc", "clip"], "left").join(upright, ["doc", "clip"], "left")
    x0, x1 = F.least(F.col("x0").cast("double"), F.greatest("left", F.lit(SIDES[0]))), F.greatest(F.col("x1").cast("double"), F.least("right", F.lit(SIDES[1])))
    grown = {"x0": F.when(F.col("left").isNull(), F.col("x0").cast("double")).otherwise(x0), "x1": F.when(F.col("right").isNull(), F.col("x1").cast("double")).otherwise(x1)}
    grown |= {"y0": F.coalesce(-F.col("up.end"), F.col("y0").cast("double")), "y1": F.coalesce("low.end", F.col("y1").cast("double"))}
    return x.withColumns(grown | {"rounds": F.coalesce(F.greatest(F.col("up.moves") + 1, F.col("low.moves") + 1), F.lit(0))}).select(*clips.columns, "rounds")


def without(intervals: DataFrame, taken: DataFrame, by: list[str], lo: str = "lo", hi: str = "hi") -> DataFrame:
    """by, lo, hi: what is left of intervals, as disjoint ones, where taken covers none of it. Both: by, lo, hi; intervals that touch are one, empty ones count for nothing.

    Ends of both sides are put in order and what is open at each is counted, so no interval is paired with another: a stretch between two ends that follow each other is left if one of the first and none of the second side is open."""
    def ends(df: DataFrame, a: int, b: int) -> DataFrame:
        e = F.array(*(F.struct(c.cast("double").alias("at"), F.lit(s * a).alias("a"), F.lit(s * b).alias("b")) for c, s in ((F.col(lo), 1), (F.col(hi), -1))))
        return df.where(F.col(lo) < F.col(hi)).select(*by, F.explode(e).alias("e")).select(*by, "e.*")

    every = ends(intervals, 1, 0).unionByName(ends(taken, 0, 1)).groupBy(*by, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy(*by).orderBy("at")
    open_ = every.select(*by, F.col("at").alias(lo), F.lead("at").over(w).alias(hi), F.sum("a").over(w).alias("a"), F.sum("b").over(w).alias("b"))
    return merged_intervals(open_.where("a > 0 and b = 0"), by, lo, hi).drop("n")


#: A gap above a question of more points than this holds a preamble.
LEAST_PREAMBLE = 24
#: Points kept above the first line of a page or of a preamble.
FIRST_PAD = 4


def preambles(questions: DataFrame, spans: DataFrame, lines: DataFrame) -> DataFrame:
    """paper, q, page, lo, hi, by: the scenario printed above a question. questions: paper, q, opening (null: none is known); spans: paper, q, page, top, bottom; lines: paper, page, top, text.

    With an opening, the preamble begins at the first line of the page that begins so (`words`); an opening that isn't found gives no row, rather than a wrong one. Without one, it is the gap above the question (`gap`): from the end of the
    question before on that page, else from the page's first line, if it is wider than LEAST_PREAMBLE. The first page of a question counts. Two kinds of key, one of which wins; each is a join on (paper, page).
    """
    first = spans.groupBy("paper", "q").agg(F.min(F.struct("page", "top")).alias("s")).select("paper", "q", "s.page", "s.top")
    at = questions.join(first, ["paper", "q"])
    known = at.where("opening is not null").join(lines.select("paper", "page", F.col("top").alias("__y"), F.trim("text").alias("__t")), ["paper", "page"]).where(F.startswith("__t", "opening"))
    by_words = known.groupBy("paper", "q", "page", "top").agg((F.min("__y") - FIRST_PAD).alias("lo")).select("paper", "q", "page", F.col("lo").cast("double").alias("lo"), F.col("top").cast("double").alias("hi"), F.lit("words").alias("by"))
    before = spans.groupBy("paper", (F.col("q") + 1).alias("q"), "page").agg(F.max("bottom").alias("__end"))
    top = lines.where(F.trim("text") != "").groupBy("paper", "page").agg((F.min("top") - FIRST_PAD).alias("__first"))
    gap = at.where("opening is null").join(before, ["paper", "q", "page"], "left").join(top, ["paper", "page"], "left")
    start = F.coalesce("__end", "__first", F.lit(0)).cast("double")
    by_gap = gap.select("paper", "q", "page", start.alias("lo"), F.col("top").cast("double").alias("hi"), F.lit("gap").alias("by")).where(F.col("hi") - F.col("lo") > LEAST_PREAMBLE)
    return by_words.unionByName(by_gap)


def drawn_rules(drawings: DataFrame) -> DataFrame:
    """The solid level and upright rules of drawings within their band, as boxes without width or height; the columns of drawings but those read here, and x0, y0, x1, y1. A row for each rule.

    drawings: top, bottom (of the band), dashed, stroked, x0, y0, x1, y1 (what the drawing reaches over), items: array of struct(kind, x0, y0, x1, y1), kind `l` for a line and `re` for a box. A thin filled box is a rule, a stroked one its four
    edges. Dashed strokes and what is as large as the page are left out, and so are rules of under 15 points across or 10 upright."""
    d = lambda c: F.col(c).cast("double")
    inside = (d("y1") >= d("top") - 1) & (d("y0") <= d("bottom") + 1) & ~F.coalesce("dashed", F.lit(False)) & ~((d("x1") - d("x0") > 560) & (d("y1") - d("y0") > 700))
    stroked = F.coalesce("stroked", F.lit(False))

    def segment(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))

    def of(i: Column) -> Column:
        left, right, up, down = F.least(i["x0"], i["x1"]), F.greatest(i["x0"], i["x1"]), F.least(i["y0"], i["y1"]), F.greatest(i["y0"], i["y1"])
        w, h = right - left, down - up
        line = F.when((h < 1) & (w > 15), F.array(segment(left, i["y0"], right, i["y0"]))).when((w < 1) & (h > 10), F.array(segment(i["x0"], up, i["x0"], down)))
        y, x = (up + down) / 2, (left + right) / 2
        edges = F.array(segment(left, up, right, up), segment(left, down, right, down), segment(left, up, left, down), segment(right, up, right, down))
        box = F.when((h <= 2) & (w > 15), F.array(segment(left, y, right, y))).when((w <= 2) & (h > 10), F.array(segment(x, up, x, down))).when((w > 15) & (h > 10) & stroked, edges)
        return F.coalesce(F.when(i["kind"] == "l", line).when(i["kind"] == "re", box), F.array().cast("array<struct<x0:double,y0:double,x1:double,y1:double>>"))

    kept = [c for c in drawings.columns if c not in ("top", "bottom", "dashed", "stroked", "x0", "y0", "x1", "y1", "items")]
    s = drawings.where(inside).select(*kept, "top", "bottom", F.explode(F.flatten(F.transform("items", of))).alias("s"))
    return s.where((F.col("s.y0") >= F.col("top") - 2) & (F.col("s.y1") <= F.col("bottom") + 2)).select(*kept, "s.*")


# How high and wide a grid is at least, the least height of its rows and width of its cells, the gap that makes a row empty, and the share of empty area that makes a grid one for answers.
GRID_HEIGHT, GRID_WIDTH, ROW_HEIGHT, CELL_WIDTH, EMPTY_GAP, EMPTY_SHARE = 12, 30, 12, 20, 30, 0.25


#: Rules of a page that are grouped within one row; those of a fuller page by tiles.
PAGE_RULES = 256


def grouped_in_row(boxes: Column, tol: float = 3) -> Column:
    """The groups of an array of boxes (id, x0, y0, x1, y1; sorted by id) that touch, be it through others: an array of struct(group, its smallest id, and rules, its boxes). Each box is put to the groups so far that it touches, which become one."""
    def touch(a: Column, b: Column) -> Column:
        near = [a[lo] <= b[hi] + tol for lo, hi in (("x0", "x1"), ("y0", "y1"))] + [b[lo] <= a[hi] + tol for lo, hi in (("x0", "x1"), ("y0", "y1"))]
        return F.coalesce((a["id"] == b["id"]) | reduce(lambda x, y: x & y, near), F.lit(False))

    def put(groups: Column, b: Column) -> Column:
        seen = F.transform(groups, lambda g: F.struct(F.exists(g["rules"], lambda a: touch(a, b)).alias("met"), g.alias("g")))

        def merged(seen: Column) -> Column:
            of = lambda met: F.transform(F.filter(seen, lambda s: s["met"] == F.lit(met)), lambda s: s["g"])
            one = F.struct(F.coalesce(F.array_min(F.transform(of(True), lambda g: g["group"])), b["id"]).alias("group"), F.concat(F.flatten(F.transform(of(True), lambda g: g["rules"])), F.array(b)).alias("rules"))
            return F.concat(of(False), F.array(one))

        return F.element_at(F.transform(F.array(seen), merged), 1)

    first = F.transform(F.slice(boxes, 1, 1), lambda b: F.struct(b["id"].alias("group"), F.array(b).alias("rules")))
    return F.aggregate(F.slice(boxes, 2, F.greatest(F.size(boxes), F.lit(1))), first, put)


def grids(rules: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """page, group, x0, y0, x1, y1, levels (the heights of its level rules, sorted), rows (those between two levels at least so far apart, as struct(a, b)), uprights (struct(x0, y0, y1)) and words (struct(y0, y1, cx); all of the page) of each grid of rules
    that touch.

    The rules of a page are one row, and so are its words: both are shuffled once, by page, and all else stays where it is. Only pages of over PAGE_RULES rules are grouped by tiles; they are counted first."""
    r = rules.where("page is not null and id is not null").select("page", "id", *(F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")))
    full = cut(r.groupBy("page").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PAGE_RULES).select("page"))
    crowded = bool(full.limit(1).count())
    few = r.join(full.hint("merge"), "page", "left_anti") if crowded else r
    box = F.struct("id", "x0", "y0", "x1", "y1")
    g = few.groupBy("page").agg(F.array_sort(F.collect_list(box)).alias("rules")).select("page", F.explode(grouped_in_row(F.col("rules"))).alias("g")).select("page", "g.group", "g.rules")
    if crowded:
        many = cut(r.join(full.hint("merge"), "page", "left_semi"))
        links = components(touch_links(many, ["page"]))
        found = many.join(links.hint("merge"), many.id == links.node, "left").select("page", F.coalesce("component", "id").alias("group"), box.alias("r"))
        g = g.unionByName(found.groupBy("page", "group").agg(F.collect_list("r").alias("rules")))
    of = lambda c, kept=None: F.transform(F.col("rules") if kept is None else F.filter("rules", kept), lambda x: x[c])
    level = F.array_sort(F.array_distinct(F.transform(of("y0", lambda x: x["y1"] - x["y0"] < 0.5), lambda y: F.round(y, 1))))
    upright = F.transform(F.filter("rules", lambda x: x["x1"] - x["x0"] < 0.5), lambda x: F.struct(x["x0"].alias("x0"), x["y0"].alias("y0"), x["y1"].alias("y1")))
    g = g.select("page", "group", *(f(of(c)).alias(c) for f, c in ((F.array_min, "x0"), (F.array_min, "y0"), (F.array_max, "x1"), (F.array_max, "y1"))), level.alias("levels"), upright.alias("uprights"))
    rows = F.filter(F.transform("levels", lambda a, i: F.struct(a.alias("a"), F.get("levels", i + 1).alias("b"))), lambda x: x["b"] - x["a"] >= least)
    g = g.withColumn("rows", rows).where(F.size("rows") > 0)
    d = lambda c: F.col(c).cast("double")
    w = words.where("page is not null").select("page", F.struct(d("y0").alias("y0"), d("y1").alias("y1"), ((F.col("x0") + F.col("x1")) / 2).cast("double").alias("cx")).alias("w"))
    w = w.groupBy("page").agg(F.collect_list("w").alias("words"))
    return g.join(w.hint("merge"), "page", "left").withColumn("words", F.coalesce("words", F.array().cast("array<struct<y0:double,y1:double,cx:double>>")))


def in_row(r: Column, wider: float = 0) -> Column:
    """The words of a grid whose middle lies in a row of it, sorted by height; wider: how far beyond its sides they may lie (0: strictly between them)."""
    def held(w: Column) -> Column:
        cy = (w["y0"] + w["y1"]) / 2
        across = (w["cx"] >= F.col("x0") - wider) & (w["cx"] <= F.col("x1") + wider) if wider else (w["cx"] > F.col("x0")) & (w["cx"] < F.col("x1"))
        return across & (cy > r["a"]) & (cy < r["b"])

    return F.array_sort(F.filter("words", held))


def blank_cells(r: Column) -> Column:
    """struct(l, r) of the cells of a row (a, b, held) without a word: between the upright rules that cross it and the sides of the grid."""
    crossing = F.transform(F.filter("uprights", lambda u: (u["y0"] <= r["a"] + 2) & (u["y1"] >= r["b"] - 2)), lambda u: u["x0"])
    xs = F.array_sort(F.array_distinct(F.concat(crossing, F.array("x0", "x1"))))
    cells = lambda xs: F.transform(xs, lambda x, i: F.struct(x.alias("l"), F.get(xs, i + 1).alias("r")))
    blank = lambda c: c["r"].isNotNull() & ~F.exists(r["held"], lambda w: (c["l"] < w["cx"]) & (w["cx"] < c["r"]))
    return F.filter(F.flatten(F.transform(F.array(xs), cells)), blank)


def answer_grids(rules: DataFrame, words: DataFrame) -> DataFrame:
    """page, group, x0, y0, x1, y1, empties, height, is_space: grids of touching rules, with how many of their cells are empty, the height of the rows that hold them, and whether the grid is a space for answers: two empty cells or more, that
    make up EMPTY_SHARE of its area. rules: page, id (a key), x0, y0, x1, y1 (without width or height); words: page, x0, y0, x1, y1.

    Rows lie between the level rules of a grid, cells between the upright ones that cross a row. A row without a word, or with a gap of EMPTY_GAP above, between or below its words, is empty as a whole and counts for two. A grid with its rows and the
    words of its page is one row (see grids); words are placed by their middle.
    """
    g = grids(rules, words, ROW_HEIGHT).where((F.col("y1") - F.col("y0") >= GRID_HEIGHT) & (F.col("x1") - F.col("x0") >= GRID_WIDTH))

    def empty(r: Column) -> Column:
        start = F.struct(r["a"].alias("reach"), F.lit(0.0).alias("gap"))
        gap = F.aggregate(r["held"], start, lambda s, w: F.struct(F.greatest(s["reach"], w["y1"]).alias("reach"), F.greatest(s["gap"], w["y0"] - s["reach"]).alias("gap")), lambda s: F.greatest(s["gap"], r["b"] - s["reach"]))
        return (F.size(r["held"]) == 0) | (gap >= EMPTY_GAP)

    def sums(r: Column) -> Column:
        high = r["b"] - r["a"]
        cells = F.filter(blank_cells(r), lambda c: c["r"] - c["l"] > CELL_WIDTH)
        area = lambda cells: F.aggregate(cells, F.lit(0.0), lambda s, c: s + (c["r"] - c["l"]) * high)
        some = F.element_at(F.transform(F.array(cells), lambda c: F.struct(F.size(c).cast("long").alias("n"), area(c).alias("area"), high.alias("height"))), 1)
        return F.when(empty(r), F.struct(F.lit(2).cast("long").alias("n"), (high * (F.col("x1") - F.col("x0"))).alias("area"), high.alias("height"))).otherwise(some)

    g = g.withColumn("rows", F.transform("rows", lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), in_row(r, 1).alias("held"))))
    g = g.withColumn("rows", F.filter(F.transform("rows", sums), lambda s: s["n"] > 0)).where(F.size("rows") > 0)
    total = lambda c, kind: F.aggregate("rows", F.lit(0).cast(kind), lambda s, r: s + r[c])
    g = g.withColumns({"empties": total("n", "long"), "area": total("area", "double"), "height": total("height", "double")})
    space = (F.col("empties") >= 2) & (F.col("area") >= EMPTY_SHARE * (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    return g.select("page", "group", "x0", "y0", "x1", "y1", "empties", "height", space.alias("is_space"))


def answer_space(grids: DataFrame) -> DataFrame:
    """page, height: the writing space that the grids of a page draw."""
    return grids.where("is_space").groupBy("page").agg(F.sum("height").alias("height"))


# The least width of a tick table, its least levels, the least height of its rows and width of a box to tick, and the rows that need one.
TICK_WIDTH, TICK_LEVELS, TICK_ROW, TICK_BOX, TICK_ROWS = 100, 3, 10, 12, 2


def tick_tables(rules: DataFrame, words: DataFrame) -> DataFrame:
    """page, group, ticks: grids in which two rows or more have words and, beside them, an empty box; ticks is how many. rules and words as for answer_grids.

    A box lies between two upright rules that cross its row, or the sides of the grid. Such tables are spaces for answers, however little of their area is empty.
    """
    g = grids(rules, words, TICK_ROW).where((F.col("x1") - F.col("x0") >= TICK_WIDTH) & (F.size("levels") >= TICK_LEVELS))
    g = g.withColumn("rows", F.transform("rows", lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), in_row(r).alias("held"))))
    ticks = F.filter("rows", lambda r: (F.size(r["held"]) > 0) & F.exists(blank_cells(r), lambda c: c["r"] - c["l"] >= TICK_BOX))
    return g.select("page", "group", F.size(ticks).cast("long").alias("ticks")).where(F.col("ticks") >= TICK_ROWS)


# Lines of dots, words that tell to write on a figure, the size of such a figure, the lowest part of a page, where text begins, the least height of an image and the points kept above what comes next.
DOTS = r"([.·…][ \t\n]?){20,}|^[.·…\t\n ]{12,}$"
FILL_IN = r"^([0-9]{1,2}[ ]+)?(\(([a-h]|[ivx]{1,4})\) *)*(Complete|Draw|Label|Plot|Sketch|Fill in)($|[^\p{L}\p{N}_])"
FIGURE_WIDTH, FIGURE_HEIGHT, FIGURE_MOST = 60, 40, 700
FOOTER_ZONE, LEFT, IMAGE_HEIGHT, BLANK_PAD = 60, 45, 5, 6


def in_band(df: DataFrame, bands: DataFrame) -> DataFrame:
    """df (page, top, bottom and others) with the bands (band, page, top, bottom) that each row reaches into."""
    b = bands.select("band", F.col("page").alias("__page"), F.col("top").alias("__top"), F.col("bottom").alias("__bottom"))
    return df.join(b, (F.col("page") == F.col("__page")) & (F.col("bottom") > F.col("__top")) & (F.col("top") < F.col("__bottom")))


def ruled_lines(bands: DataFrame, lines: DataFrame, figures: DataFrame, spaces: DataFrame) -> DataFrame:
    """band, lines: how many ruled lines an answer needs: 0 if no marks are printed, null where the paper has a space of its own. bands: band, page, top, bottom; lines: page, top, bottom, text; figures: page, x0, top, x1, bottom; spaces: band, of
    those with a grid or tick table (answer_grids, tick_tables; a band can be given once for each).

    A space of its own is also a line of dots, or a figure in a band with a line that says to complete or draw one. Else the marks are the most that one line prints first, and lines are as answer_lines has them.
    """
    text = F.trim(F.regexp_replace("text", r"[ \t\n]+", " "))
    mark = F.regexp_extract(text, r"\[([0-9]{1,2})\]", 1)
    facts = in_band(lines, bands).groupBy("band").agg(F.max(F.trim("text").rlike(DOTS)).alias("dots"), F.max(F.nullif(mark, F.lit("")).cast("int")).alias("marks"), F.max(text.rlike(FILL_IN)).alias("told"))
    wide, high = F.col("x1") - F.col("x0"), F.col("bottom") - F.col("top")
    shown = in_band(figures.where((wide >= FIGURE_WIDTH) & (high >= FIGURE_HEIGHT) & (high < FIGURE_MOST)), bands).select("band").distinct().withColumn("figure", F.lit(True))
    given = spaces.select("band").distinct().withColumn("space", F.lit(True))
    x = bands.select("band").distinct().join(facts, "band", "left").join(shown, "band", "left").join(given, "band", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    own = yes("dots") | yes("space") | (yes("told") & yes("figure"))
    return x.select("band", F.when(~own, F.when(F.col("marks") > 0, answer_lines(F.col("marks"))).otherwise(0)).alias("lines"))


def trailing_blank(bands: DataFrame, lines: DataFrame, images: DataFrame, page_height: float) -> DataFrame:
    """band, blank: the height of the empty paper below each band, down to the next line, the next image or the footer of its page. bands: band, page, bottom; lines: page, x0, top, bottom, text; images: page, top, bottom.

    Footers are what noise says in the lowest part of a page; without one a page ends a third of that part above its edge. Blank lines, lines left of the text and noise count for nothing, and so does a line of over 60 points.
    """
    kept = lines.where((F.trim("text") != "") & (F.col("bottom") - F.col("top") <= 60))
    idle = noise(F.trim("text"), F.col("bottom") - F.col("top"), F.col("bottom"), F.lit(page_height))
    kept = cut(kept.select("page", "x0", "top", F.col("bottom").alias("__b"), idle.alias("idle")))
    foot = kept.where((F.col("__b") > page_height - FOOTER_ZONE) & F.col("idle")).groupBy("page").agg(F.min("top").cast("double").alias("foot"))
    starts = kept.where((F.col("x0") >= LEFT) & ~F.col("idle")).select("page", F.col("top").alias("y")).unionByName(images.where(F.col("bottom") - F.col("top") >= IMAGE_HEIGHT).select("page", F.col("top").alias("y")))
    near = bands.select("band", "page", "bottom").join(starts, "page").where(F.col("y") > F.col("bottom") + 1).groupBy("band", "page").agg(F.min("y").cast("double").alias("next"))
    x = bands.select("band", "page", "bottom").join(near, ["band", "page"], "left").join(foot, "page", "left")
    end = F.least(F.coalesce("foot", F.lit(page_height - FOOTER_ZONE / 3)), F.col("next"))
    return x.select("band", F.greatest(F.lit(0.0), end - F.col("bottom") - BLANK_PAD).alias("blank"))
