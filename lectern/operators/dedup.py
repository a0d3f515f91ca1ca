"""Exact and near duplicates of units and papers."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import bucket_key
from lectern.operators.graphs import cut
from lectern.operators.joins import small

#: Characters of the texts of a block, about: a bucket with more is dealt over blocks, which are compared two by two.
BLOCK_CHARS = 4_000_000
#: Kinds of characters that a text's profile counts, and characters of the grams by which texts are told apart.
PROFILE, GRAM = 64, 6


def folded(units: DataFrame, key: list[Column], order: Column, ident: str) -> DataFrame:
    """units with dupe_of (the first of the same key, for the others) and also_in (for the first: how many others there are; null where there are none). A null or empty part of the key is no duplicate of anything.

    The first is a minimum, partially aggregated, and joined back, so a key that very many rows have meets in no row; `reprints` has the others row by row.
    """
    k = {f"__k{i}": c for i, c in enumerate(key)}
    u = units.withColumns(k | {"__o": order})
    usable = F.lit(True)
    for c in k:
        usable = usable & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    u = u.withColumn("__ok", usable)
    g = u.where("__ok").groupBy(*k).agg(F.min(F.struct("__o", F.col(ident).alias("__id"))).alias("__f"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    j = u.join(g.select(*k, F.col("__f.__id").alias("__first"), "__n"), list(k), "left")
    same = F.col(ident) == F.col("__first")
    out = j.withColumns({"dupe_of": F.when(F.col("__ok") & ~same, F.col("__first")), "also_in": F.when(F.col("__ok") & same, F.col("__n") - 1)})
    return out.select(*units.columns, "dupe_of", "also_in")


def reprints(units: DataFrame, key: list[Column], order: Column, ident: str) -> DataFrame:
    """keeper, reprint: a row for each unit that is folded into another."""
    return folded(units, key, order, ident).where("dupe_of is not null").select(F.col("dupe_of").alias("keeper"), F.col(ident).alias("reprint"))


def duplicate_papers(blocks: DataFrame, by: list[str]) -> DataFrame:
    """paper, first: papers whose sorted block texts (first 200 characters, single-spaced) equal those of the first such paper of the same group. blocks: by, paper, text."""
    head = F.substring(F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")), 1, 200)
    f = blocks.groupBy(*by, "paper").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(head)), "\u0001").cast("binary"), 256).alias("print"))
    first = f.groupBy(*by, "print").agg(F.min("paper").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return f.join(first, [*by, "print"]).where("paper <> first").select("paper", "first")


def repeats(units: DataFrame, key: Column, sitting: list[str], least: int = 2) -> DataFrame:
    """key, n, latest: wordings that at least so many distinct sittings have. Empty keys are left out."""
    u = units.select(key.alias("key"), F.struct(*sitting).alias("s")).where("key <> ''")
    return u.groupBy("key").agg(F.count_distinct("s").alias("n"), F.max("s").alias("latest")).where(F.col("n") >= least)


class Alike:
    """The similarity of texts to one text b, as SequenceMatcher(None, a, b).ratio() gives it, ended where it can't be over a bound any more.

    Matching blocks don't depend on the order in which the stretches between them are gone through, so the widest comes first, and each open stretch counts as matched as far as it could be: unlike texts are told after a few blocks.
    A block grows from the longest run of characters that aren't frequent in b (else from where both stretches begin), so only such runs of a are looked at.
    """

    def __init__(self, b: str):
        self.b, self.at = b, {}
        for j, c in enumerate(b):
            self.at.setdefault(c, []).append(j)
        if len(b) >= 200:  # the library's rule for very frequent characters
            self.at = {c: js for c, js in self.at.items() if len(js) <= len(b) // 100 + 1}
        self.runs = re.compile(f"[{''.join(map(re.escape, self.at))}]+") if self.at else None

    def block(self, a: str, runs: list[tuple[int, int]], alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
        """The longest matching block of two stretches, the first in a and then in b of equal ones: its places and length."""
        i0, j0, n0 = alo, blo, 0
        for lo, hi in runs[bisect_right(runs, alo, key=lambda r: r[1]) : bisect_left(runs, (ahi,))]:
            lo, hi, lengths = max(lo, alo), min(hi, ahi), {}
            if hi - lo <= n0:
                continue
            for i in range(lo, hi):
                js, ends = self.at[a[i]], lengths
                lengths = {}
                for j in js[bisect_left(js, blo) : bisect_left(js, bhi)]:
                    n = lengths[j] = ends.get(j - 1, 0) + 1
                    if n > n0:
                        i0, j0, n0 = i - n + 1, j - n + 1, n
        while i0 > alo and j0 > blo and a[i0 - 1] == self.b[j0 - 1]:
            i0, j0, n0 = i0 - 1, j0 - 1, n0 + 1
        while i0 + n0 < ahi and j0 + n0 < bhi and a[i0 + n0] == self.b[j0 + n0]:
            n0 += 1
        return i0, j0, n0

    def ratio(self, a: str, more_than: float) -> float | None:
        """The similarity of a, or null if it isn't over more_than."""
        whole = len(a) + len(self.b)
        if not whole:
            return 1.0 if more_than < 1 else None
        runs = [m.span() for m in self.runs.finditer(a)] if self.runs else []
        most = min(len(a), len(self.b))
        open_ = [(-most, 0, len(a), 0, len(self.b))]
        while open_ and 2.0 * most / whole > more_than:
            m, alo, ahi, blo, bhi = heappop(open_)
            i, j, n = self.block(a, runs, alo, ahi, blo, bhi)
            most += m + n
            for rest in ((alo, i, blo, j), (i + n, ahi, j + n, bhi)) if n else ():
                m = min(rest[1] - rest[0], rest[3] - rest[2])
                if m:
                    most += m
                    heappush(open_, (-m, *rest))
        r = 2.0 * most / whole
        return r if r > more_than else None


def ratio(a: Column, b: Column, more_than: float | None = None) -> Column:
    """Ratcliff-Obershelp similarity of two texts, as the standard library computes it (with its rule for very frequent characters; not symmetric). It has no built-in form.

    more_than: null for pairs that aren't more alike than that; most of these are told early (see Alike). What is prepared of a text b serves all rows with it that follow each other."""

    @F.arrow_udf("double")
    def similarity(x: pa.Array, y: pa.Array) -> pa.Array:
        out, last = [], None
        for p, q in zip(x.to_pylist(), y.to_pylist()):
            if p is None or q is None:
                out.append(None)
            elif more_than is None:
                out.append(SequenceMatcher(None, p, q).ratio())
            else:
                last = last if last and last.b == q else Alike(q)
                out.append(last.ratio(p, more_than))
        return pa.array(out, pa.float64())

    return similarity(a, b)


class Block:
    """Texts by rising length, with what shows how much two of them can have in common at most: how often characters of each of PROFILE kinds (code point modulo PROFILE) occur, how often those among them that the library takes for a text's own (see Alike),
    and the grams of GRAM characters, each numbered by how often the text had it before, so that a text's are a set."""

    def __init__(self, ids: list, lo: list, hi: list, texts: list[str]):
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        self.ids, self.lo, self.hi, self.texts = ([c[i] for i in order] for c in (ids, lo, hi, texts))
        self.n = np.array([len(t) for t in self.texts], np.int64)
        self.profile, self.rare = np.zeros((2, len(order), PROFILE), np.int32)
        grams = [np.zeros(0, np.uint64)]
        for i, t in enumerate(self.texts):
            codes = np.frombuffer(t.encode("utf-32-le"), np.uint32)
            kinds, counts = np.unique(codes, return_counts=True)
            own = counts <= len(t) // 100 + 1 if len(t) >= 200 else np.ones(len(kinds), bool)
            self.profile[i] = np.bincount(kinds % PROFILE, counts, PROFILE)
            self.rare[i] = np.bincount(kinds[own] % PROFILE, counts[own], PROFILE)
            h = np.zeros(max(len(t) - GRAM + 1, 0), np.uint64)
            for k in range(GRAM):
                h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + len(h)]
            h = np.sort((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(24))
            new = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)))
            grams.append(h << np.uint64(24) | (np.arange(len(h)) - np.repeat(new, np.diff(new, append=len(h)))).astype(np.uint64))
        self.ends = np.cumsum([len(g) for g in grams])
        self.grams = np.concatenate(grams)


def alike_pairs(left: Block, right: Block, more_than: float) -> Iterator[tuple[object, object, float]]:
    """(a, b, similarity) for each text of left and each of right (of one block: each two texts) of different papers that are more alike than more_than; a is the smaller id.

    What two texts match in is no more than the characters that both have. Nor is it more than the grams that both have and GRAM - 1 for each matching block, and there is one block at most for each character of b's own that both have, and one where
    both texts begin: a block grows from such a character, or else from where both stretches begin, and but for the first these begin with unlike characters. So nearly all unlike pairs are told by counting, without going through their texts."""
    if not len(left.ids) or not len(right.ids):
        return
    known, at = np.unique(right.grams, return_inverse=True)
    at, seen = at.astype(np.intp), np.zeros(len(known) + 1, np.uint8)
    code = {p: i for i, p in enumerate({p for b in (left, right) for c in (b.lo, b.hi) for p in c if p is not None})}
    papers = lambda ps: np.array([code.get(p, -1) for p in ps])
    rlo = papers(right.lo)
    several, llo, lseveral = rlo != papers(right.hi), papers(left.lo), papers(left.lo) != papers(left.hi)
    place = {x: i for i, x in enumerate(sorted({*left.ids, *right.ids}))}
    lid, rid = (np.array([place[x] for x in b.ids]) for b in (left, right))
    found: list[tuple[int, int]] = []
    for i in range(len(left.ids)):
        n = left.n[i]
        lo, hi = np.searchsorted(right.n, n * more_than / (2 - more_than) - 1), np.searchsorted(right.n, n * (2 - more_than) / more_than + 1)
        lo = max(lo, i + 1) if left is right else lo
        if lo >= hi:
            continue
        js = np.arange(lo, hi)
        js = js[(rid[lo:hi] != lid[i]) & (several[lo:hi] | lseveral[i] | ((rlo[lo:hi] != llo[i]) & (rlo[lo:hi] >= 0) & (llo[i] >= 0)))]
        js = js[2.0 * np.minimum(left.profile[i], right.profile[js]).sum(1) > more_than * (n + right.n[js])]
        if not len(js):
            continue
        own = np.where(lid[i] < rid[js], np.minimum(left.profile[i], right.rare[js]).sum(1), np.minimum(left.rare[i], right.profile[js]).sum(1))
        open_ = 2.0 * ((GRAM - 1) * (own + 1) + np.minimum(right.n[js], n)) > more_than * (n + right.n[js])
        js, own = js[open_], own[open_]
        g = left.grams[left.ends[i] : left.ends[i + 1]]
        where = np.searchsorted(known, g)
        where = where[known[np.minimum(where, len(known) - 1)] == g] if len(known) else where[:0]
        seen[where] = 1
        if 4 * len(js) < hi - lo:
            both = np.array([np.count_nonzero(seen.take(at[right.ends[j] : right.ends[j + 1]])) for j in js], np.int64)
        else:
            sums = np.concatenate([[0], np.cumsum(seen.take(at[right.ends[lo] : right.ends[hi]]), dtype=np.int32)])
            both = np.diff(sums[right.ends[lo : hi + 1] - right.ends[lo]])[js - lo]
        seen[where] = 0
        found += [(int(j), i) for j in js[2.0 * (both + (GRAM - 1) * (own + 1)) > more_than * (n + right.n[js])]]
    pairs = [((right, j), (left, i)) if lid[i] < rid[j] else ((left, i), (right, j)) for j, i in found]
    last = None
    for (y, j), (x, i) in sorted(pairs, key=lambda p: (p[0][0] is left, p[0][1])):
        last = last if last and last.b == y.texts[j] else Alike(y.texts[j])
        r = last.ratio(x.texts[i], more_than)
        if r is not None:
            yield x.ids[i], y.ids[j], r


def near_duplicates(units: DataFrame, ident: str, paper: str, text: str, *, more_than: float = 0.55, least_chars: int = 31) -> DataFrame:
    """a, b, similarity (three decimals), kind. `pair`: two texts, each by the smallest id that has it (a < b), of different papers, that share their first three words and are more alike than more_than.
    `copy`: b has the very text of a, the smallest id that has it. So equal texts meet others once and no holder is lost. Whole texts are compared; those under least_chars are left out.

    Texts meet within a bucket (three words). A bucket of over BLOCK_CHARS is dealt over blocks by bands of length: a pair that is alike enough differs in length by a factor of (2 - more_than) / more_than at most, that is by one band. Each two blocks
    that may have such pairs meet in one group of rows, so a text is shuffled once for each block that its own meets, and not for each pair.
    """
    own = units.where(F.length(text) >= least_chars).select(F.col(ident).alias("id"), F.col(paper).alias("paper"), F.col(text).alias("text"))
    keyed = own.withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    firsts = keyed.groupBy("key").agg(F.min("id").alias("rep"))
    band = F.floor(F.log(F.length("text").cast("double")) / F.log(F.lit((2 - more_than) / more_than)))
    facts = [F.length("text").alias("n"), bucket_key(F.col("text")).alias("bucket"), band.alias("band")]
    bands = keyed.select("key", *facts).distinct().groupBy("bucket", "band").agg(F.sum("n").alias("n"))
    salts = F.ceil(F.col("n") / BLOCK_CHARS)
    full = bands.groupBy("bucket").agg(F.sum("n").alias("whole"), F.map_from_entries(F.collect_list(F.struct("band", salts))).alias("salts")).where(F.col("whole") > BLOCK_CHARS).drop("whole")  # one for each BLOCK_CHARS of text at most
    texts = own.groupBy("text").agg(F.min("id").alias("rep"), F.min("paper").alias("lo"), F.max("paper").alias("hi")).select("rep", "lo", "hi", "text", *facts[1:]).join(small(cut(full)), "bucket", "left")
    block = lambda b, s: F.struct(b.cast("long").alias("band"), s.cast("long").alias("salt"))
    mine = F.when(F.col("salts").isNull(), block(F.lit(0), F.lit(0))).otherwise(block(F.col("band"), F.pmod(F.xxhash64("text"), F.col("salts")[F.col("band")])))
    near = F.filter(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1), lambda b: F.map_contains_key("salts", b))
    met = F.when(F.col("salts").isNull(), F.array(block(F.lit(0), F.lit(0)))).otherwise(F.flatten(F.transform(near, lambda b: F.transform(F.sequence(F.lit(0).cast("long"), F.element_at("salts", b) - 1), lambda s: block(b, s)))))
    x = texts.withColumn("mine", mine).withColumn("met", F.explode(met))
    of = F.concat_ws(" ", *(F.format_string("%d %d", m["band"], m["salt"]) for m in (F.least("mine", "met"), F.greatest("mine", "met"))), "bucket").alias("of")
    x = x.select(of, (F.col("mine") != F.col("met")).alias("two"), (F.col("mine") > F.col("met")).alias("second"), "rep", "lo", "hi", "text")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(rows: list[tuple]) -> pa.RecordBatch:
            sides = [[r[3:] for r in rows if r[2] == second] for second in (False, True)]
            one, other = (Block(*(zip(*side) if side else ((),) * 4)) for side in sides)
            got = list(alike_pairs(one, other if rows[0][1] else one, more_than)) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], t) for k, t in enumerate((form, form, pa.float64()))], names=["a", "b", "s"])

        rows: list[tuple] = []
        for b in batches:
            form = b.schema.field("rep").type
            for row in zip(*(b.column(c).to_pylist() for c in ("of", "two", "second", "rep", "lo", "hi", "text"))):
                if rows and rows[0][0] != row[0]:
                    if len(rows) > 1:
                        yield pairs(rows)
                    rows = []
                rows.append(row)
        if len(rows) > 1:
            yield pairs(rows)

    tasks = 4 * int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # two full blocks cost far more than they weigh, so small tasks aren't put together
    s = x.repartition(tasks, "of").sortWithinPartitions("of").mapInArrow(compared, x.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(0.0).alias("s")).schema)
    pairs = s.select("a", "b", F.round("s", 3).alias("similarity"), F.lit("pair").alias("kind"))
    copies = keyed.select("key", "id").join(firsts, "key").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"), F.lit("copy").alias("kind"))
    return pairs.unionByName(copies)
