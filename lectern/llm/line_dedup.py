"""Line deduplication by pairwise alignment of overlapping documents."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_128_digest

from lectern.llm.common import durable, free_name, stored

#: Words of a block that is deleted, at least.
MIN_WORDS = 3
#: Texts that hold a rare run of lines, at most: all their pairs are aligned first.
RARE_HOLDERS = 4
#: How many times as many holders of a frequent run are tried from one round to the next.
ROUND_GROWTH = 8
LINES = "array<struct<hash:binary,at:int,words:int>>"


def numbered_lines(text: str | None) -> list[tuple[bytes, int, int]]:
    """(hash, place, words) of the lines of a text that have a word; places count these lines. A line's hash is of the line and of how often the text had it before, so that each hash occurs once in a text."""
    seen: Counter[str] = Counter()
    out = []
    for line in (text or "").split("\n"):
        if words := len(line.encode().split()):
            out.append((xxh3_128_digest(f"{seen[line]}\n{line}".encode()), len(out), words))
            seen[line] += 1
    return out


def patience(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises on both sides, by patience sorting. No place occurs twice on a side."""
    ordered = sorted(pairs)
    tops: list[int] = []
    piles: list[int] = []
    below: list[int] = []
    for k, (_, b) in enumerate(ordered):
        pile = bisect_left(tops, b)
        below.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            piles.append(k)
        else:
            tops[pile], piles[pile] = b, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(ordered[k])
        k = below[k]
    return out[::-1]


def deleted_places(shared: Iterable[tuple[int, int, tuple, int]], min_words: int) -> list[int]:
    """Places of a document's lines that go. shared: (place, words, partner, place in the partner) for each line with an earlier holder. Of each partner's alignment, blocks of lines that follow each other on both sides go if they have min_words words."""
    by_partner: dict[tuple, dict[int, int]] = defaultdict(dict)
    words = {}
    for at, n, partner, there in shared:
        by_partner[partner][at] = there
        words[at] = n
    gone: set[int] = set()
    for pairs in by_partner.values():
        block: list[tuple[int, int]] = []
        for pair in [*patience(pairs.items()), (-9, -9)]:
            if block and pair != (block[-1][0] + 1, block[-1][1] + 1):
                if sum(words[a] for a, _ in block) >= min_words:
                    gone.update(a for a, _ in block)
                block = []
            block.append(pair)
    return sorted(gone)


def without_places(text: str | None, places: list[int] | None) -> str | None:
    """A text less the lines with a word at these places. If no line with a word is left, the empty text."""
    if text is None or not places:
        return text
    gone, n, out, left = set(places), 0, [], False
    for line in text.split("\n"):
        if line.encode().split():
            if n not in gone:
                out.append(line)
                left = True
            n += 1
        else:
            out.append(line)
    return "\n".join(out) if left else ""


def least_runs(lines: list[tuple[bytes, int, int]], min_words: int) -> list[tuple[bytes, int, int]]:
    """(hash, first place, last place) of the shortest runs of lines with min_words words that begin at a line and that end at one, of lines in order that follow each other wherever their places do. A block of so many words is made of such runs."""
    runs = set()
    begins = [k for k in range(len(lines)) if not k or lines[k][1] != lines[k - 1][1] + 1]
    for lo, hi in zip(begins, [*begins[1:], len(lines)]):
        total = [0, *accumulate(n for _, _, n in lines[lo:hi])]
        for i in range(hi - lo):
            j = bisect_left(total, total[i] + max(1, min_words))
            if j < len(total):
                runs.add((lo + i, lo + j))
            k = bisect_right(total, total[i + 1] - max(1, min_words)) - 1
            if k >= 0:
                runs.add((lo + k, lo + i + 1))
    return [(xxh3_128_digest(b"".join(h for h, _, _ in lines[i:j])), lines[i][1], lines[j - 1][1]) for i, j in sorted(runs)]


def structs(rows: Iterable[list[tuple]], kind: dict[str, pa.DataType]) -> pa.ListArray:
    """An array of lists of structs from the tuples of each row, put together by columns: a dict for each struct would take many times its size, and long texts have very many lines."""
    stops, parts = [0], [[pa.array([], t)] for t in kind.values()]
    for row in rows:
        stops.append(stops[-1] + len(row))
        for part, column, t in zip(parts, zip(*row), kind.values()):
            part.append(pa.array(column, t))
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.StructArray.from_arrays([pa.concat_arrays(p) for p in parts], names=list(kind)))


def tuples(lists: pa.ListArray, *names: str) -> Iterable[Iterable[tuple]]:
    """The structs of each row as tuples of the fields named; those of one row at a time."""
    for row in lists:
        yield zip(*(row.values.field(n).to_pylist() for n in names))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def numbered(runs: DataFrame) -> DataFrame:
    """runs with n, how many texts hold a run, and nth, how many earlier ones do (by id, then key). Only runs of two texts or more stay.

    The holders of a run are numbered along one sorted order over all runs, range by range, so that a run which a third of all texts hold needs no task of its own.
    """
    order = ["run", "id", "key"]
    often = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ranged = durable(runs.join(often, "run")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = durable(ranged.withColumn("m", F.monotonically_increasing_id())).withColumn("range", F.shiftright("m", 33))
    parts = ranged.groupBy("run", "range").agg(F.min("m").alias("low"), F.count(F.lit(1)).alias("c"))
    before = F.sum("c").over(Window.partitionBy("run").orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("run", "range", (F.coalesce(before, F.lit(0)) - F.col("low")).alias("shift"))
    return ranged.join(parts, ["run", "range"]).select("run", "key", "start", "stop", "n", (F.col("m") + F.col("shift")).alias("nth"))


def aligned_blocks(pairs: DataFrame, lines: DataFrame, min_words: int) -> DataFrame:
    """(key, at): lines in common blocks of the alignment of each pair, on all lines that both have. pairs: key, pkey (the earlier text); lines: key, hash, at, words."""

    @F.arrow_udf("array<int>")
    def align(shared: pa.Array) -> pa.Array:
        return pa.array([deleted_places(((at, words, (), there) for at, words, there in r), min_words) for r in tuples(shared, "at", "words", "there")], pa.list_(pa.int32()))

    theirs = lines.select(F.col("key").alias("pkey"), "hash", F.col("at").alias("there"))
    shared = pairs.join(lines, "key").join(theirs, ["pkey", "hash"])
    return shared.groupBy("key", "pkey").agg(F.collect_list(F.struct("at", "words", "there")).alias("s")).select("key", F.explode(align("s")).alias("at"))


def all_alignments(lines: DataFrame, min_words: int) -> DataFrame:
    """(key, gone): for each text, the places that aligning it with every earlier text would delete. lines: id, key, hash, at, words, of lines that two texts or more have.

    A block that goes is made of shortest runs of min_words words (least_runs), and its partner holds them too, so runs nominate the pairs. Rare runs, of RARE_HOLDERS texts at most, nominate all pairs of their holders. What these
    alignments leave of frequent runs then nominates: first the earliest holder and the last one before, and, as long as a line of the run is left, the next 7, 56... holders. A run of which every earlier holder was tried stays in any
    alignment, and one whose lines have gone needs no more, so the result is that of all pairs, while the number of alignments is in proportion to the lines unless texts hold the same lines in as many different orders.
    """

    @F.arrow_udf("array<struct<run:binary,start:int,stop:int>>")
    def runs_of(own: pa.Array) -> pa.Array:
        rows = (sorted(r, key=lambda x: x[1]) for r in tuples(own, "hash", "at", "words"))
        return structs((least_runs(d, min_words) for d in rows), {"run": pa.binary(), "start": pa.int32(), "stop": pa.int32()})

    per_text = lines.groupBy("id", "key").agg(F.collect_list(F.struct("hash", "at", "words")).alias("l"))
    runs = durable(numbered(per_text.select("id", "key", F.explode(runs_of("l")).alias("r")).select("id", "key", "r.*")))
    lines = lines.drop("id")
    holders = runs.select("run", F.col("key").alias("pkey"), F.col("nth").alias("pnth"))
    left = runs.where("nth > 0")
    rare = left.where(F.col("n") <= RARE_HOLDERS).join(holders, "run").where("pnth < nth").select("key", "pkey").distinct()
    gone = durable(aligned_blocks(rare, lines, min_words).distinct())
    left, low = left.where(F.col("n") > RARE_HOLDERS), 0
    while True:
        cut = gone.groupBy("key").agg(F.collect_set("at").alias("cut"))
        left = left.join(cut, "key", "left").where("cut is null or exists(sequence(start, stop), x -> not array_contains(cut, x))").select(*runs.columns)
        left = durable(left.where(f"nth > {low}"))
        if left.isEmpty():
            break
        if low == 0:
            first = left.join(holders.where("pnth = 0").drop("pnth"), "run").select("key", "pkey")
            last = left.join(holders.withColumn("pnth", F.col("pnth") + 1), (left.run == holders.run) & (F.col("nth") == F.col("pnth"))).select("key", "pkey")
            pairs, low = first.unionByName(last), 1
        else:
            high = low * ROUND_GROWTH
            tried = holders.where(f"pnth >= {low} and pnth < {high}")
            pairs, low = left.join(tried, "run").where("pnth < nth - 1").select("key", "pkey"), high
        gone = durable(gone.unionByName(aligned_blocks(pairs.distinct(), lines, min_words)).distinct())
    return gone.groupBy("key").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def deletions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS) -> DataFrame:
    """(id, key, gone): places of lines to delete, for documents that have any. key is the md5 of the text; documents are ordered by id, then key. A text that several documents have is aligned once, for the first of them; its
    other copies lose all lines."""

    @F.arrow_udf(LINES)
    def split_lines(texts: pa.Array) -> pa.Array:
        return structs((numbered_lines(t.as_py()) for t in texts), {"hash": pa.binary(), "at": pa.int32(), "words": pa.int32()})

    named = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    own = named.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), split_lines(F.col(text_col)).alias("lines"))
    texts = stored(own.groupBy("key").agg(F.min("id").alias("id"), F.first("lines").alias("lines")))
    lines = texts.select("id", "key", F.explode("lines").alias("l")).select("id", "key", "l.*")
    often = durable(lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"))  # as a table of its own it can be joined with a hot line's partition split
    gone = all_alignments(durable(lines.join(often, "hash").select("id", "key", "hash", "at", "words")), min_words)
    sizes = texts.select("key", F.col("id").alias("first"), F.size("lines").alias("n"), F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("words"))
    every = F.when((F.col("words") >= min_words) & (F.col("n") > 0), F.sequence(F.lit(0), F.col("n") - 1))
    rows = named.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key")).distinct().join(sizes.join(gone, "key", "left"), "key")
    return rows.select("id", "key", F.when(F.col("id") == F.col("first"), F.col("gone")).otherwise(every).alias("gone")).where(F.size("gone") > 0)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS, gone_col: str | None = None) -> DataFrame:
    """docs with the aligned common blocks deleted from the later documents' texts; every row and column stays. gone_col: a further column, the number of lines deleted.

    The result is that of aligning each document with every earlier one (see all_alignments) by patience sorting of the lines that both have, and deleting from it each block of lines that follow each other on both sides and have
    min_words words. Lines are compared exactly, a line's second occurrence in a text with second ones; lines without a word are never shared and stay, but a document that loses all its lines with words becomes empty.
    Null texts stay null. Rows with a null id are neither cleaned nor cleaned against. Rows with equal ids and texts are one document; of other texts under one id the one with the least md5 comes first. No rows give none.
    """
    key, ident, gone = free_name(docs, "key"), free_name(docs, "id"), free_name(docs, "gone")
    drops = deletions(docs, id_col, text_col, min_words=min_words).select(F.col("id").alias(ident), F.col("key").alias(key), F.col("gone").alias(gone))

    @F.arrow_udf("string")
    def less(texts: pa.Array, places: pa.Array) -> pa.Array:
        return pa.array([without_places(t, p) for t, p in ((t.as_py(), p.as_py()) for t, p in zip(texts, places))], pa.string())

    own = free_name(docs, "own")
    rows = docs.withColumn(own, text_key(F.col(text_col)))
    rows = rows.join(drops, (F.col(id_col) == F.col(ident)) & (F.col(own) == F.col(key)), "left")
    some = F.size(gone) > 0
    new = F.when(some, less(F.when(some, F.col(text_col)), F.col(gone))).otherwise(F.col(text_col))  # other texts don't go to Python
    out = [new.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    more = [F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(gone_col)] if gone_col else []
    return rows.withColumn(gone, F.coalesce(F.col(gone), F.array().cast("array<int>"))).select(*out, *more)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines_deleted, n_chars (code points left; 0 for null) and text_sha256 (null for null) of each row."""
    rows = cleaned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), gone_col="n_lines_deleted")
    return rows.select("doc_id", "n_lines_deleted", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
