"""Repeated passages by sparse suffix arrays over minimiser positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lectern.llm.common import stored

#: Words that a repeated passage has at least; a passage of "over 50 words" has 51.
MIN_WORDS = 50
#: Words of the first part of a suffix, by which it is sorted. A minimiser is the least of the hashes of MIN_WORDS - GRAM + 1 such parts that follow each other, so every passage has one.
GRAM = 16
#: Odd bases of the two polynomial hashes of a run of words.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash, on an array."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Runs:
    """Hashes of runs of words of one text, each from two differences: sums of word hashes times falling powers of an odd base, modulo 2^64."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()
        self.n = len(words)
        self.words = np.fromiter(map(xxh64_intdigest, words), np.uint64, self.n)
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, starts: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
        if base not in self.sums:
            back = powers(pow(base, -1, 1 << 64), self.n)
            self.sums[base] = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.words * back, dtype=np.uint64)]), powers(base, self.n + 1)
        s, up = self.sums[base]
        return mixed((s[starts + length] - s[starts]) * up[starts])


def sliding(op: np.ufunc, a: np.ndarray, width: int) -> np.ndarray:
    """op over each run of width values that follow each other, in a number of passes that is the logarithm of width."""
    span = 1
    while 2 * span <= width:
        a = op(a[:-span], a[span:])
        span *= 2
    return op(a[: len(a) - (width - span)], a[width - span :]) if width > span else a


def minimisers(runs: Runs, min_words: int = MIN_WORDS, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the gram, place) of the suffixes that are retained: those whose hash is the least of a window that holds them. Equal runs of min_words words retain the same places within them."""
    width = min_words - gram + 1
    if runs.n < min_words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    grams = runs.of(np.arange(runs.n - gram + 1), gram)
    least = sliding(np.minimum, grams, width)
    around = np.zeros(width - 1, np.uint64)
    most = sliding(np.maximum, np.concatenate([around, least, around]), width)  # of the minima of the windows that hold each place
    at = np.flatnonzero(grams == most)
    return grams[at], at


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the maximal runs that windows of length words at these sorted starts cover; windows that overlap or touch are one run."""
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    begin = starts[np.concatenate([[0], cut]).astype(int)]
    end = starts[np.concatenate([cut - 1, [len(starts) - 1]]).astype(int)] + length
    return begin, end - begin


def retained(docs: DataFrame, min_words: int, gram: int) -> DataFrame:
    """(gram, key, at, id): suffixes at minimisers. docs: id, key, text."""

    @F.arrow_udf("struct<grams:array<bigint>,at:array<int>>")
    def sample(texts: pa.Array) -> pa.Array:
        grams, at = [], []
        for t in texts.to_pylist():
            g, a = minimisers(Runs(t), min_words, gram)
            grams.append(g.view(np.int64))
            at.append(a.astype(np.int32))
        return pa.StructArray.from_arrays([pa.array(grams, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32()))], ["grams", "at"])

    rows = docs.select("id", "key", sample("text").alias("s")).select("id", "key", F.explode(F.arrays_zip("s.grams", "s.at")).alias("x"))
    return rows.select(F.col("x.grams").alias("gram"), "key", F.col("x.at").alias("at"), "id")


def with_equal_neighbours(suffixes: DataFrame) -> DataFrame:
    """The suffixes that share their first GRAM words with the one before or after in sorted order.

    Sorting is by ranges over the whole key, so a very common suffix spreads over many tasks; the first and last of each task's range have a neighbour elsewhere and stay, to be settled by the extension.
    """

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last row so far, not yet given out
        last_equal = True
        for b in batches:
            if not b.num_rows:
                continue
            g = b["gram"].to_numpy()
            same = g[1:] == g[:-1]
            first = True if held is None else bool(held["gram"][0].as_py() == g[0])
            if held is not None and (first or last_equal):
                yield held
            keep = np.concatenate([[first], same]) | np.concatenate([same, [False]])
            if b.num_rows > 1:
                yield b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1]))
            held, last_equal = b.slice(b.num_rows - 1), bool(keep[-1])
        if held is not None:
            yield held

    order = ["gram", "key", "at", "id"]
    ranged = suffixes.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(neighbours, ranged.schema)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS, gram: int = GRAM) -> DataFrame:
    """One row for each maximal repeated passage of a document: doc_id, text_key, first_word, n_words, first_doc_id (the smallest id that has one of its runs of min_words words) and copies (the most places that one of them has, this one included).

    A passage is repeated if each run of min_words words in it occurs at two places or more of the documents, be it in one text. Words are runs without space and U+0009 to U+000D, compared exactly.
    Suffixes at minimisers are sorted and compared with their neighbours; those with an equal neighbour are extended to the left and right: all runs of min_words words around them are looked up by two hashes of 64 and 32 bits. Equal texts are looked up once, with their number.
    Null, empty and short texts and rows with a null id have no row; rows that are equal in id and text are one document. No rows give none.
    """
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    owners = rows.select("id", "key").distinct()
    texts = owners.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    alike = with_equal_neighbours(stored(retained(rows, min_words, gram)))  # ranges are drawn from a first look at the rows, which then must not be made twice
    places = alike.groupBy("key").agg(F.collect_set("at").alias("at")).join(texts, "key")

    @F.arrow_udf("struct<w:array<bigint>,v:array<int>,start:array<int>>")
    def extend(texts: pa.Array, at: pa.Array) -> pa.Array:
        w, v, start = [], [], []
        reach = np.arange(min_words - gram + 1)
        for t, a in zip(texts.to_pylist(), at.to_pylist()):
            runs = Runs(t)
            s = np.unique((np.asarray(a, np.int64)[:, None] - reach).ravel())
            s = s[(s >= 0) & (s + min_words <= runs.n)]
            w.append(runs.of(s, min_words).view(np.int64))
            v.append((runs.of(s, min_words, BASES[1]) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            start.append(s.astype(np.int32))
        return pa.StructArray.from_arrays([pa.array(w, pa.list_(pa.int64())), pa.array(v, pa.list_(pa.int32())), pa.array(start, pa.list_(pa.int32()))], ["w", "v", "start"])

    own = rows.join(places, ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "key", "n", extend("text", "at").alias("e"))
    windows = stored(own.select("id", "key", "n", F.explode(F.arrays_zip("e.w", "e.v", "e.start")).alias("x")).select("id", "key", "n", "x.w", "x.v", "x.start"))
    counts = windows.groupBy("w", "v").agg(F.sum("n").alias("copies"), F.min("id").alias("first_id")).where("copies > 1")
    counts = stored(counts)  # as a table of its own it can be joined with a very common run's partition split
    hits = windows.select("key", "w", "v", "start").join(counts, ["w", "v"]).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "first_id", "copies"))).alias("hits"))

    kind = hits.schema["hits"].dataType.elementType["first_id"].dataType.simpleString()

    @F.arrow_udf(f"array<struct<first_word:int,n_words:int,first_id:{kind},copies:bigint>>")
    def merge(hit_lists: pa.Array) -> pa.Array:
        flat, ends = hit_lists.flatten(), np.cumsum([0, *(len(x) for x in hit_lists)])
        all_starts, counts = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "copies"))
        ids, out = flat.field("first_id").to_pylist(), []
        for a, b in zip(ends[:-1], ends[1:]):
            begin, size = spans(all_starts[a:b], min_words)
            cut = [*(a + np.searchsorted(all_starts[a:b], begin)), b]
            out.append([{"first_word": int(w), "n_words": int(x), "first_id": min(ids[lo:hi]), "copies": int(counts[lo:hi].max())} for w, x, lo, hi in zip(begin, size, cut, cut[1:])])
        return pa.array(out, pa.list_(pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("first_id", flat.field("first_id").type), ("copies", pa.int64())])))

    found = owners.join(hits.select("key", merge("hits").alias("m")), "key").select("id", "key", F.explode("m").alias("m"))
    return found.select(F.col("id").alias("doc_id"), F.col("key").alias("text_key"), "m.first_word", "m.n_words", F.col("m.first_id").alias("first_doc_id"), "m.copies")
