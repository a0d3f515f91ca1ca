"""Order MinHash: fingerprints of which the likeness follows the edit distance of texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import stored

#: Code points of a k-mer; parts of a fingerprint; k-mers selected for each part.
K, PARTS, PICKED = 9, 48, 2
#: Hex digits of a part: 16 bits.
DIGITS = 4
#: K-mers hashed at a time.
STEP = 1 << 11
#: Finished documents given out together.
ROWS = 256
U32, U64 = np.uint32, np.uint64
NONE = U64(np.iinfo(U64).max)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a 64-bit hash, on an array."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def kmer_hashes(text: str, k: int) -> np.ndarray:
    """A hash of each k-mer in order; a text shorter than k is one k-mer, an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), U32).astype(U64)
    k = min(k, len(codes))
    if not k:
        return np.empty(0, U64)
    h = np.full(len(codes) - k + 1, k, U64)
    for i in range(k):
        h *= U64(0x9E3779B97F4A7C15)
        h += codes[i : len(codes) - k + 1 + i]
    return mixed(h)


def numbered(kmers: np.ndarray) -> np.ndarray:
    """A hash of each k-mer with the number of times that it occurred before, so that no two are the same. For counting, k-mers are told apart by the upper half of their hash; the number depends only on what stands before."""
    at = np.arange(len(kmers), dtype=U64)
    ordered = (kmers >> U64(32) << U64(32)) | at
    ordered.sort()
    place = (ordered & U64(0xFFFFFFFF)).astype(np.int64)
    ordered >>= U64(32)
    fresh = np.ones(len(kmers), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    seen = np.empty(len(kmers), U64)
    seen[place] = at - np.maximum.accumulate(np.where(fresh, at, U64(0)))
    return mixed(kmers + seen * U64(0xD6E8FEB86659FD93))


def permutations(parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each part a number and an odd factor, always the same ones."""
    rng = np.random.default_rng(7)
    return rng.integers(0, 1 << 32, (parts, 1), dtype=U32), rng.integers(0, 1 << 31, (parts, 1), dtype=U32) * U32(2) + U32(1)


SEEDS, FACTORS = permutations(PARTS)


@dataclass
class Sketch:
    """For each part the PICKED least hashes of numbered k-mers so far, in ascending order: 31 bits of the hash, and the place in the lowest 32. least is NONE where a text has fewer."""

    least: np.ndarray = field(default_factory=lambda: np.full((PARTS, PICKED), NONE, U64))

    def add(self, ids: np.ndarray, first: int) -> Sketch:
        """This sketch with k-mers at places first, first + 1... taken in."""
        short, least, rows = (ids >> U64(32)).astype(U32), self.least, np.arange(PARTS)
        for i in range(0, len(short), STEP):
            h = short[None, i : i + STEP] ^ SEEDS
            h *= FACTORS
            h >>= U32(1)
            found = [least]
            for _ in range(min(PICKED, h.shape[1])):
                at = h.argmin(axis=1)
                found.append(((h[rows, at].astype(U64) << U64(32)) | (at + (first + i)).astype(U64))[:, None])
                h[rows, at] = U32(0xFFFFFFFF)
            least = np.sort(np.concatenate(found, axis=1), axis=1)[:, :PICKED]
        return Sketch(least)

    def fingerprint(self, kmers: np.ndarray) -> str:
        """DIGITS hex digits for each part: a hash of its selected k-mers in the order of the text."""
        places = np.where(self.least == NONE, NONE, self.least & U64(0xFFFFFFFF))
        places.sort(axis=1)
        out = np.zeros(PARTS, U64)
        for column in places.T:
            there = column != NONE
            out[there] = mixed(out[there] * U64(0x9E3779B97F4A7C15) + kmers[column[there].astype(np.int64)] + U64(1))
        return (out >> U64(64 - 4 * DIGITS)).astype(">u2").tobytes().hex()


def sketched(texts: list[str]) -> list[str]:
    """The fingerprints of texts. The k-mers that all of them begin with are numbered alike and hashed once."""
    kmers = [kmer_hashes(t, K) for t in texts]
    shared = min(map(len, kmers))
    for other in kmers[1:]:
        differ = np.flatnonzero(kmers[0][:shared] != other[:shared])
        shared = int(differ[0]) if differ.size else shared
    ids = [numbered(own) for own in kmers]
    start = Sketch().add(ids[0][:shared], 0)
    return [start.add(i[shared:], shared).fingerprint(own) for i, own in zip(ids, kmers)]


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text as a column of PARTS * DIGITS hex digits: equal for equal texts. A null text is empty; all empty texts are alike."""

    @F.arrow_udf("string")
    def order_minhash(texts: pa.Array) -> pa.Array:
        return pa.array([sketched([t or ""])[0] for t in texts.to_pylist()], pa.string())

    return order_minhash(text)


def likeness(a: Column, b: Column) -> Column:
    """The share of parts in which two fingerprints of one length agree, 0 to 1."""
    same = lambda i: F.substring(a, i, DIGITS) == F.substring(b, i, DIGITS)
    return F.aggregate(F.sequence(F.lit(1), F.length(a), F.lit(DIGITS)), F.lit(0), lambda s, i: s + same(i).cast("int")) * DIGITS / F.length(a)


def edited(text: str, after: str) -> str:
    """A text of which the last quarter (rounded down) gives way to the first as many code points of another, or all of it."""
    m = len(text) // 4
    return text[: len(text) - m] + after[:m]


SCHEMA = "doc_id {id}, copies long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, next_fingerprint string, part int, head string, tail string"


def chained(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as a table in which each document has met the next one in ascending doc_id: one row a document, and for each task a row of the document that it begins with and one of that it ends with, whose next one is elsewhere.

    Rows lie in ranges of doc_id, each range sorted and gone through once with two documents in hand, so a text is shuffled once and no window holds texts. Rows that are equal follow each other and are one document with `copies`.
    """
    schema = SCHEMA.format(id=docs.schema["doc_id"].dataType.simpleString())

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, kind, empty = TaskContext.get().partitionId(), [], None, None
        last = held = None  # the document before the one in hand with its fingerprints, and the one in hand: [id, text, copies]

        def row(d: list, **more) -> dict:
            return dict.fromkeys(empty) | {"doc_id": d[0], "copies": d[2], "n_chars": len(d[1])} | more

        def settled(d: list, after: list | None) -> dict:
            """The row of d, of which the next document is after, but for that one's fingerprint."""
            other = edited(d[1], after[1]) if after else d[1]
            own, its = sketched([d[1], other])
            return row(d, edited_text=other, fingerprint=own, edited_fingerprint=its)

        for b in batches:
            kind = kind or b.schema.field("doc_id").type
            empty = empty or [c.strip().split(" ")[0] for c in schema.split(",")]
            for i, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                if held and held[:2] == [i, t]:
                    held[2] += 1
                    continue
                new = [i, t, 1]
                if held:
                    now = settled(held, new)
                    if last:
                        rows.append(last | {"next_fingerprint": now["fingerprint"]})
                    else:
                        rows.append(row([None, "", 0], part=part, head=held[1], fingerprint=now["fingerprint"]))
                    last = now
                held = new
            if len(rows) >= ROWS or sum(len(r["edited_text"] or "") for r in rows) > 1 << 20:
                yield from batch(rows, kind)
                rows = []
        if held:
            now = settled(held, None)
            if last:
                rows.append(last | {"next_fingerprint": now["fingerprint"]})
            else:
                rows.append(row([None, "", 0], part=part, head=held[1], fingerprint=now["fingerprint"]))
            rows.append(now | {"part": part, "tail": held[1], "edited_text": None, "edited_fingerprint": None})
            yield from batch(rows, kind)

    def batch(rows: list[dict], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
        fields = [(c.split(" ")[0], kind if c.startswith("doc_id") else types[c.split(" ")[1]]) for c in schema.split(", ")]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    order = [F.asc_nulls_first("doc_id"), F.asc("__text"), F.asc("text")]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("__text", F.xxhash64("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    return dealt.mapInArrow(fold, schema)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next: each document against its edited text (see edited) and against the next one, in ascending doc_id, after the last the first.

    A row for each row of docs. Null ids come first; documents of one id are in the order of a hash of their texts; rows that are equal throughout are one document, given as often. Null texts are empty. A document that is alone is its own
    next one. Other columns are not read. No rows give none.

    Within a task's range the next document is the next row; what a task begins and ends with (two rows a task) meets in a join over the numbers of tasks, the last with the first. Those rows are read again, so the table is written
    to the shared folder, without the edited texts.
    """
    found = chained(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    sha = F.sha2(F.col("edited_text").cast("binary"), 256)
    found = stored(found.withColumn("edited_sha256", sha).drop("edited_text"))
    heads = found.where("head is not null").select("part", "head", F.col("fingerprint").alias("head_fingerprint"))
    order = Window.orderBy("part")  # of numbers of tasks
    turns = heads.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("after"))
    tails = found.where("tail is not null").drop("head", "edited_sha256", "edited_fingerprint", "next_fingerprint")
    met = tails.join(turns, "part").join(heads.withColumnRenamed("part", "after"), "after")

    @F.arrow_udf("struct<text:string,fingerprint:string>")
    def edit(texts: pa.Array, after: pa.Array) -> pa.Array:
        out = [(edited(a, b), a) for a, b in zip(texts.to_pylist(), after.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([o for o, _ in out], pa.string()), pa.array([sketched([a, o])[1] for o, a in out], pa.string())], ["text", "fingerprint"])

    met = met.withColumn("e", edit("tail", "head"))
    met = met.select("doc_id", "copies", "n_chars", "fingerprint", F.col("e.fingerprint").alias("edited_fingerprint"), F.col("head_fingerprint").alias("next_fingerprint"), F.sha2(F.col("e.text").cast("binary"), 256).alias("edited_sha256"))
    rows = found.where("part is null").select(*met.columns).unionByName(met)
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
