"""SimHash near-duplicates through an inverted index of positional bytes with count filtering."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from lectern.llm.common import components, durable, free_name

SEED = 42
#: Shingles counted at a time, so that a very long text needs no array of all its bits.
CHUNK = 1 << 15
#: Most bits in which linked fingerprints differ. They touch at most so many of a fingerprint's eight bytes.
RADIUS = 2
BYTES = 8
#: Two ways to pair the eight positions. A key is two pairs of one way (four bytes), so each way has six keys, no two of the twelve of the same bytes.
PAIRINGS = (((0, 1), (2, 3), (4, 5), (6, 7)), ((1, 2), (3, 4), (5, 6), (7, 0)))
#: Keys that fingerprints within RADIUS bits share at least: two bytes that differ leave two pairs of each way whole, and with them one key of each way.
LEAST_SHARED = len(PAIRINGS)
#: A posting list of more members is split by further positions before its pairs are counted.
SPLIT_POSTINGS = 24


def text_fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of a text, by XXH64 of its word shingles. No words (null, empty, only white space): 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(words_per_shingle))))
    hashes = map(xxh64_intdigest, shingles, repeat(SEED))
    set_bits, n = np.zeros(64, np.int64), 0
    while (part := np.fromiter(islice(hashes, CHUNK), np.dtype(">u8"))).size:
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += part.size
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprint(text: Column, words_per_shingle: int = 3) -> Column:
    """text_fingerprint as a column of 64-bit longs (the bits as they are, so the highest is the sign)."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(np.fromiter((text_fingerprint(t, words_per_shingle) for t in texts.to_pylist()), np.uint64, len(texts)).view(np.int64))

    return simhash(text)


def positional_byte(fp: str, position: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), 8 * (BYTES - 1 - position)).bitwiseAND(F.lit(255))


def posting_keys(fp: str) -> list[Column]:
    """The keys of a fingerprint's posting lists: which key, and the four positional bytes that it holds."""
    keys = []
    for way in PAIRINGS:
        for a, b in combinations(way, 2):
            value = F.lit(len(keys)).cast("long")
            for p in (*a, *b):
                value = F.shiftleft(value, 8).bitwiseOR(positional_byte(fp, p))
            keys.append(value)
    return keys


def narrower(postings: DataFrame, bits: int) -> DataFrame:
    """Posting lists that are split once more. postings: fp, key (array), free (the four positions, in pieces of so many bits, that the key leaves open).

    Fingerprints within RADIUS bits differ in two of four open positions at most, so they agree in two others, and with them in one of the six keys of two positions. Each is a further part of the key; the other two positions stay open, in halves.
    """
    choices = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.array(*map(F.lit, rest)).alias("rest")) for a, b in combinations(range(4), 2) for rest in [[x for x in range(4) if x not in (a, b)]]))
    x = postings.select("fp", "key", "free", F.explode(choices).alias("c"))
    at = lambda i: F.get("free", F.col(i)).cast("int")
    x = x.withColumns({"pa": at("c.a"), "pb": at("c.b")})
    taken = lambda p: F.expr(f"shiftrightunsigned(fp, {64 - bits} - {bits} * {p}) & {(1 << bits) - 1}")
    more = F.array(F.col("pa").cast("long"), taken("pa"), F.col("pb").cast("long"), taken("pb"))
    halves = F.flatten(F.transform("c.rest", lambda r: F.array(2 * F.get("free", r), 2 * F.get("free", r) + 1)))
    return x.select("fp", F.concat("key", more).alias("key"), halves.alias("free"))


def paired(postings: DataFrame) -> DataFrame:
    """(u, v, matches): each two fingerprints that share lists, and how many."""
    left, right = postings.select("key", F.col("fp").alias("u")), postings.select("key", F.col("fp").alias("v"))
    return left.join(right, "key").where("u < v").groupBy("u", "v").agg(F.count(F.lit(1)).alias("matches"))


def fingerprint_links(fingerprints: DataFrame) -> DataFrame:
    """(u, v): all pairs of the distinct fingerprints in column fp that lie within RADIUS bits.

    The inverted index files a fingerprint under twelve keys of four positional bytes each (one byte alone would hold a 256th of all rows). The posting lists give a row for each two fingerprints
    that share a key; these are tallied for each pair, pairs short of LEAST_SHARED keys go unverified, and of the others the differing bits are counted.
    A list of more than SPLIT_POSTINGS would give pairs by the square of its length: it is split by two more of its four open bytes, and a list that is still so long by two of the four half bytes that these leave. Two fingerprints within
    RADIUS bits share one of the six keys of each split, so one match is the guaranteed minimum there; after both, eight bits are open, so a list has 256 members at most. A pair of which one shared list is split is found there; one of
    which none is has all its shared keys in the first tally.
    """
    keys = [(k, [p for p in range(BYTES) if p not in (*a, *b)]) for k, (a, b) in enumerate(x for way in PAIRINGS for x in combinations(way, 2))]
    filed = F.array(*(F.struct(F.array(v).alias("key"), F.array(*map(F.lit, keys[k][1])).alias("free")) for k, v in enumerate(posting_keys("fp"))))
    postings = fingerprints.select("fp", F.explode(filed).alias("x")).select("fp", "x.key", "x.free")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
    found = []
    for least, bits in ((LEAST_SHARED, 8), (1, 4), (1, None)):
        lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        shared = durable(postings.join(lists, "key"))  # a fingerprint alone in all its lists leaves here
        short = shared if bits is None else shared.where(F.col("members") <= SPLIT_POSTINGS)
        found.append(paired(short).where((F.col("matches") >= least) & close).select("u", "v"))
        long = shared.where(F.col("members") > SPLIT_POSTINGS).drop("members")
        if bits is None or long.isEmpty():
            break
        postings = narrower(long, bits)
    return reduce(DataFrame.unionByName, found).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_per_shingle: int = 3) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits) and component_id, the smallest id that links of at most RADIUS differing bits reach.

    Null, empty and blank texts have fingerprint zero and link like any other. Equal fingerprints are one node with a count of one, so exact copies cost nothing.
    A null id keeps its row and is never the smallest; rows whose whole component has null ids get a null component. Repeated rows stay repeated. Other columns are not read.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), words_per_shingle).alias("fp"))
    return with_components(durable(own))


def grouped(fingerprints: DataFrame) -> DataFrame:
    """fp, component (one of its fingerprints) and component_id (its smallest id) of each fingerprint. fingerprints: doc_id, fp."""
    nodes = durable(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    groups = components(fingerprint_links(nodes.select("fp")))
    placed = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return placed.join(least, "component").select("fp", "component", "component_id")


def with_components(own: DataFrame) -> DataFrame:
    """The part of near_duplicates after the fingerprints: own has doc_id and fp."""
    out = own.join(grouped(own).drop("component"), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words_per_shingle: int = 3) -> DataFrame:
    """The rows of docs, with all their columns, less those that near-duplicate another row that stays.

    Of each component one row stays, one with its smallest id; rows are judged by their own texts, so a text is never dropped for an unlike one under the same id. If the smallest id has several rows in the component, the one
    with the least fingerprint stays, then the least hash of the columns; rows that are equal throughout are one. Rows with null ids all stay, and no row goes for their sake. Null, empty and blank texts are alike. No rows give none.
    """
    row, ident = free_name(docs, "row"), free_name(docs, "id")
    whole = F.xxhash64(*(F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind))
    named = docs.where(F.col(id_col).isNotNull())
    own = durable(named.select(F.col(id_col).alias("doc_id"), whole.alias("row"), fingerprint(F.col(text_col), words_per_shingle).alias("fp")))
    least = own.join(grouped(own.select("doc_id", "fp")), "fp").where("doc_id = component_id").groupBy("component").agg(F.min(F.struct("fp", "doc_id", "row")).alias("x"))
    kept = least.select(F.col("x.doc_id").alias(ident), F.col("x.row").alias(row))
    rows = named.withColumn(row, whole)
    one = rows.join(kept.withColumnRenamed(row, f"{row}_kept"), (F.col(id_col) == F.col(ident)) & (F.col(row) == F.col(f"{row}_kept")), "left_semi")
    return one.dropDuplicates([id_col, row]).select(*docs.columns).unionByName(docs.where(F.col(id_col).isNull()))
