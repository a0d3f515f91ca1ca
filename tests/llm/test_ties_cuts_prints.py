"""Ranks with ties, fill-in-the-middle and order-sensitive fingerprints, against plain loops."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import fill_in_middle as fim
from lectern.llm import order_minhash as omh
from lectern.llm import tie_ranks

LINES = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, shipped_at timestamp_ntz, place int, `__n` int"


def plain_ranks(rows, most):
    """The first lines of each group by one sort over each group's lines."""
    import math

    last = lambda x: (x is None, x or 0)
    groups = defaultdict(list)
    for sale, line, item, vendor, quantity, amount, discount, shipped in rows:
        g = (vendor, -1 if item is None else item % 5, -1 if shipped is None else 100 * shipped.year + shipped.month)
        if sale is not None and zlib.crc32(str(sale).encode()) % 5 == 0:
            g = (-1, -1, -1)
        tens = None if quantity is None else quantity // 10
        percent, cents = (None if x is None or x != x else math.floor(100 * x + 0.5) for x in (discount, amount))
        groups[g].append((tens, percent, sale, line, quantity, cents))
    out = Counter()
    for g, own in groups.items():
        own.sort(key=lambda r: (r[0] is None, -(r[0] or 0), *map(last, r[1:])))
        ties = Counter(r[:2] for r in own)
        for pos, (tens, percent, sale, line, quantity, cents) in enumerate(own[: most or None], 1):
            out[(*g, pos, pos, sale, line, quantity, percent, cents, ties[tens, percent])] += 1
    return out


def sale_rows(n, seed):
    import datetime

    rng = random.Random(seed)
    maybe = lambda x: None if rng.random() < 0.15 else x
    rows = [(maybe(rng.randrange(9)), maybe(rng.randrange(3)), maybe(rng.randrange(12)), maybe(rng.randrange(2)), maybe(rng.randrange(45)), maybe(rng.choice([1.005, 2.5, float("nan")])), maybe(rng.choice([0.0, 0.05, 0.1])), maybe(datetime.datetime(2024, rng.randrange(1, 3), 5))) for _ in range(n)]
    return rows + rows[: n // 3] * 2


@pytest.mark.parametrize("most", [2, 7, None])
def test_op11_against_a_sort(spark, most):
    rows = sale_rows(300, 3)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], LINES)
    got = tie_ranks.first_lines(df, most).select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")
    assert Counter(map(tuple, got.collect())) == plain_ranks(rows, most)
    assert tie_ranks.first_lines(df.limit(0)).collect() == []


def test_op11_many_copies_of_one_row_are_restored(spark, monkeypatch):
    monkeypatch.setattr(tie_ranks, "STRETCH", 7)
    df = spark.range(100).select(F.lit(1).alias("g"), F.lit(None).cast("int").alias("t"), F.lit("x").alias("z")).unionByName(spark.createDataFrame([(1, 5, "a")], "g int, t int, z string"))
    out = tie_ranks.ranked(df, ["g"], [("t", False)], [("z", True)]).orderBy("pos").collect()
    assert [r.pos for r in out] == list(range(1, 102)) and [r.tied for r in out] == [1] + [100] * 100 and out[0].t == 5


def test_op11_a_group_over_many_ranges(spark):
    df = spark.range(5000).select(F.lit("hot").alias("g"), (F.col("id") % 700).alias("t"), F.col("id").alias("z"))
    out = tie_ranks.ranked(df, ["g"], [("t", True)], [("z", False)]).collect()
    want = sorted(((i % 700, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    assert [(r.t, r.z) for r in sorted(out, key=lambda r: r.pos)] == want and sorted(r.pos for r in out) == list(range(1, 5001))


@given(st.lists(st.text(alphabet="aZ9 \n\t.<>PSMé日😀\u0000́", max_size=30), min_size=1, max_size=20))
@settings(max_examples=4, deadline=None)
def test_op12_units_and_round_trip(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for g in (fim.LETTERS, fim.WORDS, fim.Units(())):
        assert all(r.u == fim.plain_units(r.text, g) for r in df.select("text", fim.units(F.col("text"), g).alias("u")).collect())
    out = fim.transformed(df).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    assert all(r.back == texts[r.doc_id] for r in out.collect())


def plain_middle(ident, text):
    """Form, cuts and output of one text by its definition."""
    units = fim.plain_units(text)
    h = hashlib.sha256(f"1:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    return (len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_op12_odd_rows_against_a_loop(spark):
    marked = spark.createDataFrame([(20, "a <S> b"), (21, "<P"), (22, "<" * 9 + "P>"), (23, "S><M"), (24, "é日 <P>")], "doc_id long, text string")
    docs = odd_documents(spark).withColumn("form", F.lit(1)).withColumn("__fim", F.lit(2)).unionByName(marked, allowMissingColumns=True)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = Counter()
    for r in docs.collect():
        n, form, p, m, out = plain_middle(r.doc_id, r.text or "")
        want[(r.doc_id, n, form, p, m, sha(out), sha(r.text or ""))] += 1
    assert Counter(map(tuple, fim.digest(docs).collect())) == want
    full = fim.transformed(docs)
    assert full.columns.count("form") == 1 and "__fim" in full.columns and full.count() == docs.count()
    assert fim.digest(docs.limit(0)).collect() == []


def plain_print(text):
    """The fingerprint by its definition: for each part all numbered k-mers sorted by their hash, the least ones in the order of the text."""
    kmers = omh.kmer_hashes(text, omh.K)
    seen, ids = Counter(), []
    for x in kmers.tolist():
        ids.append((x + seen[x] * 0xD6E8FEB86659FD93) % (1 << 64))
        seen[x] += 1
    short = [int(x) >> 32 for x in omh.mixed(np.array(ids, np.uint64))] if ids else []
    out = ""
    for seed, factor in zip(omh.SEEDS[:, 0].tolist(), omh.FACTORS[:, 0].tolist()):
        best = sorted((((h ^ seed) * factor % (1 << 32)) >> 1, at) for at, h in enumerate(short))[: omh.PICKED]
        code = 0
        for at in sorted(at for _, at in best):
            code = int(omh.mixed(np.array([(code * 0x9E3779B97F4A7C15 + int(kmers[at]) + 1) % (1 << 64)], np.uint64))[0])
        out += f"{code >> 48:04x}"
    return out


def plain_likeness(a, b):
    cells = [(a[i : i + 4], b[i : i + 4]) for i in range(0, len(a), 4)]
    return sum(x == y for x, y in cells) / len(cells)


def test_op13_fingerprints_against_sorting(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é😀") for _ in range(rng.choice([0, 1, 5, 9, 10, 200, 3000]))) for _ in range(25)] + ["x" * 500, "ab" * 4000]
    assert [omh.sketched([t])[0] for t in texts] == [plain_print(t) for t in texts]
    for a, b in zip(texts, texts[1:]):
        assert omh.sketched([a, a[: len(a) // 2] + b]) == [plain_print(a), plain_print(a[: len(a) // 2] + b)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", omh.fingerprint(F.col("t")).alias("f")).collect()
    assert all(r.f == plain_print(r.t) for r in got)


def test_op13_order_and_edits_show(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(400)]
    text, turned = " ".join(words), " ".join(words[200:] + words[:200])
    few = " ".join(w if k % 60 else "changed" for k, w in enumerate(words))
    a, b, c, d = (omh.sketched([t])[0] for t in (text, turned, few, " ".join(reversed(words))))
    assert plain_likeness(a, a) == 1 and plain_likeness(a, c) > 0.6
    assert plain_likeness(a, d) < 0.2  # the same words: a set of k-mers would not tell
    assert plain_likeness(a, d) < plain_likeness(a, b) < 0.8


@pytest.mark.parametrize("parts", [1, 3, 12])
def test_op13_next_documents_against_a_loop(spark, parts):
    docs = odd_documents(spark).repartition(parts)
    docs = docs.unionByName(docs.where("doc_id = 7").withColumn("text", F.lit("another text under one id")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    each = sorted({(r.doc_id is not None, r.doc_id or 0, r.h, r.text) for r in rows})
    copies = Counter((r.doc_id, r.text) for r in rows)
    want = Counter()
    for k, (named, i, _, text) in enumerate(each):
        after = each[(k + 1) % len(each)][3]
        m = len(text) // 4
        other = text[: len(text) - m] + after[:m]
        own, its, nxt = plain_print(text), plain_print(other), plain_print(after)
        ident = i if named else None
        want[(ident, len(text), hashlib.sha256(other.encode()).hexdigest(), own, its, plain_likeness(own, its), plain_likeness(own, nxt))] += copies[ident, text]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert Counter(map(tuple, omh.with_next(docs).collect())) == want
        assert omh.with_next(docs.limit(0)).collect() == []
        [alone] = omh.with_next(docs.where("doc_id = 6")).collect()
        assert alone.near_next == alone.near_edited == 1.0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_op13_query_covers_every_document(spark, data):
    from lectern.llm.queries import queries

    rows = queries()["op13_document_fingerprints"](spark, data).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    ids = sorted(texts)
    assert sorted(r.doc_id for r in rows) == ids
    after = dict(zip(ids, ids[1:] + ids[:1]))
    for r in rows:
        t = texts[r.doc_id]
        m = len(t) // 4
        assert r.edited_sha256 == hashlib.sha256((t[: len(t) - m] + texts[after[r.doc_id]][:m]).encode()).hexdigest() and r.n_chars == len(t)
    sampled = rows[:40]
    assert all(r.fingerprint == plain_print(texts[r.doc_id]) for r in sampled)
    assert np.mean([r.near_edited > r.near_next for r in rows if r.n_chars > 100]) > 0.95
