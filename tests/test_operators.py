from __future__ import annotations

import random

from pyspark.sql import functions as F

from lectern.operators import dedup, graphs, joins, reports, sequences, stats


def test_quotes_are_found_on_a_page_or_across_two(spark):
    pages = spark.createDataFrame([("d", 1, "It says “fi…rst"), ("d", 2, "half here. Then more"), ("e", 1, "other")], "doc string, page int, text string")
    quotes = spark.createDataFrame([(1, "d", "Then  more."), (2, "d", "first half"), (3, "d", "other"), (4, "d", 'says "fi...')], "quote_id int, doc string, quote string")
    assert {r.quote_id: r.page for r in joins.verified_quotes(quotes, pages).collect()} == {1: 2, 2: 1, 3: None, 4: 1}


def test_contained_finds_needles_inside_words_too(spark):
    texts = spark.createDataFrame([(1, "xx one two three four five yy"), (2, "zone two three four fives"), (3, "one two")], "doc_id int, text string")
    needles = spark.createDataFrame([(1, "one two three four five"), (2, "two"), (3, "e two three four f"), (4, "")], "item_id int, needle string")
    got = {(r.item_id, r.doc_id) for r in joins.contained(needles, texts, "doc_id").collect()}
    assert got == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (3, 1), (3, 2)}


def test_with_default_and_named(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k int")
    look = spark.createDataFrame([(1, "a", 5)], "k int, name string, n int")
    assert sorted(map(tuple, joins.with_default(rows, look, "k", {"name": F.lit("none"), "n": F.lit(0)}).collect())) == [(1, "a", 5), (2, "none", 0)]
    assert {r.k: r["name"] for r in joins.named(rows, look.select("k", "name"), "k").collect()} == {1: "a", 2: "2"}


def test_number_lists_refs_and_routes(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(reports.number_list(F.lit("7, 8 and 9"))) == [7, 8, 9] and one(reports.number_list(F.lit("14-16"))) == [14, 15, 16] and one(reports.number_list(F.lit("1-99"))) == [1, 99]
    assert one(reports.ref_parts(F.lit("s24 1(c)"))) == ("s24", "1", "(c)") and one(reports.ref_parts(F.lit("w20 3"))).part is None
    assert one(reports.routed(F.lit("9626_s24_er.pdf"))) == "reports" and one(reports.routed(F.lit("9626_s24_qp_02.pdf"))) == "paper2" and one(reports.routed(F.lit("9626_s24_qp_12.pdf"))) == "paper1"
    assert one(reports.answer_lines(F.lit(5))) == 8 and one(reports.answer_lines(F.lit(99))) == 34
    assert one(reports.reflowed(F.lit("a\nb\nC\n)d"))) == "a b\nC )d"


def test_folding_ignores_empty_keys_and_keeps_order(spark):
    u = spark.createDataFrame([("c", "x", 3), ("a", "x", 1), ("b", "", 2), ("d", None, 4), ("e", "", 5)], "id string, k string, o int")
    got = {r.id: (r.dupe_of, r.also_in) for r in dedup.folded(u, [F.col("k")], F.col("o"), "id").collect()}
    assert got == {"a": (None, 1), "c": ("a", None), "b": (None, None), "d": (None, None), "e": (None, None)}


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in graphs.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_intervals_and_empty_inputs(spark):
    rows = spark.createDataFrame([("a", 1, 3), ("a", 2, 9), ("a", 4, 5), ("a", 12, 13)], "g string, lo int, hi int")
    bands = sequences.merged_intervals(rows, ["g"], "lo", "hi")
    assert sorted((r.lo, r.hi, r.n) for r in bands.collect()) == [(1, 9, 3), (12, 13, 1)]
    assert [(r.gap_lo, r.gap_hi, r.cut) for r in sequences.gaps_between(bands, ["g"], "lo", "hi").collect()] == [(9, 12, 10.5)]
    none = spark.createDataFrame([], "paper long, q int, marks long, year int, season int, tags array<string>")
    assert stats.fractional_shares(none).collect() == [] and stats.recency(none).collect() == []


def test_marks_of_zero_and_null_count_as_none(spark):
    u = spark.createDataFrame([(1, 1, 0, ["a.x"]), (1, 2, None, ["a.x", "b.y"]), (2, 1, 3, ["a.x", "a.z", "b.y"])], "paper long, q int, marks long, tags array<string>")
    got = {r.topic: (r.marks, r.pct, r.papers) for r in stats.fractional_shares(u).collect()}
    assert got == {"a": (1.5, 50.0, 2), "b": (1.5, 50.0, 2)}
    assert [tuple(r) for r in stats.histogram(u).collect()] == [(3, 1)]


def test_calendar_gaps(spark):
    s = spark.createDataFrame([(2020, 1), (2020, 1), (2020, 3), (2021, 2), (2022, 1), (2022, 2)], "year int, season int")
    assert sorted(map(tuple, joins.calendar_gaps(s).collect())) == [(2020, 2), (2021, 1), (2021, 3)]


def test_paper_rules(spark):
    import pytest

    from lectern.functions import papers as fn
    from lectern.operators import papers

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(fn.bank_clean(F.lit("9626/32/M/J/17\n(a) .......\n- ..... **[4]**\nkeep this ........\n\n\n\n© UCLES 2017\n12\nlast «"))) == "**[4]**\nkeep this\n\nlast ..."
    assert one(fn.last_command(F.lit("Using it, describe x. Explain y and State z"))) == "Explain" and one(fn.last_command(F.lit("describe it"))) == "Describe" and one(fn.last_command(F.lit("none"))) is None
    assert one(fn.first_command(F.lit("describe, then Draw"))) == "Draw" and one(fn.first_command(F.lit("describe"))) == "Describe" and one(fn.first_command(F.lit("x"))) == "Other"
    assert one(fn.command_words(F.lit("Compare and contrast A. Assess B. Compare"))) == ["Compare and contrast", "Compare"]
    assert tuple(one(fn.report_comment(F.lit("Question 1 short. (a) tiny (b) x Question 12 y"), F.lit("1"), F.lit("a")))) == ("short. (a) tiny (b) x", "question")
    assert one(fn.report_comment(F.lit("Question 12 y"), F.lit("1"), F.lit("a"))) is None
    assert one(fn.scheme_row(F.array(F.lit(f"{fn.BULLET}{fn.SPACE}one"), F.lit("two"), F.lit("3")))) == "- one\ntwo\n\n**Marks: 3**" and one(fn.scheme_row(F.array(F.lit("only")))) == "only"
    assert one(fn.year_runs(F.array(*map(F.lit, (2023, 2019, 2020, 2021, 2020))))) == "2019-2021, 2023"
    assert one(fn.names_file(F.lit("Open the French_Clients file"), F.lit("French_Clients"), F.lit("csv"))) and not one(fn.names_file(F.lit("the sales file"), F.lit("Sales"), F.lit("ods")))
    with pytest.raises(Exception, match="not verified"):
        one(fn.citation(F.lit("s24"), F.lit(None).cast("int")))
    for bad in ("{other}", "{name} }"):
        with pytest.raises(ValueError):
            fn.filled(bad, {"name": F.lit("x")})
    rows = spark.createDataFrame([("p", 1, "T1", 0, 100), ("p", 2, None, 0, 100), ("p", 3, "in", 10, 20), ("p", 4, None, 0, 100)], "paper string, pos int, label string, lo int, hi int")
    assert sorted((r.pos, r.task, r.continued) for r in papers.task_rows(rows).collect()) == [(1, "T1", False), (2, "T1", True), (4, "T1", True)]


def test_scalars_and_bounds_refuse_what_does_not_add_up(spark):
    import pytest

    with pytest.raises(Exception, match="add up"):
        stats.report_scalars(spark.createDataFrame([("a", 50.0), ("b", 20.0)], "topic string, pct double")).collect()
    texts = spark.createDataFrame([("a", 2019), ("a", 2021)], "paper string, year int")
    assert tuple(stats.year_bounds(texts, spark.createDataFrame([("a", 2)], "paper string, sittings long")).first()) == ("a", 2019, 2021, 2)
    with pytest.raises(Exception, match="sittings differ"):
        stats.year_bounds(texts, spark.createDataFrame([("a", 3)], "paper string, sittings long")).collect()


def test_alike_is_the_library_ratio_and_ends_early(monkeypatch):
    from difflib import SequenceMatcher

    from lectern.operators.dedup import Alike

    rnd = random.Random(5)
    for most in (12, 40, 500):
        for _ in range(150):
            b = "".join(rnd.choices("aaaabbbbccde ,.-]^x", k=rnd.randrange(most)))
            a = "".join(c for c in b if rnd.random() < 0.9) if rnd.random() < 0.5 else "".join(rnd.choices("aaaabbbbccde ,.-]^yz", k=rnd.randrange(most)))
            r = SequenceMatcher(None, a, b).ratio()
            assert Alike(b).ratio(a, -1.0) == r
            assert Alike(b).ratio(a, 0.55) == (r if r > 0.55 else None)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rnd.randrange(2, 9))) for _ in range(500)]
    p, q = (" ".join(rnd.choices(words, k=3000)) for _ in range(2))
    steps, block = [], Alike.block
    monkeypatch.setattr(Alike, "block", lambda self, *x: steps.append(x) or block(self, *x))
    assert Alike(q).ratio(p, 0.55) is None
    early = len(steps)
    assert Alike(q).ratio(p, -1.0) == SequenceMatcher(None, p, q).ratio() and 0 < early < (len(steps) - early) / 2


def test_leaf_problems_read_their_tables_once(spark, data):
    from lectern import plans

    plan = plans.queries()["k14_leaf_problems"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 0  # what the checks go over is worked out before them


def test_mark_ranges_have_both_levels_and_the_values_themselves(spark):
    rows = [("a", "s1", "1", "x", 2), ("a", "s1", "1", "x", 1), ("a", "s1", "1", "y", 4), ("a", "s1", "2", "x", 3), ("a", "s2", "1", "x", 7), ("a", "s2", "3", None, 9), ("b", "s2", "3", None, None)]
    got = {r.st: r.asDict(recursive=True) for r in reports.mark_ranges(spark.createDataFrame(rows, "st string, sitting string, task string, part string, marks long"), ["st"]).collect()}
    assert got["a"] == {"st": "a", "sittings": 2, "times": [{"sitting": "s1", "n": 2}, {"sitting": "s2", "n": 2}], "n": 4, "least": 3, "most": 9, "values": [3, 7, 9], "repeats": 1, "part_n": 4, "part_least": 3, "part_most": 7, "part_values": [3, 4, 7], "part_repeats": 1}
    assert got["b"] == {"st": "b", "sittings": 1, "times": [{"sitting": "s2", "n": 1}], "n": 1, "least": None, "most": None, "values": [], "repeats": 0, "part_n": 0, "part_least": None, "part_most": None, "part_values": [], "part_repeats": 0}


def test_near_duplicates_of_a_full_bucket_are_dealt_over_blocks(spark, monkeypatch):
    from difflib import SequenceMatcher

    rnd = random.Random(8)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rnd.randrange(2, 9))) for _ in range(80)]
    rows = []
    for i in range(120):
        base = rnd.choice(rows)[2].split(" ")[3:] if rows and rnd.random() < 0.4 else rnd.choices(words, k=rnd.randrange(6, 90))
        rows.append((i, rnd.choice(("p", "q", "r", None)), " ".join(["the", "same", "words", *(w if rnd.random() < 0.9 else rnd.choice(words) for w in base)])))
    rows += [(200, "q", rows[5][2]), (201, "z", "another " * 9), (202, None, "another " * 9 + "é"), (203, "y", "another " * 9 + "é!")]
    df = spark.createDataFrame(rows, "id long, paper string, text string")
    first, owners = {}, {}
    for i, p, t in rows:
        first.setdefault(t, i)
        owners.setdefault(t, set()).update([p] if p else [])
    of = lambda t: t.split(" ")[0]
    two = lambda x, y: len(owners[x]) > 1 or len(owners[y]) > 1 or (owners[x] and owners[y] and owners[x] != owners[y])
    want = {(first[x], first[y], round(r, 3)) for x in first for y in first if first[x] < first[y] and of(x) == of(y) and two(x, y) and (r := SequenceMatcher(None, x, y).ratio()) > 0.55}
    assert len(want) > 15
    for chars in (dedup.BLOCK_CHARS, 4000, 700):
        monkeypatch.setattr(dedup, "BLOCK_CHARS", chars)
        got = [tuple(r) for r in dedup.near_duplicates(df, "id", "paper", "text").collect()]
        assert sorted(r[:3] for r in got if r[3] == "pair") == sorted(want), chars
        assert sorted(r[:2] for r in got if r[3] == "copy") == sorted((first[t], i) for i, _, t in rows if first[t] != i)


def test_unlike_texts_are_told_without_going_through_them(monkeypatch):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rnd.randrange(2, 9))) for _ in range(500)]
    texts = [" ".join(["the", "same", "words", *rnd.choices(words, k=400)]) for _ in range(30)]
    texts += [texts[0] + " end", texts[1][:-9]]
    gone, ratio = [], dedup.Alike.ratio
    monkeypatch.setattr(dedup.Alike, "ratio", lambda self, a, m: gone.append(a) or ratio(self, a, m))
    b = dedup.Block(list(range(32)), [str(i) for i in range(32)], [str(i) for i in range(32)], texts)
    assert sorted(r[:2] for r in dedup.alike_pairs(b, b, 0.55)) == [(0, 30), (1, 31)]
    assert len(gone) < 30  # of 496 pairs
