from __future__ import annotations

import io
import json
import zipfile

from pyspark.sql import functions as F

from lectern.functions import papers
from lectern.functions import text as fn
from lectern.operators import quality, segments, sequences
from lectern.sources import readers, writers
from lectern.streaming import upsert


def col(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make(F.col("v")).alias("x")).first()[0]


def test_markdown_questions(spark):
    paper = "# P\n## Question 1 - 5 marks\nDo this. **[2]**\nAnd that. **[3]**\n### Mark scheme\n**Marks: 4**\n## Question 2 - 6 marks\nSay.\n### Mark scheme\n**Marks: 4**\n## Question 3 - 7 marks\nSay.\n"
    rows = readers.markdown_questions(spark.createDataFrame([("p", paper), ("none", "text"), ("null", None)], "paper string, text string")).orderBy("ord").collect()
    assert [(r.q, r.marks, r.header_marks) for r in rows] == [("1", 5, 5), ("2", 4, 6), ("3", 7, 7)]
    assert rows[0].body.startswith("Do this.") and rows[1].ms == "**Marks: 4**" and rows[2].ms is None


def test_question_bank_and_tags(spark, tmp_path):
    (tmp_path / "bank.json").write_text(json.dumps([{"paper": "a", "q": "1", "marks": 3}, {"paper": "a", "q": "2", "dupe_of": "a:1", "also_in": ["b:1"]}]))
    bank = readers.question_bank(spark, str(tmp_path / "bank.json")).orderBy("q").collect()
    assert bank[0].dupe_of is None and bank[1].also_in == ["b:1"]
    (tmp_path / "t1.jsonl").write_text('{"id": "x", "topics": ["1.1"]}\n\n{"id": "y", "topics": []}\n')
    (tmp_path / "t2.jsonl").write_text('{"id": "x", "topics": ["2.2"]}\n')
    assert {r.id: r.topics for r in readers.tag_lines(spark, str(tmp_path / "t*.jsonl")).collect()} == {"x": ["2.2"], "y": []}


def test_taxonomy_and_newest(spark):
    t = spark.createDataFrame([('{"1": {"name": "A", "subtopics": {"1.1": "a", "1.2": "b"}}, "2": {"name": "B", "subtopics": {}}}',)], "value string")
    assert {(r.topic, r.sub) for r in readers.taxonomy(t).collect()} == {("1", "1.1"), ("1", "1.2"), ("2", None)}
    n = spark.createDataFrame([('{"_note": {"paper": "x"}, "c": {"paper": "1", "questions": [{"q": "1", "marks": 2, "tags": ["1.1"]}]}}',)], "value string")
    assert [(r.code, r.q, r.marks) for r in readers.newest_papers(n).collect()] == [("c", "1", 2)]


def test_grade_rows(spark):
    t = spark.createDataFrame([("c", "head\n Component 11  70 55 46 38 30 -\nComponent 12 70 1 2 3 4 5\nelse"), ("e", "")], "code string, text string")
    rows = readers.grade_rows(t).orderBy("component").collect()
    assert [(r.component, r.max, r.A, r.E) for r in rows] == [("11", 70, 55, None), ("12", 70, 1, 5)]


def test_option_rows(spark):
    t = spark.createDataFrame([("s25", "head\n  AX 400  11, 21,  31   – 250 210 170 130 90\nAXJ  12, 22 300 1 2 3 4 5 \nAX 400 11 1 2 3 4 5 6\nelse"), ("e", ""), ("n", None)], "code string, text string")
    rows = readers.option_rows(t).orderBy("option").collect()
    assert [tuple(r) for r in rows] == [("s25", "AX", ["11", "21", "31"], 400, None, 250, 210, 170, 130, 90), ("s25", "AXJ", ["12", "22"], None, 300, 1, 2, 3, 4, 5)]


def test_unpacked_archives(spark, tmp_path):
    def pack(files):
        b = io.BytesIO()
        with zipfile.ZipFile(b, "w") as z:
            for name, raw in files:
                z.writestr(name, raw)
        return b.getvalue()

    (tmp_path / "a.zip").write_bytes(pack([("d/x.txt", b"1"), ("e/x.txt", b"2"), ("in.zip", pack([("x.txt", b"3")])), ("Thumbs.db", b"")]))
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    rows = readers.unpacked(spark, str(tmp_path)).collect()
    assert {r.name: bytes(r.content) for r in rows} == {"x.txt": b"1", "x__dup1.txt": b"2", "x__dup2.txt": b"3"}
    assert readers.files(spark, str(tmp_path), "*.zip").count() == 2


def test_job_names(spark):
    names = {r.name for r in readers.job_names(spark, ["m", "s"], range(2017, 2019), ["11", "12"], ["qp", "ms"]).collect()}
    assert len(names) == 16 and "9626_s18_ms_12" in names


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "a", None)], "id int, g string, t string")
    writers.partitioned_json(df, str(tmp_path / "j"), "g", ["id"])
    assert spark.read.json(str(tmp_path / "j")).count() == 3
    writers.rendered(df, str(tmp_path / "r"), ["g"], F.concat_ws(" | ", "id", "t"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["1 | x", "2 | y", "3"]
    writers.split_output(df, F.col("t") == "x", str(tmp_path / "k"), str(tmp_path / "o"))
    assert (spark.read.parquet(str(tmp_path / "k")).count(), spark.read.parquet(str(tmp_path / "o")).count()) == (1, 2)
    p = spark.createDataFrame([(1, "x", "z")], "id int, find string, put string")
    once = writers.patched(df, p, "id", "t")
    assert {r.id: r.t for r in writers.patched(once, p, "id", "t").collect()} == {1: "z", 2: "y", 3: None}


def test_upsert_stream_keeps_the_latest(spark, tmp_path):
    src = tmp_path / "in"
    for n, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c")], [(1, 1, "late")]]):
        spark.createDataFrame(rows, "k int, t int, v string").coalesce(1).write.parquet(str(src / str(n)))
    for n in range(3):
        s = spark.readStream.schema("k int, t int, v string").option("maxFilesPerTrigger", 1).parquet(str(src / "*"))
        upsert.upsert_stream(s, "k", ["t"], str(tmp_path / "home"), str(tmp_path / "cp")).awaitTermination()
    last = max((tmp_path / "home").iterdir(), key=lambda p: int(p.name[2:]))
    assert {r.k: r.v for r in spark.read.parquet(str(last)).collect()} == {1: "c", 2: "b"}


def test_text_functions(spark):
    assert col(spark, "a “b” – c…ﬁ", fn.quote_norm) == 'a "b" - c...fi'
    assert col(spark, "![x](y.png) Say 9626/12 **[3]** now....", fn.duplicate_norm) == "img say now"
    assert col(spark, "x [2] y [16]", fn.marks_in) == 18 and col(spark, "none", fn.marks_in) is None
    assert col(spark, "We discuss it", lambda c: fn.first_of(c, papers.FIRST_MATCH)) == "Discuss"
    assert col(spark, "Then Explain it", lambda c: fn.first_of(c, papers.FIRST_MATCH)) == "Explain" and col(spark, "", lambda c: fn.first_of(c, papers.FIRST_MATCH)) is None
    assert col(spark, "9626_s24_qp_02", fn.code_parts) == ("s", 2024, "02", "2") and col(spark, "bad", fn.code_parts) is None
    assert col(spark, "1h 45m", fn.minutes) == 105 and col(spark, "50m", fn.minutes) == 50
    assert col(spark, "<p>a&amp;b</p><script>x</script><br>c", fn.html_text) == "a&b\n c".replace("\n ", "\n")
    assert col(spark, "one two three", lambda c: fn.clipped(c, 9)) == "one two…"
    assert spark.range(1).select(fn.listed(F.array(F.lit("a"), F.lit("b"), F.lit("c")))).first()[0] == "a, b and c"
    assert spark.range(1).select(fn.percent(F.lit(1), F.lit(0)), fn.percent(F.lit(1), F.lit(4))).first()[:] == (0.0, 25.0)


def test_segments(spark):
    starts = spark.range(1).select(segments.accepted_starts(F.array(*(F.lit(x).cast("int") for x in (3, 1, None, 2, 9, 3)))).alias("x")).first().x
    assert starts == [1, 3, 5]


def test_quality_rules_of_tables(spark):
    lines = spark.createDataFrame([("| a | b | c |",), ("| a \\| b | c |",), ("text",)], "line string")
    assert [r.line for r in quality.malformed_rows(lines, "line").collect()] == ["| a \\| b | c |"]
    stored = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, print string")
    now = spark.createDataFrame([("a", "1"), ("b", "x")], "k string, print string")
    assert {r.k: r.stale for r in quality.stale(stored, now, "k").collect()} == {"a": False, "b": True, "c": True}


def test_as_of_takes_facts_at_the_same_time(spark):
    rows = spark.createDataFrame([("u", 1), ("u", 5), ("v", 1)], "g string, t int")
    facts = spark.createDataFrame([("u", 1, 10), ("u", 3, 30), ("u", 3, 20)], "g string, t int, x int")
    assert {(r.g, r.t): r.y for r in sequences.as_of(rows, facts, ["g"], "t", "x", "y").collect()} == {("u", 1): 10, ("u", 5): 30, ("v", 1): None}


def test_cut_texts_that_end_with_a_line_end(spark):
    """Only what follows the last line end goes; a line end or another line separator at the cut doesn't take the line before with it."""
    assert col(spark, "ab\ncd\nef", lambda c: fn.truncated(c, 6)) == "ab\ncd\n..." and col(spark, "ab\ncd\r\nef", lambda c: fn.truncated(c, 6)) == "ab\n..."
    assert col(spark, "ab\ncd\u2028\nef", lambda c: fn.truncated(c, 7)) == "ab\ncd\u2028\n..."
    assert col(spark, "a b\ncd e", lambda c: fn.clipped(c, 4)) == "a…"
