"""Topic files as they are written."""

from __future__ import annotations

from pathlib import Path

from lectern.operators import topics

UNITS = "id string, paper string, q string, part string, stem string, part_stem string, text string, ms string, marks int, dupe_of string, also_in array<string>, extra int"


def test_topic_files_in_order(spark, tmp_path):
    units = spark.createDataFrame([
        ("late", "9626_w23_qp_32", "10", None, "Stem", None, "a|b", "yes", 2, None, ["twin", "gone"], 1),
        ("twin", "9626_w23_qp_33", "9", "b", None, None, "a|b", "yes", 2, "late", None, 1),
        ("early", "9626_m23_qp_02", "2", None, None, None, None, None, None, None, [], 1),
        ("nine", "9626_w23_qp_32", "9", None, None, None, "x", " ", 1, None, None, 1),
        ("untagged", "9626_w23_qp_32", "1", None, None, None, "x", "y", 1, None, None, 1),
        ("odd", "no code", "1", None, None, None, "x", "y", 1, None, None, 1),
    ], UNITS)
    tags = spark.createDataFrame([("late", ["1.10", "1.2", "1.2"]), ("nine", ["1.10", "9.9"]), ("early", ["1.10"]), ("twin", ["1.2"]), ("odd", ["1.2"]), ("untagged", None)], "id string, topics array<string>")
    taxonomy = spark.createDataFrame([("1", "A/B: c", "1.2", "two"), ("1", "A/B: c", "1.10", "ten"), ("2", "None", None, None)], "topic string, topic_name string, sub string, sub_name string")
    files = topics.topic_files(units, tags, taxonomy)
    rows = files.where("paper = '3'").orderBy(*topics.ORDER).collect()
    assert [(r.sub, r.id) for r in rows] == [(None, None), ("1.2", None), ("1.2", "late"), ("1.10", None), ("1.10", "nine"), ("1.10", "late")]
    block = rows[2].block
    assert block.startswith("#### P 32 + 33 | W 2023 | [[9626_w23_qp_32.pdf|Question P32]] | [[9626_w23_ms_32.pdf|Answer P32]] | [[9626_w23_qp_33.pdf|Question P33]]")
    assert "| 10 / 9b | Stem<br>a\\|b | 2 |" in block and "| 10 / 9b | yes | 2 |" in block
    assert "| 9 | *Mark scheme is a diagram — see the linked PDF.* | 1 |" in rows[4].block
    topics.write_topic_files(files, str(tmp_path / "t"))
    made = {p.parent.parent.name + "/" + p.parent.name for p in Path(tmp_path / "t").rglob("part-*")}
    assert {m.split("/")[0] for m in made} >= {"paper=2", "paper=3"}
    assert files.where("paper is null or block is null").count() == 0
    text = spark.read.text(str(tmp_path / "t" / "paper=3")).count()
    assert text > 6
    assert topics.topic_files(units.limit(0), tags, taxonomy).collect() == []
