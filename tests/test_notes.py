"""Markdown notes as HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.notes import notes_html

NOTE = """# Title & more
## First `a, b` topic

*Priority: HIGH. About **3** marks*
Text with *stress* and a <tag>.
| Name | Use |
|---|:-:|
| one \\| two | `x,y` |
| three |
- item
- **next**
Exam tip: look
**Exam tip:** again
## Second
| lone bar
| A | B | C |
|--|--|--|
| 1 | """ + "word " * 15 + """| 3 | 4 |

odd ` tick"""


def test_notes(spark):
    r = spark.createDataFrame([(NOTE,), (None,), ("",)], "t string").select(notes_html(F.col("t")).alias("h")).collect()
    body = r[0].h.body.split("\n")
    assert body[:5] == ["<h1>Title &amp; more</h1>", '<h2 id="first-a-b-topic">First <code>a,<wbr> b</code> topic</h2>', '<p class="prio">Priority: <b>HIGH</b> · About <strong>3</strong> marks</p>', "<p>Text with <em>stress</em> and a &lt;tag&gt;.</p>",
                        "<table><thead><tr><th>Name</th><th>Use</th></tr></thead><tbody><tr><td>one | two</td><td><code>x,<wbr>y</code></td></tr><tr><td>three</td></tr></tbody></table>"]
    assert body[5:9] == ["<ul><li>item</li>", "<li><strong>next</strong></li></ul>", '<div class="tip"><span class="lab">Exam tip:</span> look</div>', '<div class="tip"><span class="lab">Exam tip:</span> again</div>']
    assert body[9] == '<h2 id="second">Second</h2>' and body[-1] == "<p>odd ` tick</p>"
    assert r[0].h.toc == '<nav class="toc"><div class="lab">In this chapter</div><ol><li><a href="#first-a-b-topic">First a, b topic</a> <span class=t>HIGH</span></li><li><a href="#second">Second</a></li></ol></nav>'
    assert (r[1].h.body, r[1].h.toc) == (r[2].h.body, r[2].h.toc) == ("", "")


def test_wide_tables_become_cards(spark):
    t = "| A | B<x> | C |\n|--|--|--|\n| 1 | " + "word " * 15 + "| 3 | 4 |"
    html = spark.createDataFrame([(t,)], "t string").select(notes_html(F.col("t"))["body"]).first()[0]
    assert html.startswith('<table class="stack">') and '<td data-h="A">1</td>' in html and '<td data-h="C">3</td><td data-h="">4</td>' in html


def test_a_long_note_takes_time_in_proportion(spark):
    import time

    piece = "## head\n| A | B |\n|---|---|\n| 1 | 2 |\n- item\nlast\n"

    def taken(n):
        df = spark.createDataFrame([(piece * n,)], "t string").select(notes_html(F.col("t")).alias("h"))
        began = time.time()
        h = df.first().h
        assert h.body.count("<table>") == h.body.count("<ul>") == h.toc.count("<li>") == n
        return time.time() - began

    taken(100)
    assert taken(6400) < 20 * max(taken(800), 0.2)
