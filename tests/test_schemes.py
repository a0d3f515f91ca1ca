"""Questions and their mark schemes, against plain loops."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from lectern.operators import schemes

WHITE = " \t\n\x0b\x0c\r"


def plain_leaves(text):
    nodes = []
    for line in text.split("\n"):
        if m := re.match(r"[ \t]*-[ \t]*\(([a-z]|i{1,3}|iv|v|vi{1,3})\)[ \t]*", line, re.I):
            nodes.append([m.group(1).lower(), bool(nodes) and m.group(1).lower() in schemes.ROMANS, [line[m.end() :]]])
        elif nodes:
            nodes[-1][2].append(line)
    out, above = [], None
    for k, (label, roman, lines) in enumerate(nodes):
        own = "\n".join(lines).strip(WHITE)
        if roman:
            out.append((f"({above[0]})({label})", above[1], own))
        else:
            above = (label, own)
            if not (k + 1 < len(nodes) and nodes[k + 1][1]):
                out.append((f"({label})", "", own))
    return out


def plain_blocks(scheme):
    blocks, own = [], []
    for line in scheme.split("\n"):
        if m := re.fullmatch(schemes.BLOCK_END[1:-1], line):
            blocks.append(["\n".join(own).strip(WHITE), int(m.group(1))])
            own = []
        else:
            own.append(line)
    if tail := "\n".join(own).strip(WHITE):
        if blocks:
            blocks[-1][0] += "\n\n" + tail
        else:
            blocks.append([tail, None])
    return blocks


def plain_cuts(scheme, parts):
    norm = lambda s: re.sub("[^a-z0-9]+", " ", s.lower()).strip(" ")
    lines = re.sub(r"(?m)^\s*\*\*Marks:\s*[0-9]+\*\*\s*$", "", scheme).split("\n")
    flat, of_line = "", []
    for k, line in enumerate(lines):
        more = norm(line) + " "
        flat += more
        of_line += [k] * len(more)
    at, cuts = 0, []
    for p in parts:
        key = " ".join(norm(re.sub(r"\([^)]*\)", " ", re.sub(schemes.MARK, " ", p))).split(" ")[:6])
        hit = flat.find(key, at)
        if not key or hit < 0 or (cuts and of_line[hit] <= cuts[-1]):
            return None
        cuts.append(of_line[hit])
        at = hit + len(key)
    cuts[0] = 0
    return ["\n".join(lines[a:b]).strip(WHITE) for a, b in zip(cuts, cuts[1:] + [len(lines)])]


def plain_units(text, scheme, stated):
    marks = lambda t: sum(map(int, found)) if (found := re.findall(schemes.MARK, t)) else None
    leaves, blocks = plain_leaves(text), plain_blocks(scheme)
    own = [marks(t) for _, _, t in leaves]
    if leaves and len(leaves) == len(blocks):
        return [(k, p, s, t, b, m or n, "part") for k, ((p, s, t), (b, n), m) in enumerate(zip(leaves, blocks, own))]
    if leaves and None not in own and sum(own) == marks(text) and (cuts := plain_cuts(scheme, [t for _, _, t in leaves])):
        return [(k, p, s, t, c, m or None, "part") for k, ((p, s, t), c, m) in enumerate(zip(leaves, cuts, own))]
    whole = marks(text) or (blocks[0][1] if len(blocks) == 1 else None) or stated
    return [(0, None, "", text, "\n\n".join(b for b, _ in blocks), whole, "whole" if leaves else "single")]


CASES = [
    ("Stem\n- (a) one two three four five six seven **[2]**\n- (b) eight nine ten\n  - (i) first things first of all now **[1]**\n  - (ii) second things come after that here **[3]**\ntail", "ONE two, three four five six\nx\n**Marks: 2**\nFirst things first of all now\ny\nSecond things come after that here\nz\n**Marks: 1**\nnote"),
    ("- (a) p **[1]**\n- (b) q **[1]**", "p!\n**Marks: 1**\nq!\n**Marks: 1**\nappendix"),
    ("- (a) p **[1]**\n- (b) q **[1]**", "q first\np then"),
    ("- (a) p **[1]**\n- (b) q", "p\nq"),
    ("- (i) starts as a letter **[1]**\n- (ii) then roman **[2]**\n- (v) also **[2]**", "x\n**Marks: 4**"),
    ("no parts **[3]**", "one\n**Marks: 3**"),
    ("no parts", ""),
    ("", "only\n\n  **Marks: 7**  \n"),
    ("- (a)  (see line 6) alpha beta gamma delta eps zeta eta **[0]**\n- (B) same words same words same words **[0]**", "alpha beta gamma delta eps zeta\nsame words same words same words\n"),
    ("- (a) end **[1]**\n- (b) end **[1]**", "end\nend"),
    ("- (a) **[1]**\n- (b) x **[1]**", "x"),
]


def test_units_against_loops(spark):
    rows = [(k, t, s, k % 4 or None) for k, (t, s) in enumerate(CASES)] + [(99, None, None, 5)]
    got = {}
    for r in schemes.question_units(spark.createDataFrame(rows, "q int, text string, scheme string, stated int")).orderBy("q", "nth").collect():
        got.setdefault(r.q, []).append((r.nth, r.part, r.part_stem, r.own, r.answer, r.marks, r.split))
    for k, t, s, stated in rows[:-1]:
        assert got[k] == plain_units(t, s, stated), (k, t, s)
    assert [u[5:] for u in got[99]] == [(5, "single")]
    assert {u[-1] for us in got.values() for u in us} == {"part", "whole", "single"}


def test_made_questions_against_loops(spark, data):
    from lectern.plans.schemes import made_questions

    rows = made_questions(spark, data).collect()
    got = {}
    for r in schemes.question_units(made_questions(spark, data)).orderBy("q", "nth").collect():
        got.setdefault(r.q, []).append((r.nth, r.part, r.part_stem, r.own, r.answer, r.marks, r.split))
    wrong = [r.q for r in rows if got[r.q] != plain_units(r.text, r.scheme, r.stated)]
    assert wrong == []
    kinds = {(r.q % 7, got[r.q][0][-1]) for r in rows}
    assert {(0, "part"), (1, "part"), (2, "part"), (3, "whole"), (4, "whole"), (5, "single"), (6, "whole")} <= kinds


@pytest.mark.parametrize("n", [0, 3])
def test_no_questions(spark, n):
    df = spark.createDataFrame([("x", "y", 1)] * n, "text string, scheme string, stated int")
    assert schemes.question_units(df).count() == n and df.select(F.size(schemes.scheme_blocks(F.col("scheme")))).count() == n
