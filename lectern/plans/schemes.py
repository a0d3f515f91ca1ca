"""Queries of questions and their mark schemes. Each document is a question: its words in runs of thirty are the parts, and a scheme reprints them in one of several ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import notes
from lectern.operators import schemes
from lectern.plans.base import query, table

#: q, text, scheme, stated. By q mod 7: a block for each leaf; blocks of several leaves; the same with leaves without marks; leaves in the opposite order; headings that are too short; no parts at all.
QUESTIONS = r"""
wd AS (SELECT doc_id AS q, doc_id % 7 AS v, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
ck AS (SELECT q, v, unnest(list_transform(generate_series(0, (len(w) - 1) // 30), lambda k: {'k': k, 'c': array_to_string(w[30 * k + 1:30 * k + 30], ' '), 'h': array_to_string(w[30 * k + 1:30 * k + CASE WHEN v = 4 THEN 4 ELSE 12 END], ' ')})) AS x FROM wd WHERE len(w) > 0),
pt AS (SELECT q, v, x.k AS k, x.c AS c, x.h AS h, x.k % 4 AS r FROM ck),
qs AS (SELECT q, any_value(v) AS v,
  CASE WHEN any_value(v) = 5 THEN string_agg(c, chr(10) ORDER BY k) ELSE 'Read this first.' || chr(10) || string_agg('- (' || CASE r WHEN 0 THEN chr(CAST(97 + k // 4 % 8 AS INTEGER)) WHEN 1 THEN 'i' WHEN 2 THEN 'ii' ELSE chr(CAST(112 + k // 4 % 8 AS INTEGER)) END || ') ' || c
    || CASE WHEN r = 0 OR (v = 6 AND r = 3) THEN '' ELSE ' **[2]**' END || CASE WHEN k % 5 = 0 THEN chr(10) || 'more ' || k ELSE '' END, chr(10) ORDER BY k) END AS text,
  coalesce(string_agg(replace(h, 'a', 'A') || chr(10) || 'answer ' || k || CASE WHEN v IN (0, 5) THEN chr(10) || '**Marks: 2**' WHEN k % 2 = 1 THEN chr(10) || '**Marks: 1**' ELSE '' END, chr(10) ORDER BY CASE WHEN v = 3 THEN -k ELSE k END) FILTER (WHERE r <> 0), '')
    || CASE WHEN any_value(v) IN (1, 2) THEN chr(10) || 'Notes at the end' ELSE '' END AS scheme, q % 50 AS stated FROM pt GROUP BY q)"""


def made_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("q"), (F.col("doc_id") % 7).alias("v"), w.alias("w")).where("size(w) > 0")
    ks = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 30).cast("int"))
    v, nl = F.col("v"), F.lit("\n")
    run = lambda k, n: F.array_join(F.slice("w", 30 * k + 1, n), " ")
    letter = lambda a, k: F.char((a + F.floor(k / 4) % 8).cast("long"))

    def part(k: Column) -> Column:
        r = k % 4
        label = F.when(r == 0, letter(97, k)).when(r == 1, "i").when(r == 2, "ii").otherwise(letter(112, k))
        return F.concat(F.lit("- ("), label, F.lit(") "), run(k, F.lit(30)), F.when((r == 0) | ((v == 6) & (r == 3)), "").otherwise(" **[2]**"), F.when(k % 5 == 0, F.concat(F.lit("\nmore "), k.cast("string"))).otherwise(""))

    def row(k: Column) -> Column:
        end = F.when(v.isin(0, 5), "\n**Marks: 2**").when(k % 2 == 1, "\n**Marks: 1**").otherwise("")
        return F.concat(F.replace(run(k, F.when(v == 4, 4).otherwise(12)), F.lit("a"), F.lit("A")), F.lit("\nanswer "), k.cast("string"), end)

    text = F.when(v == 5, F.array_join(F.transform(ks, lambda k: run(k, F.lit(30))), "\n")).otherwise(F.concat(F.lit("Read this first.\n"), F.array_join(F.transform(ks, part), "\n")))
    leaves = F.filter(ks, lambda k: k % 4 != 0)
    rows = F.array_join(F.transform(F.when(v == 3, F.reverse(leaves)).otherwise(leaves), row), "\n")
    return d.select("q", text.alias("text"), F.concat(rows, F.when(v.isin(1, 2), F.concat(nl, F.lit("Notes at the end"))).otherwise("")).alias("scheme"), (F.col("q") % 50).alias("stated"))


STRIP = r"regexp_replace({}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')".format
PART, MARK, END = schemes.PART, schemes.MARK, schemes.BLOCK_END
NORM = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))".format
MARKS = f"list_sum(list_transform(regexp_extract_all({{}}, '{MARK}', 1), lambda m: CAST(m AS BIGINT)))".format
#: Lines are rows here, and nodes, blocks and cuts come from numbering them.
LEAVES = rf"""{QUESTIONS},
ql AS (SELECT q, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM qs),
qn AS (SELECT *, count(*) FILTER (WHERE regexp_matches(line, '{PART}')) OVER (PARTITION BY q ORDER BY i) AS n FROM ql),
nd AS (SELECT q, n, lower(regexp_extract(arg_min(line, i), '{PART}', 1)) AS label, {STRIP(f"string_agg(CASE WHEN regexp_matches(line, '{PART}') THEN regexp_replace(line, '{PART}', '') ELSE line END, chr(10) ORDER BY i)")} AS text FROM qn GROUP BY q, n),
nl AS (SELECT *, n > 1 AND label IN {schemes.ROMANS} AS roman FROM nd WHERE n > 0),
nk AS (SELECT *, lead(roman, 1, FALSE) OVER (PARTITION BY q ORDER BY n) AS below, max(CASE WHEN NOT roman THEN n END) OVER (PARTITION BY q ORDER BY n) AS top FROM nl),
lf AS (SELECT k.q, row_number() OVER (PARTITION BY k.q ORDER BY k.n) - 1 AS nth, CASE WHEN k.roman THEN '(' || t.label || ')(' || k.label || ')' ELSE '(' || k.label || ')' END AS part, CASE WHEN k.roman THEN t.text ELSE '' END AS part_stem, k.text AS own
  FROM nk k JOIN nl t ON t.q = k.q AND t.n = k.top WHERE k.roman OR NOT k.below)"""


@query(f"WITH {LEAVES} SELECT q, nth, part, md5(part_stem) AS stem_md5, md5(own) AS own_md5, coalesce({MARKS('own')}, 0)::BIGINT AS marks FROM lf")
def f02_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the leaves of a question, with what stands under the letter above a roman part."""
    x = made_questions(spark, sf_dir).select("q", F.posexplode(schemes.question_leaves(F.col("text"))["parts"]).alias("nth", "p"))
    md = lambda c: F.md5(c.cast("binary"))
    return x.select("q", F.col("nth").cast("long").alias("nth"), "p.label", md(F.col("p.stem")).alias("stem_md5"), md(F.col("p.text")).alias("own_md5"), F.coalesce(schemes.printed_marks(F.col("p.text")), F.lit(0)).alias("marks")).withColumnRenamed("label", "part")


@query(rf"""WITH RECURSIVE {LEAVES},
sl AS (SELECT q, generate_subscripts(string_split(scheme, chr(10)), 1) AS i, unnest(string_split(scheme, chr(10))) AS line FROM qs),
sb AS (SELECT *, regexp_matches(line, '{END}') AS ends, coalesce(sum(CAST(regexp_matches(line, '{END}') AS INT)) OVER (PARTITION BY q ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM sl),
bl AS (SELECT q, b, {STRIP("coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT ends), '')")} AS t, max(CASE WHEN ends THEN CAST(regexp_extract(line, '{END}', 1) AS BIGINT) END) AS m FROM sb GROUP BY q, b),
bn AS (SELECT *, lead(t) OVER w AS after, lead(m) OVER w AS after_m, lead(b) OVER w AS next FROM bl WINDOW w AS (PARTITION BY q ORDER BY b)),
bk AS (SELECT q, b AS nth, CASE WHEN next IS NOT NULL AND after_m IS NULL AND after <> '' THEN t || chr(10) || chr(10) || after ELSE t END AS answer, m FROM bn WHERE m IS NOT NULL OR (b = 0 AND t <> '')),
ct AS (SELECT qs.q, qs.text, stated, {MARKS('qs.text')} AS whole, (SELECT count(*) FROM lf WHERE lf.q = qs.q) AS n, (SELECT count(*) FROM bk WHERE bk.q = qs.q) AS nb, (SELECT count({MARKS('own')}) FROM lf WHERE lf.q = qs.q) AS marked, (SELECT sum({MARKS('own')}) FROM lf WHERE lf.q = qs.q) AS summed FROM qs),
bs AS (SELECT q, regexp_replace(scheme, '(?m)^\s*\*\*Marks:\s*\d+\*\*\s*$', '', 'g') AS bare FROM qs),
bt AS (SELECT q, generate_subscripts(string_split(bare, chr(10)), 1) - 1 AS i, unnest(string_split(bare, chr(10))) AS line FROM bs),
fl AS (SELECT q, i, line, {NORM('line')} || ' ' AS f, coalesce(sum(length({NORM('line')}) + 1) OVER (PARTITION BY q ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM bt),
fw AS (SELECT q, string_agg(f, '' ORDER BY i) AS flat, list(start ORDER BY i) AS starts, list(line ORDER BY i) AS lines FROM fl GROUP BY q),
ky AS (SELECT lf.q, lf.nth, array_to_string(string_split({NORM(f"regexp_replace(regexp_replace(own, '{MARK}', ' ', 'g'), '[(][^)]*[)]', ' ', 'g')")}, ' ')[1:6], ' ') AS key FROM lf JOIN ct USING (q) WHERE ct.n <> ct.nb AND ct.marked = ct.n AND ct.summed = ct.whole),
an AS (SELECT q, CAST(-1 AS BIGINT) AS nth, CAST(0 AS BIGINT) AS pos, CAST(-1 AS BIGINT) AS cut FROM (SELECT DISTINCT q FROM ky)
  UNION ALL
  SELECT q, nth, pos + hit - 1 + length(key), line FROM (SELECT *, len(list_filter(starts, lambda s: s <= pos + hit - 1)) - 1 AS line FROM
    (SELECT an.q, ky.nth, an.pos, an.cut, ky.key, fw.starts, CAST(strpos(substr(fw.flat, an.pos + 1), ky.key) AS BIGINT) AS hit FROM an JOIN ky ON ky.q = an.q AND ky.nth = an.nth + 1 JOIN fw ON fw.q = an.q WHERE ky.key <> '') WHERE hit > 0) WHERE line > cut),
ok AS (SELECT an.q FROM an JOIN ct USING (q) WHERE an.nth >= 0 GROUP BY an.q, ct.n HAVING count(*) = ct.n),
cu AS (SELECT an.q, an.nth, CASE WHEN an.nth = 0 THEN 0 ELSE cut END AS a, lead(cut) OVER (PARTITION BY an.q ORDER BY an.nth) AS b FROM an JOIN ok USING (q) WHERE an.nth >= 0),
ca AS (SELECT cu.q, cu.nth, {STRIP("array_to_string(lines[a + 1:coalesce(b, len(lines))], chr(10))")} AS answer FROM cu JOIN fw USING (q)),
un AS (SELECT lf.q, lf.nth, part, own, bk.answer, coalesce({MARKS('own')}, bk.m) AS marks, 'part' AS split FROM lf JOIN ct USING (q) JOIN bk ON bk.q = lf.q AND bk.nth = lf.nth WHERE ct.n = ct.nb
  UNION ALL SELECT lf.q, lf.nth, part, own, ca.answer, {MARKS('own')}, 'part' FROM lf JOIN ca ON ca.q = lf.q AND ca.nth = lf.nth
  UNION ALL SELECT q, 0, NULL, text, coalesce((SELECT string_agg(answer, chr(10) || chr(10) ORDER BY nth) FROM bk WHERE bk.q = ct.q), ''), coalesce(whole, CASE WHEN nb = 1 THEN (SELECT max(m) FROM bk WHERE bk.q = ct.q) END, stated), CASE WHEN n > 0 THEN 'whole' ELSE 'single' END
    FROM ct WHERE (n = 0 OR n <> nb) AND q NOT IN (SELECT q FROM ok))
SELECT q, nth, part, md5(own) AS own_md5, md5(answer) AS answer_md5, CAST(marks AS BIGINT) AS marks, split FROM un""")
def d07_question_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves with their blocks by place if there are as many, else with the scheme cut at the leaves' first six words, else the question whole."""
    u = schemes.question_units(made_questions(spark, sf_dir))
    md = lambda c: F.md5(F.col(c).cast("binary"))
    return u.select("q", F.col("nth").cast("long").alias("nth"), "part", md("own").alias("own_md5"), md("answer").alias("answer_md5"), "marks", "split")


ESC = "replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')".format
SLUG = "regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')".format


@query(rf"""WITH wd AS (SELECT doc_id AS q, list_filter(string_split_regex(regexp_replace(text, '[`*|\\]', '', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lx AS (SELECT q, len(w) AS nw, unnest(list_transform(generate_series(0, (len(w) - 1) // 6), lambda n: {{'n': n, 't': array_to_string(w[6 * n + 1:6 * n + 6], ' ')}})) AS x FROM wd WHERE len(w) > 0),
ln AS (SELECT q, x.n AS n, x.n // 9 AS k, x.n % 9 AS r, {ESC('x.t')} AS t, (nw - 1) // 6 AS last, CASE WHEN x.n % 4 = 0 THEN {ESC("x.t || ' ' || x.t")} ELSE {ESC('x.t')} END AS wide FROM lx),
tb AS (SELECT q, k, max(greatest(length(t), length(wide))) FILTER (WHERE r IN (4, 5)) > 60 AS cards FROM ln WHERE r BETWEEN 2 AND 5 GROUP BY q, k HAVING bool_or(r = 3)),
hd AS (SELECT ln.*, cards FROM ln JOIN tb USING (q, k) WHERE r = 2),
rw AS (SELECT ln.q, ln.k, string_agg('<tr><td' || CASE WHEN hd.cards THEN ' data-h="' || hd.t || '"' ELSE '' END || '>' || ln.t || '</td><td' || CASE WHEN hd.cards THEN ' data-h="b"' ELSE '' END || '><code>x,<wbr>y</code></td><td' || CASE WHEN hd.cards THEN ' data-h="c"' ELSE '' END || '>' || ln.wide || '</td></tr>', '' ORDER BY ln.n) AS rows
  FROM ln JOIN hd ON hd.q = ln.q AND hd.k = ln.k WHERE ln.r IN (4, 5) GROUP BY ln.q, ln.k),
ht AS (SELECT q, n, r, k, t, CASE r WHEN 0 THEN '<h2 id="' || {SLUG('t')} || '">' || t || '</h2>' WHEN 1 THEN CASE WHEN n % 2 = 0 THEN '<p class="prio">Priority: <b>HIGH</b> · ' || t || '</p>' ELSE '<div class="tip"><span class="lab">Exam tip:</span> ' || t || '</div>' END
    WHEN 2 THEN CASE WHEN last = n THEN '<p>| ' || t || ' | b | c |</p>' ELSE (SELECT CASE WHEN cards THEN '<table class="stack">' ELSE '<table>' END || '<thead><tr><th>' || t || '</th><th>b</th><th>c</th></tr></thead><tbody>' || coalesce((SELECT rows FROM rw WHERE rw.q = ln.q AND rw.k = ln.k), '') || '</tbody></table>' FROM tb WHERE tb.q = ln.q AND tb.k = ln.k) END
    WHEN 6 THEN '<ul><li>' || t || '</li>' || CASE WHEN last = n THEN '</ul>' ELSE '' END WHEN 7 THEN '<li><strong>' || t || '</strong></li></ul>' WHEN 8 THEN '<p>' || t || ' <code>a,<wbr> b</code></p>' END AS h FROM ln)
SELECT q, md5(string_agg(h, chr(10) ORDER BY n)) AS body_md5, md5('<nav class="toc"><div class="lab">In this chapter</div><ol>' || string_agg('<li><a href="#' || {SLUG('t')} || '">' || t || '</a>' || CASE WHEN tier THEN ' <span class=t>HIGH</span>' ELSE '' END || '</li>', '' ORDER BY n) FILTER (WHERE r = 0) || '</ol></nav>') AS toc_md5
FROM (SELECT *, coalesce(lead(n) OVER (PARTITION BY q ORDER BY n) % 2 = 0, FALSE) AS tier FROM ht) GROUP BY q""")
def h25_notes_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes with headings, labels, tips, tables, lists and code as HTML, and their contents."""
    words = F.filter(F.split(F.regexp_replace("text", r"[`*|\\]", ""), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("q"), words.alias("w")).where("size(w) > 0")
    put = lambda a, t, b="": F.concat(F.lit(a), t, F.lit(b))

    def line(n: Column) -> Column:
        t, r = F.array_join(F.slice("w", 6 * n + 1, F.lit(6)), " "), n % 9
        wide = F.when(n % 4 == 0, F.concat(t, F.lit(" "), t)).otherwise(t)
        x = F.when(r == 0, put("## ", t)).when(r == 1, F.when(n % 2 == 0, put("*Priority: HIGH. ", t, "*")).otherwise(put("Exam tip: ", t))).when(r == 2, put("| ", t, " | b | c |")).when(r == 3, "|---|---|---|")
        return x.when(r.isin(4, 5), F.concat(F.lit("| "), t, F.lit(" | `x,y` | "), wide, F.lit(" |"))).when(r == 6, put("- ", t)).when(r == 7, put("- **", t, "**")).otherwise(put("", t, " `a, b`"))

    note = F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 6).cast("int")), line), "\n")
    h = d.select("q", notes.notes_html(note).alias("h"))
    return h.select("q", F.md5(F.col("h.body").cast("binary")).alias("body_md5"), F.md5(F.col("h.toc").cast("binary")).alias("toc_md5"))
