"""Queries of the operators over papers, mark schemes, reports and plans. The tables' rows stand for such papers; SQL makes the same ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import papers as fn
from lectern.functions import sql as sql_functions
from lectern.operators import joins, papers, reports, sequences, stats
from lectern.operators.dedup import folded
from lectern.plans.base import query, table, tasks_for, units
from lectern.plans.shares import SHARES


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


MARKED = r"'1. ........ **[4]**' || chr(10) || text || ' ........' || chr(10) || '[Turn over]' || chr(10) || '(a) .....' || chr(10) || 'BLANK PAGE' || chr(10) || '12' || chr(10) || 'see copyright acknowledgements' || chr(10) || 'the Local Examinations Syndicate (UCLES)' || chr(10) || 'Cambridge Assessment is the brand name of it' || chr(10) || ' www.dynamicpapers.com ' || chr(10) || chr(10) || chr(10) || chr(10) || 'end «'"
JUNK, ANSWER = fn.JUNK_LINE.replace("'", "''"), fn.ANSWER_LINE


@query(rf"WITH l AS (SELECT doc_id, list_transform(string_split({MARKED}, chr(10)), lambda x: CASE WHEN regexp_matches(x, '{ANSWER}') THEN nullif(regexp_extract(x, '{ANSWER}', 2), '') WHEN regexp_matches(x, '{JUNK}') OR contains(x, 'Permission to reproduce items') OR contains(x, 'reasonable effort has been made by the publisher') OR len(list_filter(['copyright acknowledgements', 'Local Examinations Syndicate', 'Cambridge Assessment is the brand name'], lambda n: contains(x, n))) > 0 THEN NULL ELSE regexp_replace(x, '[ \t]*\.{{6,}}[ \t]*$', '') END) AS l FROM documents), t AS (SELECT doc_id, regexp_replace(regexp_replace(replace(array_to_string(list_filter(l, lambda x: x IS NOT NULL), chr(10)), '«', '...'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[ \t\n]+|[ \t\n]+$', '', 'g') AS t FROM l) SELECT doc_id, md5(t) AS clean_md5, length(t) AS n FROM t")
def c06_bank_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C06 in full, on texts with an answer line, footers, a notice and dot leaders put in."""
    marked = F.concat(F.lit("1. ........ **[4]**\n"), F.col("text"), F.lit(" ........\n[Turn over]\n(a) .....\nBLANK PAGE\n12\nsee copyright acknowledgements\nthe Local Examinations Syndicate (UCLES)\nCambridge Assessment is the brand name of it\n www.dynamicpapers.com \n\n\n\nend «"))
    t = docs(spark, sf_dir).select("doc_id", fn.bank_clean(marked).alias("t"))
    return t.select("doc_id", F.md5(F.col("t").cast("binary")).alias("clean_md5"), F.char_length("t").cast("long").alias("n"))


@query("SELECT o_orderkey, CAST(2000 + o_orderkey % 30 AS INTEGER) AS year, CAST(o_orderkey % 3 AS INTEGER) AS season, lpad(CAST(o_orderkey % 44 AS VARCHAR), 2, '0') AS variant, CAST(o_orderkey % 12 AS INTEGER) AS number, CASE WHEN o_orderkey % 2 = 0 THEN 'b' ELSE '' END AS part, row_number() OVER (PARTITION BY o_orderstatus ORDER BY 2000 + o_orderkey % 30, o_orderkey % 3, lpad(CAST(o_orderkey % 44 AS VARCHAR), 2, '0'), o_orderkey % 12, CASE WHEN o_orderkey % 2 = 0 THEN 'b' ELSE '' END, o_orderkey) AS place FROM orders")
def c05_session_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sort key of codes such as s24 with variant and question 10b, and the place that it gives."""
    k = F.col("o_orderkey")
    code = F.concat(F.element_at(F.array(*map(F.lit, "msw")), (k % 3 + 1).cast("int")), F.lpad((k % 30).cast("string"), 2, "0"))
    q = F.concat((k % 12).cast("string"), F.when(k % 2 == 0, "b").otherwise(""))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", fn.session_sort(code).alias("s"), F.lpad((k % 44).cast("string"), 2, "0").alias("variant"), fn.question_sort(q).alias("q"))
    key = ["s.year", "s.season", "variant", "q.number", "q.part"]
    return o.select("o_orderkey", *key, F.row_number().over(Window.partitionBy("o_orderstatus").orderBy(*key, "o_orderkey")).cast("long").alias("place"))


@query(r"SELECT p_partkey, (h < 7 AND NOT regexp_matches(t, '[A-Za-z0-9]')) OR (bottom > 842 - 60 AND regexp_matches(t, '(?i)UCLES|Turn over|^DC \([A-Z]+\)|[0-9]{4}/[0-9]{2}/ *[A-Z] */ *[A-Z] */ *[0-9]{2}')) AS noise FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '«» ¤' WHEN p_partkey % 3 = 1 THEN '[Turn over' ELSE p_name END AS t, p_size AS h, CAST(p_partkey * 7 % 842 AS INTEGER) AS bottom FROM part)")
def c08_noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 3 == 0, "«» ¤").when(k % 3 == 1, "[Turn over").otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.noise(text, F.col("p_size"), k * 7 % 842, F.lit(842)).alias("noise"))


@query("SELECT c_custkey, array_to_string(list_filter([c_name, CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'x' END], lambda x: x <> ''), chr(10)) AS stem FROM customer")
def c09_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.joined(F.col("c_name"), F.when(F.col("c_nationkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")), F.when(F.col("c_custkey") % 3 != 0, F.lit("x"))).alias("stem"))


@query("SELECT doc_id FROM documents QUALIFY text = '' OR doc_id = min(doc_id) OVER (PARTITION BY text)")
def c10_keepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    return folded(d, [F.sha2(F.col("text").cast("binary"), 256), F.nullif("text", F.lit(""))], F.col("doc_id"), "doc_id").where("dupe_of is null").select("doc_id")


@query(r"SELECT doc_id FROM (SELECT doc_id, text FROM documents QUALIFY text = '' OR doc_id = min(doc_id) OVER (PARTITION BY text)) WHERE length(trim(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g'))) > 30")
def c15_eligible_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c10_keepers(spark, sf_dir).join(docs(spark, sf_dir).where(F.length(fn.squeeze(F.col("text"))) > 30), "doc_id", "left_semi")


@query(r"WITH s AS (SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(trim(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g')), '([.?]) ', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(The |And |Der |La )')), ' ') AS own FROM documents) SELECT doc_id, CASE WHEN len(string_split(own, ' ')) >= 5 AND NOT regexp_matches(own, '(?i)^(In|Un)') THEN md5(own) END AS wording FROM s")
def c16_wording(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fn.wording(F.col("text"), "(?i)^(The |And |Der |La )", "(?i)^(In|Un)")
    return docs(spark, sf_dir).select("doc_id", F.md5(w.cast("binary")).alias("wording"))


TASKS = "tx AS (SELECT p_brand AS paper, p_partkey AS id, 'Open the file n' || p_size || 'data.csv and Plan_' || (p_partkey % 7) || '.TXT. ' || CASE WHEN p_partkey % 9 = 0 THEN 'Save your work as n' || (p_size + 1) || 'DATA.csv now.' ELSE 'See plan_3 again.' END AS text FROM part)"


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    last = F.when(k % 9 == 0, F.concat(F.lit("Save your work as n"), size + 1, F.lit("DATA.csv now."))).otherwise("See plan_3 again.")
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("paper"), k.alias("id"), F.concat(F.lit("Open the file n"), size, F.lit("data.csv and Plan_"), k % 7, F.lit(".TXT. "), last).alias("text"))


@query(rf"WITH {TASKS}, s AS (SELECT DISTINCT paper, lower(unnest(regexp_extract_all(text, '(?i)(?:save|saved|saving|store)\b[^.]{{0,80}}?\bas\s+(?:a\s+\w+\s+)?([A-Za-z0-9][\w.\-]{{0,40}}?\.(?:{fn.ENDINGS}))', 1))) AS low FROM tx), n AS (SELECT paper, id, unnest(list_distinct(regexp_extract_all(text, '([A-Za-z0-9][A-Za-z0-9_.\-]*\.(?:{fn.ENDINGS}|TXT))', 1))) AS name FROM tx) SELECT paper, id, name FROM n WHERE NOT regexp_matches(name, '\.TXT$') AND NOT EXISTS (SELECT 1 FROM s WHERE s.paper = n.paper AND s.low = lower(n.name))")
def c19_inputs_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.inputs_named(tasks(spark, sf_dir))


@query(rf"WITH {TASKS}, f AS (SELECT DISTINCT p_brand AS paper, 'Plan_' || (p_size % 7) AS stem, 'txt' AS ending FROM part WHERE p_size < 25 UNION SELECT DISTINCT p_brand, 'plan_3', 'ods' FROM part UNION SELECT DISTINCT p_brand, 'again', 'rtf' FROM part) SELECT paper, id, stem || '.' || ending AS file FROM tx JOIN f USING (paper) WHERE regexp_matches(text, '(?i)' || stem || '\s*\.?\s*' || ending || '\b') OR (length(stem) >= 5 AND regexp_matches(stem, '[_0-9]|[a-z][A-Z]') AND regexp_matches(text, '(^|[^\w.])' || stem || '($|[^\w.])'))")
def c20_files_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a paper that its texts name, in full or by a distinctive stem."""
    p = table(spark, sf_dir, "part")
    brands = p.select(F.col("p_brand").alias("paper")).distinct()
    plans = p.where("p_size < 25").select(F.col("p_brand").alias("paper"), F.concat(F.lit("Plan_"), F.col("p_size") % 7).alias("stem"), F.lit("txt").alias("ending")).distinct()
    more = brands.select("paper", F.explode(F.array(F.struct(F.lit("plan_3").alias("stem"), F.lit("ods").alias("ending")), F.struct(F.lit("again").alias("stem"), F.lit("rtf").alias("ending")))).alias("x")).select("paper", "x.*")
    return papers.files_named(tasks(spark, sf_dir), plans.unionByName(more))


@query("SELECT c_custkey, n_name AS chapter FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
def c21_whitelisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    chapters = table(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("chapter"))
    return table(spark, sf_dir, "customer").join(chapters, "c_nationkey").select("c_custkey", "chapter")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996")
def c22_year_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.year("o_orderdate").between(1994, 1996)).select("o_orderkey")


ROWS = "rw AS (SELECT l_orderkey AS paper, l_partkey * 10 + l_linenumber AS pos, CASE WHEN l_linenumber % 5 = 0 THEN 'note' WHEN l_returnflag = 'A' THEN l_linenumber || '(a)' WHEN l_returnflag = 'R' THEN l_linenumber || '(b)(ii)' ELSE CAST(l_linenumber AS VARCHAR) END AS label, [chr(61623) || ' ' || l_linestatus, '', ' two' || chr(61620) || '2 ', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)] AS cells FROM lineitem)"


def scheme(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber").cast("string")
    label = F.when(F.col("l_linenumber") % 5 == 0, "note").when(F.col("l_returnflag") == "A", F.concat(n, F.lit("(a)"))).when(F.col("l_returnflag") == "R", F.concat(n, F.lit("(b)(ii)"))).otherwise(n)
    cells = F.array(F.concat(F.lit(f"{fn.BULLET} "), "l_linestatus"), F.lit(""), F.lit(f" two{fn.TIMES}2 "), F.col("l_quantity").cast("long").cast("string"))
    return lines(spark, sf_dir).select(F.col("l_orderkey").alias("paper"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"), label.alias("label"), cells.alias("cells"))


@query(rf"WITH {ROWS}, a AS (SELECT paper, pos, regexp_extract(label, '^([1-9]|1[0-9]|20)(?:\s*\([a-h]\))?(?:\s*\([ivx]+\))?$', 1) AS q, '- ' || substr(cells[1], 3) || chr(10) || 'two×2' || chr(10) || chr(10) || '**Marks: ' || cells[4] || '**' AS t FROM rw) SELECT paper, q, md5(string_agg(t, chr(10) || chr(10) ORDER BY pos, t)) AS answer_md5 FROM a WHERE q <> '' GROUP BY paper, q")
def a18_scheme_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers under their question's number."""
    return papers.scheme_answers(scheme(spark, sf_dir)).select("paper", "q", F.md5(F.col("answer").cast("binary")).alias("answer_md5"))


NESTED = "rw AS (SELECT l_suppkey AS paper, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS pos, CASE WHEN l_linenumber = 1 THEN 'Task ' || l_partkey END AS label, l_partkey % 50 AS lo, l_partkey % 50 + CAST(l_quantity AS BIGINT) AS hi FROM lineitem)"


@query(f"WITH {NESTED}, t AS (SELECT DISTINCT paper, lo AS a, hi AS b FROM rw), k AS (SELECT * FROM rw WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.paper = rw.paper AND a <= lo AND hi <= b AND (a < lo OR hi < b))) SELECT paper, pos, last_value(label IGNORE NULLS) OVER (PARTITION BY paper ORDER BY pos ROWS UNBOUNDED PRECEDING) AS task, label IS NULL AS continued FROM k")
def a19_task_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of outermost tables, with the task carried to rows without a label."""
    q = F.col("l_quantity").cast("long")
    r = lines(spark, sf_dir).select(F.col("l_suppkey").alias("paper"), (F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"), F.when(F.col("l_linenumber") == 1, F.concat(F.lit("Task "), "l_partkey")).alias("label"), (F.col("l_partkey") % 50).alias("lo"), (F.col("l_partkey") % 50 + q).alias("hi"))
    return papers.task_rows(r).select("paper", "pos", "task", "continued")


#: Rows of tables on pages, some of which lie within others, and headings between them.
TABLES = r"""
tb AS (SELECT l_suppkey AS paper, l_linenumber AS page, l_partkey % 4 AS tbl, 60 + l_partkey % 4 * 150 + (l_suppkey * 7 + l_linenumber * 13) % 90 AS lo, l_orderkey * 100000 + l_partkey AS n, l_orderkey % 40 AS d,
    CASE l_orderkey % 13 WHEN 0 THEN [CAST(l_quantity AS BIGINT) % 9 + 1 || '(a) (i)', 'x'] WHEN 1 THEN ['Task ' || CAST(l_quantity AS BIGINT) % 9 + 1 || ' - Webpage', 'x'] WHEN 2 THEN ['Total', '9'] WHEN 3 THEN ['Question', 'Answer', 'Marks'] WHEN 4 THEN ['', NULL]
      WHEN 5 THEN ['see tasks 3 below'] WHEN 6 THEN ['', 'Available marks', '24'] WHEN 7 THEN [CAST(CAST(l_quantity AS BIGINT) % 9 + 1 AS VARCHAR), ''] ELSE ['', 'more ' || l_partkey] END AS cells FROM lineitem),
rw AS (SELECT *, lo + 60 + (paper * 11 + page * 5 + tbl * 17) % 400 AS hi, lo + d * 3 AS top, lo + d * 3 + 10 + d % 9 AS bottom FROM tb),
hd AS (SELECT s_suppkey AS paper, p AS page, CAST(50 + (s_suppkey + p) % 2 * 100 AS BIGINT) AS y, CAST((s_suppkey + p) % 9 + 1 AS VARCHAR) AS task FROM supplier, generate_series(1, 7) t(p) WHERE (s_suppkey + p) % 3 = 0),
bx AS (SELECT DISTINCT paper, page, tbl, lo, hi FROM rw),
ot AS (SELECT *, row_number() OVER (PARTITION BY paper, page ORDER BY lo, tbl) AS place FROM bx a WHERE NOT EXISTS (SELECT 1 FROM bx b WHERE b.paper = a.paper AND b.page = a.page AND b.lo <= a.lo AND a.hi <= b.hi AND (b.lo < a.lo OR a.hi < b.hi))),
tr AS (SELECT rw.*, place, len(list_filter(cells, lambda c: lower(trim(coalesce(c, ''))) NOT IN ('', 'question', 'answer', 'marks', 'task', 'mark'))) = 0 AS header FROM rw JOIN ot USING (paper, page, tbl))"""


def scheme_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    s, p, k, q, part = (F.col(c) for c in ("l_suppkey", "l_linenumber", "l_orderkey", "l_quantity", "l_partkey"))
    task, table_no, case = (q.cast("long") % 9 + 1).cast("string"), part % 4, k % 13
    texts = lambda *c: F.array(*(x if not isinstance(x, str) else F.lit(x) for x in c))
    cells = F.when(case == 0, texts(F.concat(task, F.lit("(a) (i)")), "x")).when(case == 1, texts(F.concat(F.lit("Task "), task, F.lit(" - Webpage")), "x")).when(case == 2, texts("Total", "9")).when(case == 3, texts("Question", "Answer", "Marks"))
    cells = cells.when(case == 4, texts("", F.lit(None).cast("string"))).when(case == 5, texts("see tasks 3 below")).when(case == 6, texts("", "Available marks", "24")).when(case == 7, texts(task, "")).otherwise(texts("", F.concat(F.lit("more "), part)))
    lo = 60 + table_no * 150 + (s * 7 + p * 13) % 90
    hi, d = lo + 60 + (s * 11 + p * 5 + table_no * 17) % 400, k % 40
    rows = lines(spark, sf_dir).select(s.alias("paper"), p.alias("page"), table_no.alias("table"), lo.alias("lo"), hi.alias("hi"), (k * 100000 + part).alias("n"), (lo + d * 3).alias("top"), (lo + d * 3 + 10 + d % 9).alias("bottom"), cells.alias("cells"))
    x = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("paper"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("page")).where((F.col("paper") + F.col("page")) % 3 == 0)
    heads = x.select("paper", "page", (50 + (F.col("paper") + F.col("page")) % 2 * 100).alias("y"), ((F.col("paper") + F.col("page")) % 9 + 1).cast("string").alias("task"))
    return rows, heads


@query(f"WITH {TABLES} SELECT paper, trim(cells[1]) AS label, page, tbl AS table, n FROM rw WHERE trim(cells[1]) <> ''")
def a19_labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return papers.labelled_rows(scheme_tables(spark, sf_dir)[0])


@query(rf"WITH {TABLES} SELECT paper, page, tbl AS table, n, nullif(regexp_replace(cells[1], '\s', '', 'g'), '') AS label, place = 1 AND lo <= 130 AND row_number() OVER (PARTITION BY paper, page ORDER BY place, n, nullif(regexp_replace(cells[1], '\s', '', 'g'), '')) = 1 AS continues FROM tr WHERE NOT header")
def a19_part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, rows of parts: outer tables without column headers, and where a row goes on overleaf."""
    return papers.part_rows(scheme_tables(spark, sf_dir)[0])


@query(rf"""WITH RECURSIVE {TABLES},
ev AS (SELECT paper, page, place, 1 AS late, n, tbl, nullif(regexp_extract(trim(cells[1]), '^([0-9]{{1,2}})(?:\(|[ \t\n]|$)', 1), '') AS m, nullif(regexp_extract(trim(cells[1]), '(?i)^(?:See[ \t\n]+)?Tasks?[ \t\n]*([0-9]{{1,2}})', 1), '') AS h,
    header AND (len(list_filter(cells, lambda c: trim(coalesce(c, '')) <> '')) > 0 OR bottom - top < 15) AS head, len(list_filter(cells, lambda c: trim(coalesce(c, '')) <> '')) > 0 AND top > 130 AS far,
    regexp_matches(trim(cells[1]), '(?i)^(total|mark total)\b') OR len(list_filter(cells, lambda c: regexp_matches(lower(trim(coalesce(c, ''))), '^(available|total) marks\b'))) > 0 AS total, CAST(NULL AS BOOLEAN) AS fresh, CAST(NULL AS VARCHAR[]) AS named FROM tr
  UNION ALL SELECT paper, page, place, 0, NULL, tbl, NULL, NULL, NULL, NULL, NULL, place > 1 OR lo > 130, (SELECT list(DISTINCT task) FROM hd WHERE hd.paper = ot.paper AND hd.page = ot.page AND y < lo) FROM ot),
sq AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY page, place, late, n, coalesce(m, h)) AS i, min(CASE WHEN m IS NOT NULL THEN page * 1000000000000000 + place * 100000000000000 + n END) OVER (PARTITION BY paper, coalesce(m, h)) AS seen FROM ev),
st AS (SELECT paper, CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS task, FALSE AS kept, CAST(NULL AS BIGINT) AS page, CAST(NULL AS BIGINT) AS tbl, CAST(NULL AS BIGINT) AS n FROM (SELECT DISTINCT paper FROM ev)
  UNION ALL
  SELECT sq.paper, sq.i, CASE WHEN late = 0 THEN CASE WHEN fresh OR len(list_filter(coalesce(named, []), lambda x: x IS DISTINCT FROM st.task)) > 0 THEN NULL ELSE st.task END
      WHEN m IS NOT NULL THEN m WHEN h IS NOT NULL THEN CASE WHEN h IS DISTINCT FROM st.task AND seen < sq.page * 1000000000000000 + place * 100000000000000 + sq.n THEN NULL ELSE h END
      WHEN head THEN CASE WHEN far THEN NULL ELSE st.task END WHEN total THEN NULL ELSE st.task END,
    late = 1 AND CASE WHEN m IS NOT NULL THEN TRUE WHEN h IS NOT NULL THEN NOT coalesce(h IS DISTINCT FROM st.task AND seen < sq.page * 1000000000000000 + place * 100000000000000 + sq.n, FALSE) ELSE NOT head AND NOT total END, sq.page, sq.tbl, sq.n
  FROM st JOIN sq ON sq.paper = st.paper AND sq.i = st.i + 1)
SELECT paper, page, tbl AS table, n, task FROM st WHERE kept""")
def a19_rows_by_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, rows of tasks: numbered rows, headings in words, appendices, sum lines and tables that start anew. The SQL goes row by row."""
    rows, heads = scheme_tables(spark, sf_dir)
    return papers.rows_by_task(rows, heads, tasks_for(rows, rows.count()))


@query(r"SELECT conv_id AS paper, sum(len(string_split(text, ' '))) FILTER (WHERE role = 'user')::BIGINT AS asked_words, md5(coalesce(string_agg(CASE WHEN role = 'user' THEN text END, chr(10) ORDER BY turn), '') || chr(12) || coalesce(string_agg(CASE WHEN role <> 'user' AND turn > 1 THEN text END, chr(10) ORDER BY turn), '')) AS text_md5 FROM conversations GROUP BY conv_id")
def a13_sitting_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitting's question texts and, without its front matter (here: what stands before the third turn), its scheme's texts."""
    c = table(spark, sf_dir, "conversations")
    user = F.col("role") == "user"
    texts = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c & F.col("text").isNotNull(), F.struct("turn", "text")))), lambda x: x["text"]), "\n")
    g = c.groupBy(F.col("conv_id").alias("paper")).agg(F.sum(F.when(user, F.size(F.split("text", " ", -1)))).alias("asked_words"), texts(user).alias("a"), texts(~user & (F.col("turn") > 1)).alias("b"))
    return g.select("paper", "asked_words", F.md5(F.concat_ws("\f", "a", "b").cast("binary")).alias("text_md5"))


REPORT = "'Front page. Paper 9/11 ' || text || ' Paper 9/12 second part ' || doc_id || ' Paper 9/13 x'"


@query(f"WITH s AS (SELECT doc_id, unnest(list_slice(string_split(regexp_replace({REPORT}, 'Paper 9/([0-9]{{2}})', chr(1) || chr(92) || '1'::VARCHAR, 'g'), chr(1)), 2, 99)) AS s FROM documents WHERE lang <> 'de') SELECT doc_id, s[1:2] AS component, md5(substr(s, 3)) AS body_md5 FROM s WHERE s[1:2] IN ('11', '12')".replace("chr(1) || chr(92) || '1'::VARCHAR", r"chr(1) || '\1'"))
def a14_report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of reports by component, of wanted components and reports only."""
    text = F.concat(F.lit("Front page. Paper 9/11 "), "text", F.lit(" Paper 9/12 second part "), "doc_id", F.lit(" Paper 9/13 x"))
    s = docs(spark, sf_dir).where("lang <> 'de'").select("doc_id", F.explode(F.slice(F.split(F.regexp_replace(text, "Paper 9/([0-9]{2})", "\u0001$1"), "\u0001", -1), 2, 99)).alias("s"))
    return s.select("doc_id", F.substring("s", 1, 2).alias("component"), F.md5(F.substring("s", 3, 1 << 30).cast("binary")).alias("body_md5")).where("component in ('11', '12')")


@query(r"WITH l AS (SELECT p_brand AS file, CASE WHEN p_partkey % 4 = 0 THEN '### ' || p_name || ' ' || (2010 + p_size % 9) WHEN p_partkey % 4 = 1 THEN '| ' || p_type || ' | x | ' || p_size || ' |' ELSE '| a | ' || p_size || ' |' END AS line FROM part), g AS (SELECT file, count(*) FILTER (WHERE starts_with(line, '### ')) AS entries, CAST(coalesce(sum(CAST(nullif(regexp_extract(line, '^\|[ \t]*[^|]+\|[^|]*\|[ \t]*([0-9]+)[ \t]*\|[ \t]*$', 1), '') AS BIGINT)), 0) AS BIGINT) AS marks FROM l GROUP BY file), y AS (SELECT file, regexp_extract(line, '(20[0-9]{2})', 1) AS y, count(*) AS n FROM l WHERE starts_with(line, '### ') AND regexp_matches(line, '20[0-9]{2}') GROUP BY ALL) SELECT g.*, (SELECT string_agg(y || ':' || n, ' ' ORDER BY y) FROM y WHERE y.file = g.file) AS years FROM g")
def a17_topic_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    line = F.when(k == 0, F.concat(F.lit("### "), "p_name", F.lit(" "), 2010 + size % 9)).when(k == 1, F.concat(F.lit("| "), "p_type", F.lit(" | x | "), size, F.lit(" |"))).otherwise(F.concat(F.lit("| a | "), size, F.lit(" |")))
    return papers.topic_file_stats(table(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), line.alias("line")))


@query(r"""WITH s AS (SELECT doc_id % 97 AS session, lang AS component, doc_id AS page, 'Intro. Question 1 ' || text || ' Question 12 (a) ' || text || ' (b) short Question 3' AS text FROM documents),
p AS (SELECT DISTINCT session, component, q, part FROM s, (VALUES ('1', 'a'), ('12', 'a'), ('12', 'b'), ('12', NULL), ('2', 'a')) v(q, part)),
c AS (SELECT p.*, page, list_filter(string_split(regexp_replace(text, 'Question ([0-9])', chr(1) || '\1', 'g'), chr(1)), lambda x: regexp_matches(x, '^' || q || '([^0-9]|$)'))[1] AS x FROM p JOIN s USING (session, component)),
b AS (SELECT *, trim(substr(x, length(q) + 1)) AS body FROM c WHERE x IS NOT NULL),
n AS (SELECT *, trim(CASE WHEN part IS NOT NULL THEN regexp_extract(body, '(?s)\(' || part || '\)(.*?)(\([a-h]\) |$)', 1) END) AS own FROM b),
f AS (SELECT session, component, q, part, md5(CASE WHEN length(own) > 40 THEN own ELSE body END) AS text_md5, CASE WHEN length(own) > 40 THEN 'part' ELSE 'question' END AS scope FROM n QUALIFY row_number() OVER (PARTITION BY session, component, q, part ORDER BY page) = 1)
SELECT p.*, f.text_md5, f.scope FROM p LEFT JOIN f ON p.session = f.session AND p.component = f.component AND p.q = f.q AND p.part IS NOT DISTINCT FROM f.part""")
def d08_report_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("Intro. Question 1 "), F.col("text"), F.lit(" Question 12 (a) "), F.col("text"), F.lit(" (b) short Question 3"))
    s = docs(spark, sf_dir).select((F.col("doc_id") % 97).alias("session"), F.col("lang").alias("component"), F.col("doc_id").alias("page"), text.alias("text"))
    wanted = F.array(*(F.struct(F.lit(q).alias("q"), F.lit(p).cast("string").alias("part")) for q, p in (("1", "a"), ("12", "a"), ("12", "b"), ("12", None), ("2", "a"))))
    parts = s.select("session", "component").distinct().select("session", "component", F.explode(wanted).alias("w")).select("session", "component", "w.*")
    c = papers.comments(parts, s)
    return c.select("session", "component", "q", "part", F.md5(F.col("text").cast("binary")).alias("text_md5"), "scope")


FIGURES = "st AS (SELECT l_suppkey AS doc, l_partkey AS y FROM lineitem WHERE l_linenumber % 3 = 1), fg AS (SELECT l_suppkey AS doc, l_orderkey * 100000 + l_partkey * 8 + l_linenumber AS figure, l_partkey AS lo, l_partkey + CAST(l_quantity AS BIGINT) % 9 AS hi FROM lineitem WHERE l_linenumber % 3 <> 1), ow AS (SELECT fg.doc, figure, lo, hi, (SELECT max(y) FROM st WHERE st.doc = fg.doc AND y <= (lo + hi) / 2) AS start FROM fg WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.doc = fg.doc AND y > lo AND y <= hi))"


def figures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li, lo = lines(spark, sf_dir), F.col("l_partkey")
    starts = li.where("l_linenumber % 3 = 1").select(F.col("l_suppkey").alias("doc"), lo.alias("y"))
    fig = li.where("l_linenumber % 3 <> 1").select(F.col("l_suppkey").alias("doc"), (F.col("l_orderkey") * 100000 + lo * 8 + F.col("l_linenumber")).alias("figure"), lo.alias("lo"), (lo + F.col("l_quantity").cast("long") % 9).alias("hi"))
    return starts, fig


@query(f"WITH {FIGURES} SELECT DISTINCT doc, figure, CAST(start AS DOUBLE) AS start FROM ow WHERE start IS NOT NULL")
def d13_figure_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question in progress at a figure's place."""
    return papers.figure_owners(*figures(spark, sf_dir)).distinct()


@query(f"WITH {FIGURES} SELECT doc, CAST(start AS DOUBLE) AS start, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM ow WHERE start IS NOT NULL GROUP BY doc, start")
def d14_grown_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures that hold another question's start are skipped; a question's span grows over its own."""
    starts, fig = figures(spark, sf_dir)
    return papers.grown_spans(papers.figure_owners(starts, fig), fig)


@query("WITH n AS (SELECT p_partkey, 'P' || p_partkey || '_QP_1.pdf' AS paper FROM part), h AS (SELECT 'P' || p_partkey || '_ms_1.pdf' AS have FROM part WHERE p_size % 2 = 0) SELECT p_partkey, have AS scheme FROM n LEFT JOIN h ON have = regexp_replace(paper, '(?i)qp', 'ms')")
def d15_scheme_of_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of which the name has ms for the first qp, if there is one."""
    p = table(spark, sf_dir, "part")
    name = lambda mid: F.concat(F.lit("P"), "p_partkey", F.lit(f"_{mid}_1.pdf"))
    wanted = p.select("p_partkey", F.regexp_replace(name("QP"), "(?i)^(.*?)qp", "$1ms").alias("scheme"))
    return wanted.select("p_partkey", F.col("scheme").alias("want")).join(p.where("p_size % 2 = 0").select(name("ms").alias("scheme")), F.col("want") == F.col("scheme"), "left").select("p_partkey", "scheme")


@query("SELECT s_suppkey FROM supplier SEMI JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ON s_nationkey = n_nationkey")
def d20_component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation").where("n_regionkey = 1")
    return s.join(n, s.s_nationkey == n.n_nationkey, "left_semi").select("s_suppkey")


@query("SELECT l_suppkey AS paper, l_partkey % 20 AS file, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS chapters FROM lineitem GROUP BY 1, 2")
def d23_file_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = lines(spark, sf_dir).groupBy(F.col("l_suppkey").alias("paper"), (F.col("l_partkey") % 20).alias("file"))
    return g.agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("chapters"))


ANSWERS = "lb AS (SELECT l_suppkey AS paper, l_linenumber || CASE WHEN l_returnflag = 'A' THEN '(a)' WHEN l_returnflag = 'R' THEN '(b)' ELSE '' END AS label, l_partkey % 5 AS page FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_suppkey % 2 = 0)), wa AS (SELECT DISTINCT l_suppkey AS paper, CAST(l_linenumber AS VARCHAR) AS q, part FROM lineitem, (VALUES ('a'), ('c')) v(part))"


@query(f"WITH {ANSWERS}, h AS (SELECT wa.*, label = q || '(' || part || ')' AS same, page, count(*) AS n FROM wa JOIN lb ON wa.paper = lb.paper AND starts_with(label, q || '(') GROUP BY ALL), b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY paper, q, part ORDER BY same DESC, n DESC, page) = 1) SELECT paper, q, part, page, n, CASE WHEN same THEN 'label' WHEN NOT same THEN 'prefix' END AS by FROM wa LEFT JOIN b USING (paper, q, part)")
def d26_answer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact label, else all labels of the question; the page with most rows."""
    li = lines(spark, sf_dir)
    n = F.col("l_linenumber").cast("string")
    label = F.concat(n, F.when(F.col("l_returnflag") == "A", "(a)").when(F.col("l_returnflag") == "R", "(b)").otherwise(""))
    labels = li.where("not (l_returnflag = 'A' and l_suppkey % 2 = 0)").select(F.col("l_suppkey").alias("paper"), label.alias("label"), (F.col("l_partkey") % 5).alias("page"))
    wanted = li.select(F.col("l_suppkey").alias("paper"), n.alias("q")).distinct().select("paper", "q", F.explode(F.array(F.lit("a"), F.lit("c"))).alias("part"))
    return papers.answer_pages(wanted, labels)


@query("WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS m, o_orderkey, o_custkey % 40 AS src FROM orders), a AS (SELECT list_sort(list_distinct(list(src))) AS every FROM o), g AS (SELECT year, m, count(*) AS whole, list_sort(list_distinct(list(src))) AS own FROM o GROUP BY year, m) SELECT year, m AS session, whole, len(own) AS sources, array_to_string(list_filter(every, lambda x: NOT list_contains(own, x)), ',') AS also FROM g, a")
def d29_session_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each session its questions, its number of sources, and the sources that only other sessions cover (of 40)."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("session"), (F.col("o_custkey") % 40).alias("src"))
    every = F.broadcast(o.agg(F.array_sort(F.collect_set("src")).alias("every")))  # one row
    g = o.groupBy("year", "session").agg(F.count(F.lit(1)).alias("whole"), F.collect_set("src").alias("own")).crossJoin(every)
    return g.select("year", "session", "whole", F.size("own").cast("long").alias("sources"), F.array_join(F.transform(F.array_except("every", "own"), lambda x: x.cast("string")), ",").alias("also"))


@query("SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id) SEMI JOIN (SELECT page_id AS doc_id FROM pages) USING (doc_id)")
def d30_missing_with_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are missing although their source file exists."""
    gaps = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")
    return gaps.join(table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id")), "doc_id", "left_semi")


@query("SELECT n_nationkey, coalesce(n, 0) AS suppliers, coalesce(best, -1.0) AS best FROM nation LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS n, max(s_acctbal) AS best FROM supplier WHERE s_acctbal > 0 GROUP BY 1) USING (n_nationkey)")
def d31_row_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's figures, or the default row's."""
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"), F.max("s_acctbal").alias("best"))
    return joins.with_default(table(spark, sf_dir, "nation").select("n_nationkey"), s, "n_nationkey", {"suppliers": F.lit(0).cast("long"), "best": F.lit(-1.0)})


@query("WITH r AS (SELECT p_brand AS session, p_partkey AS variant, 60 + p_size AS max, 30 + p_size % 7 AS A, 20 + p_size % 5 AS B FROM part), l AS (SELECT session, variant, max, 'A' AS grade, A AS mark FROM r UNION ALL SELECT session, variant, max, 'B', B FROM r) SELECT session, grade, avg(mark * 100.0 / max) AS pct, avg(mark) AS raw, arg_min(max, variant) AS max FROM l GROUP BY session, grade")
def e20_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    r = table(spark, sf_dir, "part").select(F.col("p_brand").alias("session"), F.col("p_partkey").alias("variant"), (60 + size).alias("max"), (30 + size % 7).alias("A"), (20 + size % 5).alias("B"))
    return papers.thresholds(r, ["A", "B"])


@query(f"WITH UNITS0, u AS (SELECT * FROM u0 WHERE year = (SELECT max(year) FROM u0)), t AS (SELECT paper, q, marks, year, season, command, tags, unnest(tags) AS sub FROM u), x AS (SELECT *, split_part(sub, '.', 1) AS topic FROM t), {SHARES} SELECT topic, CAST(part AS DOUBLE) / 60 AS marks, 100.0 * part / (SELECT sum(part) FROM sh) AS pct FROM sh")
def e34_newest_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of topics in the newest year's papers alone."""
    u = units(spark, sf_dir)
    newest = F.broadcast(u.agg(F.max("year").alias("newest")))  # one row
    return stats.fractional_shares(u.join(newest, F.col("year") == F.col("newest")).drop("newest")).select("topic", "marks", "pct")


@query(r"WITH s AS (SELECT source, max(CAST(regexp_matches(text, 'The([^\p{L}\p{N}_]|$)') AS INT)) AS the, max(CAST(regexp_matches(text, 'Les([^\p{L}\p{N}_]|$)') AS INT)) AS les, max(CAST(regexp_matches(text, 'Zu([^\p{L}\p{N}_]|$)') AS INT)) AS zu FROM documents GROUP BY source), c AS (SELECT 'start' AS family, 'The' AS name, sum(the) AS n FROM s UNION ALL SELECT 'start', 'Les', sum(les) FROM s UNION ALL SELECT 'other', 'Zu', sum(zu) FROM s), f AS (SELECT 'start' AS family, sum(greatest(the, les)) AS sittings FROM s UNION ALL SELECT 'other', sum(zu) FROM s) SELECT family, CAST(any_value(sittings) AS BIGINT) AS sittings, string_agg(name || ' ' || n, ', ' ORDER BY n DESC, name) AS members FROM c JOIN f USING (family) GROUP BY family")
def e38_function_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sittings that name a function, and families of functions that count a sitting once, members by count. A name ends where no letter, digit or underscore follows."""
    end = r"(?![\p{L}\p{N}_])"
    return stats.function_families(docs(spark, sf_dir), "source", "text", {"start": {"The": rf"The{end}", "Les": rf"Les{end}"}, "other": {"Zu": rf"Zu{end}"}})


#: Sections as JSON: an order's citation lies under as many objects and lists as its key says, beside lists of lists, nulls, an object without a quote and one with a null quote.
SECTIONS = """sc AS (SELECT o_orderkey AS id, '{"words": [null, [[]], {"syllabus": ' || c || '}], "k' || o_orderkey % 3 || '": ' || repeat('{"deep": [1, ', CAST(o_orderkey % 6 AS INTEGER)) || c || repeat(']}', CAST(o_orderkey % 6 AS INTEGER)) || ', "doc": "no quote", "weak": {"doc": "basis", "quote": null, "points": [' || c || ', {"quote": "no doc"}]}}' AS j
  FROM (SELECT o_orderkey, '{"doc": "' || o_orderstatus || '", "quote": "' || o_orderpriority || '", "page": ' || o_custkey % 50 || '}' AS c FROM orders))"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("o_orderkey"), lambda x: F.lit(x)
    c = F.concat(t('{"doc": "'), "o_orderstatus", t('", "quote": "'), "o_orderpriority", t('", "page": '), F.col("o_custkey") % 50, t("}"))
    n = (k % 6).cast("int")
    j = F.concat(t('{"words": [null, [[]], {"syllabus": '), c, t('}], "k'), k % 3, t('": '), F.repeat(t('{"deep": [1, '), n), c, F.repeat(t("]}"), n), t(', "doc": "no quote", "weak": {"doc": "basis", "quote": null, "points": ['), c, t(', {"quote": "no doc"}]}}'))
    return table(spark, sf_dir, "orders").select(k.alias("id"), F.parse_json(j).alias("v"))


@query(f"WITH {SECTIONS} SELECT sc.id, json_extract_string(t.value, '$.doc') AS doc, json_extract_string(t.value, '$.quote') AS quote, CAST(json_extract_string(t.value, '$.page') AS INTEGER) AS page, count(*) AS n FROM sc, json_tree(sc.j) t WHERE t.type = 'OBJECT' AND json_exists(t.value, '$.doc') AND json_exists(t.value, '$.quote') GROUP BY ALL")
def h29_cites_at_any_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object with a doc and a quote, wherever it lies."""
    return papers.cites(sections(spark, sf_dir), "id", "v").groupBy("id", "doc", "quote", "page").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {SECTIONS} SELECT json_extract_string(t.value, '$.doc') AS doc, count(*) AS n FROM sc, json_tree(sc.j) t WHERE t.type = 'OBJECT' AND json_exists(t.value, '$.doc') AND json_exists(t.value, '$.quote') GROUP BY ALL")
def e49_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of each document."""
    return papers.cites(sections(spark, sf_dir), "id", "v").groupBy("doc").agg(F.count(F.lit(1)).alias("n"))


ENTRIES = r"""wd AS (SELECT doc_id AS file, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
lx AS (SELECT file, unnest(list_transform(generate_series(0, (len(w) - 1) // 10), lambda n: {'n': n, 't': replace(array_to_string(w[10 * n + 1:10 * n + 10], ' '), '|', '')})) AS x FROM wd WHERE len(w) > 0),
ly AS (SELECT file, x.n AS n, x.t AS t, x.n % 13 AS r, (x.n // 13 + file) % 9 AS off FROM lx),
ln AS (SELECT file, n, CASE WHEN r = 0 THEN '### 9626/' || 11 + file % 9 || ' ' || ['m', 's', 'w'][n % 3 + 1] || ' 20' || 15 + file % 10 || ' [qp](q' || n || '.pdf)' || CASE WHEN n % 5 = 0 THEN '' ELSE ', [ms](m' || n || '.pdf)' END
  WHEN r = 1 + off THEN '| No. | Q |' WHEN r = 2 + off THEN '|--|--|' WHEN r = 3 + off THEN '| ' || n % 20 || '(a) / ' || t || ' | x |' ELSE t END AS line FROM ly)"""


@query(rf"""WITH {ENTRIES},
hd AS (SELECT file, n, line FROM ln WHERE regexp_matches(line, '^### [0-9]{{4}}/[0-9]{{2}} [msw] [0-9]{{4}}.*\]\([^)]*\).*\]\(')),
nx AS (SELECT hd.file, hd.n, hd.line, min(ln.n) AS j FROM hd JOIN ln ON ln.file = hd.file AND ln.n BETWEEN hd.n + 1 AND hd.n + 7 AND starts_with(ln.line, '| No.') GROUP BY ALL)
SELECT nx.file, nx.n AS pos, regexp_extract_all(nx.line, '\]\(([^)]*)\)', 1)[1] AS paper, regexp_extract_all(nx.line, '\]\(([^)]*)\)', 1)[2] AS scheme, trim(split_part(regexp_extract(ln.line, '^\|[ \t]*([^|]+?)[ \t]*\|', 1), '/', 1)) AS q,
  nx.line[5:11] || ' ' || CASE nx.line[13] WHEN 'm' THEN 'March' WHEN 's' THEN 'June' ELSE 'November' END || ' ' || nx.line[15:18] AS label FROM nx JOIN ln ON ln.file = nx.file AND ln.n = nx.j + 2""")
def a15_topic_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of topic files, with the question number from the table that follows within seven lines."""
    w = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), w.alias("w")).where("size(w) > 0")
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / 10).cast("int")), lambda n: F.replace(F.array_join(F.slice("w", 10 * n + 1, F.lit(10)), " "), F.lit("|"), F.lit("")))
    x = d.select("file", F.posexplode(runs).alias("n", "t")).withColumns({"r": F.col("n") % 13, "off": (F.expr("n div 13") + F.col("file")) % 9})
    n, r, off, f, s = F.col("n"), F.col("r"), F.col("off"), F.col("file"), F.lit
    head = F.concat(s("### 9626/"), 11 + f % 9, s(" "), F.element_at(F.array(*map(F.lit, "msw")), n % 3 + 1), s(" 20"), 15 + f % 10, s(" [qp](q"), n, s(".pdf)"), F.when(n % 5 == 0, "").otherwise(F.concat(s(", [ms](m"), n, s(".pdf)"))))
    line = F.when(r == 0, head).when(r == 1 + off, "| No. | Q |").when(r == 2 + off, "|--|--|").when(r == 3 + off, F.concat(s("| "), n % 20, s("(a) / "), "t", s(" | x |"))).otherwise(F.col("t"))
    e = papers.topic_entries(x.select("file", n.alias("pos"), line.alias("line")))
    return e.withColumn("pos", F.col("pos").cast("long"))


@query("""WITH p AS (SELECT page_id, html, strlen(html) AS size FROM pages), c AS (SELECT page_id, 'near' AS host, CASE WHEN page_id % 3 = 0 THEN reverse(html) WHEN page_id % 3 = 1 THEN html || '.' ELSE html END AS copy, NULL AS error FROM p WHERE page_id % 3 <> 0 OR strlen(html) = length(html)
  UNION ALL SELECT page_id, 'far', CASE WHEN page_id % 4 > 0 THEN html END, CASE WHEN page_id % 4 = 0 AND page_id % 8 > 0 THEN 'timeout' END FROM p)
SELECT page_id AS name, host, CAST(strlen(copy) AS INTEGER) AS size, CASE WHEN copy IS NULL THEN NULL WHEN strlen(copy) <> size THEN FALSE WHEN size > 3000 THEN TRUE ELSE copy = html END AS match,
  CASE WHEN copy IS NULL THEN coalesce(error, 'no content') WHEN strlen(copy) <> size THEN 'size' WHEN size > 3000 THEN 'size only' ELSE 'md5' END AS how FROM c JOIN p USING (page_id)""")
def a25_compared_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25, its rule: copies of pages compared by size, then by digest, large ones by size only."""
    k, html = F.col("page_id"), F.col("html")
    p = table(spark, sf_dir, "pages").select("page_id", "html")
    near = p.where((k % 3 != 0) | (F.octet_length("html") == F.char_length("html"))).select(k.alias("name"), F.lit("near").alias("host"), F.when(k % 3 == 0, F.reverse("html")).when(k % 3 == 1, F.concat("html", F.lit("."))).otherwise(html).cast("binary").alias("content"), F.lit(None).cast("string").alias("error"))
    far = p.select(k.alias("name"), F.lit("far").alias("host"), F.when(k % 4 > 0, html).cast("binary").alias("content"), F.when((k % 4 == 0) & (k % 8 > 0), "timeout").alias("error"))
    return papers.compared_copies(p.select(k.alias("name"), html.cast("binary").alias("content")), near.unionByName(far), 3000)


@query("SELECT lang AS split, count(*) AS units, count(DISTINCT source) AS papers, count(*) FILTER (WHERE quality IS NULL) AS without, count(*) FILTER (WHERE d.doc_id <> first) AS folded FROM (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM documents) d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang")
def e55_split_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    d = d.withColumn("key", F.sha2(F.col("text").cast("binary"), 256)).drop("text")
    first = d.groupBy("key").agg(F.min("doc_id").alias("first"))
    j = d.join(first, "key").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.groupBy(F.col("lang").alias("split")).agg(F.count(F.lit(1)).alias("units"), F.count_distinct("source").alias("papers"), F.count_if(F.col("quality").isNull()).alias("without"), F.count_if(F.col("doc_id") != F.col("first")).alias("folded"))


@query("SELECT l_suppkey AS paper, l_returnflag AS chapter, array_to_string(list_sort(list_distinct(list(l_linenumber))), ',') AS qnums, array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS files, bool_or(l_tax = 0) AS inherited FROM lineitem GROUP BY 1, 2")
def e57_plan_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = lines(spark, sf_dir).groupBy(F.col("l_suppkey").alias("paper"), F.col("l_returnflag").alias("chapter"))
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), ",")
    return g.agg(text("l_linenumber").alias("qnums"), text("l_linestatus").alias("files"), F.bool_or(F.col("l_tax") == 0).alias("inherited"))


@query(f"WITH UNITS, {SHARES}, p AS (SELECT topic, 100.0 * part / (SELECT sum(part) FROM sh) AS pct FROM sh), r AS (SELECT *, row_number() OVER (ORDER BY pct DESC, topic) AS r FROM p) SELECT sum(pct) FILTER (WHERE r <= 3) AS top3, count(*) FILTER (WHERE pct < 1) AS under, max(pct) AS most, string_agg(topic, ' and ' ORDER BY r) FILTER (WHERE r <= 2) AS pair FROM r")
def e62_report_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of figures over the shares; shares that don't add up to 100 are an error."""
    return stats.report_scalars(stats.fractional_shares(units(spark, sf_dir)))


@query("WITH UNITS, s AS (SELECT sub, sum(marks * 30) AS part FROM x GROUP BY sub) SELECT sub, 100.0 * part / (SELECT sum(part) FROM s) AS pct FROM s WHERE 100.0 * part / (SELECT sum(part) FROM s) < 1 AND part > 0")
def e63_small_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtopics with some, but under 1 per cent of the marks."""
    m = stats.split_marks(units(spark, sf_dir), lambda t: t).groupBy(F.col("name").alias("sub")).agg(F.sum("part").alias("part"))
    whole = F.broadcast(m.agg(F.sum("part").alias("whole")))  # one row
    return m.crossJoin(whole).select("sub", (100.0 * F.col("part") / F.col("whole")).alias("pct")).where("pct > 0 and pct < 1")


@query("WITH UNITS, s AS (SELECT marks, 100.0 * count(*) / (SELECT count(*) FROM u WHERE marks > 0) AS pct FROM u WHERE marks > 0 GROUP BY marks) SELECT arg_max(marks, marks * pct) AS marks, max(marks * pct) AS weight FROM s")
def e65_most_marks_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stats.sizes(units(spark, sf_dir), by_question=False).withColumn("w", F.col("marks") * F.col("pct"))
    return s.agg(F.max_by("marks", "w").alias("marks"), F.max("w").alias("weight"))


PLACED = "pl AS (SELECT 'Supplier ' || l_suppkey || ' ' || CAST(year(l_shipdate) AS VARCHAR) || ' • Question ' || l_linenumber || CASE WHEN l_discount > 0.05 THEN '  (continued)' ELSE '' END AS line, CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey, l_linenumber, l_discount FROM lineitem)"


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("Supplier "), "l_suppkey", F.lit(" "), F.year("l_shipdate"), F.lit(" • Question "), "l_linenumber", F.when(F.col("l_discount") > 0.05, "  (continued)").otherwise(""))
    return papers.placed_units(lines(spark, sf_dir).select(line.alias("line")))


@query(f"WITH {PLACED} SELECT count(*) AS units FROM (SELECT DISTINCT l_suppkey, year, l_linenumber FROM pl WHERE NOT l_discount > 0.05)")
def e66_placed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).agg(F.count(F.lit(1)).alias("units"))


@query(f"WITH {PLACED} SELECT year, count(*) AS n FROM (SELECT DISTINCT l_suppkey, year, l_linenumber FROM pl WHERE NOT l_discount > 0.05) GROUP BY year")
def e76_placed_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.regexp_extract("label", "([0-9]{4})$", 1).cast("int")
    return placed(spark, sf_dir).groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH UNITS, {SHARES}, p AS (SELECT topic, 100.0 * part / (SELECT sum(part) FROM sh) AS pct FROM sh), r AS (SELECT *, row_number() OVER (ORDER BY pct DESC, topic) AS rank FROM p), y AS (SELECT topic, max(year) AS last_year FROM x GROUP BY topic) SELECT rank, topic, pct, last_year FROM r LEFT JOIN y USING (topic) WHERE pct >= 1 AND rank <= 11")
def e70_payoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rungs of at least 1 per cent, the first 11 as the report has them, with each topic's last year."""
    u = units(spark, sf_dir)
    rungs = stats.ladder(stats.fractional_shares(u), [("half", 50.0)]).where("pct >= 1 and rank <= 11")
    return rungs.join(stats.recency(u).select("topic", "last_year"), "topic", "left").select(F.col("rank").cast("long").alias("rank"), "topic", "pct", "last_year")


@query("WITH UNITS, m AS (SELECT q, topic, count(DISTINCT paper) AS hits FROM x WHERE topic NOT LIKE 'FLAG%' GROUP BY q, topic), n AS (SELECT q, count(DISTINCT paper) AS n FROM u GROUP BY q), b AS (SELECT q, topic, 100.0 * hits / n AS pct FROM m JOIN n USING (q) WHERE n >= 10 QUALIFY row_number() OVER (PARTITION BY q ORDER BY hits DESC, topic) = 1) SELECT q, topic, pct, CASE WHEN pct >= 22 THEN 'firm' ELSE 'loose' END AS grade FROM b WHERE (SELECT count(DISTINCT topic) > 1 AND max(pct) >= 20 FROM b)")
def e71_position_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map of positions, only if it has more than one topic and a share of at least 20 per cent (the tables' topics are alike); firm from 22."""
    u = units(spark, sf_dir).withColumn("tags", F.filter("tags", lambda t: ~F.startswith(t, F.lit("FLAG"))))
    return stats.position_rules(stats.task_map(u), 1, 20, 22)


@query("SELECT DISTINCT split_part(p_type, ' ', 1) AS archive FROM part JOIN lineitem ON l_partkey = p_partkey WHERE year(l_shipdate) BETWEEN 1994 AND 1995")
def e72_used_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archives that the plan's rows of some years come from."""
    li = lines(spark, sf_dir).where(F.year("l_shipdate").between(1994, 1995)).select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").join(li, "p_partkey", "left_semi").select(F.substring_index("p_type", " ", 1).alias("archive")).distinct()


@query("SELECT o_orderstatus AS paper, CAST(min(year(o_orderdate)) AS INTEGER) AS first, CAST(max(year(o_orderdate)) AS INTEGER) AS last, count(*) AS n FROM orders GROUP BY 1")
def e73_year_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paper's years; an error if its texts aren't as many as its stored sittings."""
    o = table(spark, sf_dir, "orders")
    stored = o.groupBy(F.col("o_orderstatus").alias("paper")).agg(F.count(F.lit(1)).alias("sittings"))
    return stats.year_bounds(o.select(F.col("o_orderstatus").alias("paper"), F.year("o_orderdate").alias("year")), stored)


@query("SELECT o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS running, 100.0 * sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) / sum(o_totalprice) OVER (PARTITION BY o_custkey) AS pct FROM orders")
def f06_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return sequences.running_total(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice").select("o_orderkey", "running", "pct")


@query("SELECT s_suppkey, CAST(rank() OVER w AS INTEGER) AS r, CAST(dense_rank() OVER w AS INTEGER) AS d, CAST(ntile(4) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS quarter, lag(s_acctbal, 2) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS two_before, avg(s_acctbal) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY CAST(floor(s_acctbal / 1000) AS BIGINT) DESC)")
def f14_rank_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("s_nationkey")
    coarse, fine = w.orderBy(F.desc(F.floor(F.col("s_acctbal") / 1000))), w.orderBy(F.desc("s_acctbal"), "s_suppkey")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.rank().over(coarse).alias("r"), F.dense_rank().over(coarse).alias("d"), F.ntile(4).over(fine).alias("quarter"), F.lag("s_acctbal", 2).over(fine).alias("two_before"), F.avg("s_acctbal").over(fine.rowsBetween(-1, 1)).alias("near"))


STEM = "'Using it, describe ' || replace(text, chr(10), ' ') || CASE WHEN doc_id % 3 = 0 THEN '. Compare and contrast this. Now Explain it [3]' WHEN doc_id % 3 = 1 THEN ' State why (b) Give one' ELSE '' END"


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 3
    tail = F.when(k == 0, ". Compare and contrast this. Now Explain it [3]").when(k == 1, " State why (b) Give one").otherwise("")
    return docs(spark, sf_dir).select("doc_id", F.concat(F.lit("Using it, describe "), F.replace("text", F.lit("\n"), F.lit(" ")), tail).alias("stem"))


@query(rf"WITH s AS (SELECT doc_id, {STEM} AS s FROM documents), e AS (SELECT doc_id, unnest(regexp_extract_all(s, '\b({'|'.join(fn.ALL_MATCHES)})\b', 1)) AS command FROM s) SELECT command, count(*) AS n, count(DISTINCT doc_id) AS docs FROM e GROUP BY command")
def h04_all_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H04, first vocabulary: all matches, on made stems."""
    e = stems(spark, sf_dir).select("doc_id", F.explode(fn.command_words(F.col("stem"))).alias("command"))
    return e.groupBy("command").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(rf"WITH s AS (SELECT doc_id, {STEM} AS s FROM documents), c AS (SELECT doc_id, regexp_extract(s, '\b({'|'.join(fn.FIRST_MATCH)})\b', 1) AS a, lower(regexp_extract(s, '(?i)\b({'|'.join(fn.FIRST_MATCH)})\b', 1)) AS b FROM s) SELECT doc_id, coalesce(nullif(a, ''), nullif(upper(b[1]) || b[2:], ''), 'Other') AS command FROM c")
def h04_opening_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H04, second vocabulary: the first match, capitals before any case."""
    return stems(spark, sf_dir).select("doc_id", fn.first_command(F.col("stem")).alias("command"))


@query(rf"WITH s AS (SELECT doc_id, regexp_replace({STEM}, '\[[0-9]+\]', '', 'g') AS s FROM documents), c AS (SELECT doc_id, coalesce(regexp_extract_all(s, '(?:^|[.?)\]][ \n\t])({'|'.join(fn.LAST_MATCH)})\b', 1)[-1], regexp_extract_all(s, '\b({'|'.join(fn.LAST_MATCH)})\b', 1)[-1], regexp_extract_all(s, '(?i)\b({'|'.join(fn.LAST_MATCH)})\b', 1)[-1]) AS c FROM s) SELECT doc_id, CASE WHEN lower(c) = 'compare and contrast' THEN 'Compare and Contrast' ELSE upper(c[1]) || lower(c[2:]) END AS command FROM c")
def h04_last_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H04, third vocabulary: the last match, one that opens a sentence before others."""
    return stems(spark, sf_dir).select("doc_id", fn.last_command(F.col("stem")).alias("command"))


@query("SELECT p_partkey, '(a) x' AS a, '' AS b FROM part WHERE false UNION ALL SELECT p_partkey, '- (a) ' || p_name || ' **[' || p_size || ']**', '  - (ii) ' || p_type || chr(10) || 'plain [1] text' FROM part")
def h10_question_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.concat(F.lit("(a) "), "p_name", F.lit(" ["), "p_size", F.lit("] "))
    b = F.concat(F.lit("(ii) "), "p_type", F.lit("\nplain [1] text"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.question_body(a).alias("a"), fn.question_body(b).alias("b"))


@query("SELECT p_partkey, p_name || chr(92) || '|' || p_brand || '<br><br>**two** marks<br>' || p_type AS cell FROM part")
def h12_table_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.lit(" "), "p_name", F.lit("|"), "p_brand", F.lit("\n \n\ntwo marks\n"), "p_type", F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", fn.table_cell(t).alias("cell"))


@query("SELECT p_partkey, p_name || chr(10) || chr(10) || p_type || chr(10) || chr(10) || 'Advice: ' || p_brand AS notes, true AS same FROM part")
def h13_moved_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice goes to the end; done again nothing changes."""
    t = F.concat_ws("\n\n", "p_name", F.concat(F.lit("Advice: "), "p_brand"), "p_type")
    once = fn.moved_to_end(t, "^Advice: ")
    return table(spark, sf_dir, "part").select("p_partkey", once.alias("notes"), (fn.moved_to_end(once, "^Advice: ") == once).alias("same"))


@query("SELECT o_orderkey, ['March', 'June', 'November'][o_orderkey % 3 + 1] || ' 20' || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') AS session, ['March', 'June', 'November'][o_orderkey % 3 + 1] || ' 20' || lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') || ', page ' || o_orderkey % 9 AS source, '&lt;b&gt;' || o_orderpriority || ' &amp; &quot;x&quot;' AS html FROM orders")
def h14_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable sessions, citation labels and escaped text."""
    k = F.col("o_orderkey")
    code = F.concat(F.element_at(F.array(*map(F.lit, "msw")), (k % 3 + 1).cast("int")), F.lpad((k % 30).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.session_name(code).alias("session"), fn.citation(code, k % 9).alias("source"), fn.html_escaped(F.concat(F.lit("<b>"), "o_orderpriority", F.lit(' & "x"'))).alias("html"))


@query("WITH y AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders), g AS (SELECT o_custkey, y, y - row_number() OVER (PARTITION BY o_custkey ORDER BY y) AS run FROM y), r AS (SELECT o_custkey, min(y) AS a, max(y) AS b FROM g GROUP BY o_custkey, run) SELECT o_custkey, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ', ' ORDER BY a) AS years FROM r GROUP BY o_custkey")
def h18_year_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years as runs."""
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set(F.year("o_orderdate")).alias("y"))
    return g.select("o_custkey", fn.year_runs(F.col("y")).alias("years"))


@query("SELECT n_nationkey, n_name || ' is number ' || n_nationkey || ' of region ' || n_regionkey || '.' AS summary FROM nation")
def h19_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template of known fields."""
    return table(spark, sf_dir, "nation").select("n_nationkey", fn.filled("{name} is number {key} of region {region}.", {"name": F.col("n_name"), "key": F.col("n_nationkey"), "region": F.col("n_regionkey")}).alias("summary"))


@query("SELECT p_partkey, '<h2>' || p_name || '</h2>' || chr(10) || '<p>a <b>' || p_brand || '</b> &lt; b</p>' || chr(10) || '<ul><li>' || p_type || '</li>' || chr(10) || '<li>two</li></ul>' AS html FROM part")
def h25_markdown_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown to HTML."""
    t = F.concat(F.lit("## "), "p_name", F.lit("\n\na **"), "p_brand", F.lit("** < b\n- "), "p_type", F.lit("\n- two\n"))
    return table(spark, sf_dir, "part").select("p_partkey", fn.markdown_html(t).alias("html"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, (l_linenumber * 3 % 8) AS task, coalesce(n_name, 'no gloss') AS gloss FROM lineitem LEFT JOIN nation ON n_nationkey = l_linenumber * 3 % 8 AND n_regionkey <> 1")
def h27_gloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Original question numbers by new task numbers, with the task's gloss or a default."""
    numbers = spark.range(1, 8).select(F.col("id").cast("int").alias("l_linenumber"), (F.col("id") * 3 % 8).cast("int").alias("task"))
    gloss = table(spark, sf_dir, "nation").where("n_regionkey <> 1").select(F.col("n_nationkey").alias("task"), F.col("n_name").alias("gloss"))
    r = lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey").join(F.broadcast(numbers), "l_linenumber", "left")
    return joins.with_default(r, gloss, "task", {"gloss": F.lit("no gloss")})


@query("WITH h AS (SELECT l_orderkey AS paper, count(DISTINCT l_linenumber) AS tasks, list_sort(list_distinct(list(l_partkey % 10) FILTER (WHERE l_returnflag = 'R'))) AS pages FROM lineitem GROUP BY 1), c AS (SELECT o_orderkey AS paper, range(0, 4 + o_orderkey % 7) AS content FROM orders) SELECT paper, CASE WHEN ok THEN 'split' ELSE 'whole' END AS mode, array_to_string(CASE WHEN ok THEN pages ELSE content END, ',') AS pages FROM (SELECT c.paper, coalesce(tasks, 0) >= 2 AND coalesce(len(pages), 0) > 0 AND len(pages) <= 0.6 * len(content) AS ok, pages, content FROM c LEFT JOIN h USING (paper))")
def k13_resolved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.when(F.col("l_returnflag") == "R", F.col("l_partkey") % 10)
    hits = lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("paper")).agg(F.count_distinct("l_linenumber").alias("tasks"), F.collect_set(page).alias("pages"))
    content = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("paper"), F.sequence(F.lit(0).cast("long"), 3 + F.col("o_orderkey") % 7).alias("content"))
    r = papers.resolved_pages(hits, content)
    return r.select("paper", "mode", F.array_join(F.transform("pages", lambda x: x.cast("string")), ",").alias("pages"))


@query("WITH f AS (SELECT l_orderkey, CAST(l_linenumber * 5 % 4 AS VARCHAR) AS number, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, string_agg(number, ',' ORDER BY first) AS numbers FROM f GROUP BY 1")
def g08_whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels such as 3(a) as whole numbers, each once, in the order in which they are first seen."""
    label = F.concat((F.col("l_linenumber") * 5 % 4).cast("string"), F.lit("(a)"))
    g = lines(spark, sf_dir).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", label.alias("label")))).alias("x"))
    whole = F.transform("x", lambda x: F.regexp_extract(x["label"], "^[0-9]+", 0))
    return g.select("l_orderkey", F.array_join(reports.ordered_distinct(whole), ",").alias("numbers"))


@query(r"WITH l AS (SELECT doc_id, unnest(string_split(text || ' [3] x [4]', chr(10))) AS line, generate_subscripts(string_split(text || ' [3] x [4]', chr(10)), 1) - 1 AS nth FROM documents) SELECT doc_id, CAST(nth AS INTEGER) AS nth, md5(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line_md5, CAST(list_sum(list_transform(regexp_extract_all(line, '\[([0-9]+)\]', 1), lambda x: CAST(x AS BIGINT))) AS BIGINT) AS marks, coalesce(CAST(100 AS DOUBLE) * nth / nullif(doc_id % 3, 0), 0) AS pct FROM l")
def u07_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The functions that SQL text can call."""
    sql_functions.register(spark)
    marked = docs(spark, sf_dir).select("doc_id", F.concat("text", F.lit(" [3] x [4]")).alias("text"))
    return spark.sql("SELECT doc_id, nth, md5(CAST(squeezed(line) AS BINARY)) AS line_md5, stated_marks(line) AS marks, percent_of(nth, doc_id % 3) AS pct FROM {docs} d, LATERAL text_lines(d.text)", docs=marked)
