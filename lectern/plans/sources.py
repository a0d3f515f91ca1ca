"""Queries of the readers' parsers. Their texts are made from the tables; the SQL gives what was put in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import topics
from lectern.plans.base import query, table
from lectern.sources import readers


def said(*parts: object) -> Column:
    """Text from pieces: strings as they are, columns as text."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def in_order(rows: DataFrame, by: str, order: list[str], line: Column) -> DataFrame:
    """by, text: the lines of each group, one below the other."""
    g = rows.select(by, F.struct(*order, line.alias("__line")).alias("x")).groupBy(by).agg(F.array_sort(F.collect_list("x")).alias("x"))
    return g.select(by, F.array_join("x.__line", "\n").alias("text"))


@query("""WITH g AS (SELECT l_orderkey AS paper, l_linenumber AS n, CAST(sum(l_quantity) AS BIGINT) AS qt, max(l_partkey) AS pk FROM lineitem GROUP BY ALL),
m AS (SELECT paper, CAST(n AS VARCHAR) AS q, qt % 30 AS header_marks, CASE pk % 4 WHEN 0 THEN 0 WHEN 1 THEN pk % 9 ELSE 2 + pk % 5 END AS printed, CASE WHEN pk % 3 = 0 THEN pk % 7 END AS single FROM g)
SELECT paper, q, header_marks, coalesce(nullif(printed, 0), nullif(single, 0), nullif(header_marks, 0)) AS marks FROM m""")
def c18_marks_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of a Markdown question, as printed in its body, else those of its scheme if they stand there once, else those of its header. An order is a paper, its lines the questions."""
    g = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("paper"), F.col("l_linenumber").alias("n")).agg(F.sum("l_quantity").cast("long").alias("qt"), F.max("l_partkey").alias("pk"))
    pk = F.col("pk")
    printed = F.when(pk % 4 == 0, "").when(pk % 4 == 1, said(" **[", pk % 9, "]**")).otherwise(said(" **[2]** and **[", pk % 5, "]**"))
    scheme = F.when(pk % 3 == 0, said("\n### Mark scheme\n**Marks: ", pk % 7, "**")).when(pk % 3 == 1, "\n### Mark scheme\n**Marks: 3** or **Marks: 4**").otherwise("")
    block = said("## Question ", F.col("n"), " - ", F.col("qt") % 30, " marks\nDo this", printed, scheme)
    return readers.markdown_questions(in_order(g, "paper", ["n"], block)).select("paper", "q", "header_marks", "marks")


def grade(maximum: Column, k: int) -> Column:
    """A threshold that is a dash in some rows."""
    return F.when((F.col("l_partkey") + k) % 6 == 0, "-").otherwise((maximum - 5 * k).cast("string"))


@query("""WITH g AS (SELECT l_orderkey AS code, lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') AS component, l_partkey AS pk, 40 + l_suppkey % 60 AS m FROM lineitem WHERE l_partkey % 11 <> 0)
SELECT code, component, CAST(m AS INTEGER) AS max, """ + ", ".join(f"CAST(CASE WHEN (pk + {k}) % 6 <> 0 THEN m - {5 * k} END AS INTEGER) AS {n}" for k, n in enumerate("ABCDE", 1)) + " FROM g")
def a12_component_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component rows of a threshold text; lines that lack cells have no row. An order is a text."""
    top = 40 + F.col("l_suppkey") % 60
    cells = [p for k in range(1, 6) for p in (" ", grade(top, k))]
    line = said("Component ", F.lpad((F.col("l_partkey") % 100).cast("string"), 2, "0"), "   ", top, *cells)
    line = F.when(F.col("l_partkey") % 11 == 0, said("Component 12 ", top, " 55 46")).otherwise(line)
    texts = in_order(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("line")), "l_orderkey", ["l_linenumber"], F.col("line"))
    return readers.grade_rows(texts, "l_orderkey")


@query("""WITH g AS (SELECT l_orderkey AS code, l_partkey AS pk, l_suppkey AS sk, 100 + l_partkey % 800 AS m FROM lineitem WHERE l_partkey % 10 <> 0)
SELECT code, chr(CAST(65 + pk % 26 AS INTEGER)) || chr(CAST(65 + sk % 26 AS INTEGER)) || CASE pk % 3 WHEN 0 THEN 'J' WHEN 1 THEN 'N' ELSE '' END AS option, '11|' || lpad(CAST(sk % 100 AS VARCHAR), 2, '0') || CASE WHEN pk % 2 = 0 THEN '|31' ELSE '' END AS components,
  CAST(CASE WHEN pk % 4 <> 0 THEN m END AS INTEGER) AS max, CAST(CASE WHEN sk % 3 <> 0 THEN m - 7 END AS INTEGER) AS A_star, """ + ", ".join(f"CAST(m - {9 * k} AS INTEGER) AS {n}" for k, n in enumerate("ABCDE", 1)) + " FROM g")
def a12_option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option rows of a threshold text, some without a printed maximum or a top grade; an option of one component has no row. An order is a text."""
    pk, sk, m = F.col("l_partkey"), F.col("l_suppkey"), 100 + F.col("l_partkey") % 800
    name = F.concat(F.char((65 + pk % 26).cast("long")), F.char((65 + sk % 26).cast("long")), F.when(pk % 3 == 0, "J").when(pk % 3 == 1, "N").otherwise(""))
    parts = F.when(pk % 10 == 0, "11").otherwise(said("11, ", F.lpad((sk % 100).cast("string"), 2, "0"), F.when(pk % 2 == 0, ",31").otherwise("")))
    line = said("  ", name, "  ", F.when(pk % 4 == 0, "").otherwise(said(m, " ")), parts, "  ", F.when(sk % 3 == 0, "–").otherwise((m - 7).cast("string")), *(x for k in range(1, 6) for x in (" ", m - 9 * k)))
    texts = in_order(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", line.alias("line")), "l_orderkey", ["l_linenumber"], F.col("line"))
    rows = readers.option_rows(texts, "l_orderkey")
    return rows.withColumn("components", F.array_join("components", "|"))


@query("""WITH s AS (SELECT p_brand AS topic, upper(p_brand) AS topic_name, unnest(CASE WHEN p_size % 4 = 0 THEN [NULL] ELSE [{'k': '1.' || p_size, 'v': p_type}, {'k': '2', 'v': 'é "' || p_size || '"'}] END) AS s FROM part)
SELECT topic, topic_name, s.k AS sub, s.v AS sub_name, count(*) AS n FROM s GROUP BY ALL""")
def a10_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: topics and their subtopics from JSON maps, topics without any included. A part is a map of one topic."""
    size = F.col("p_size").cast("string")
    subs = F.when(F.col("p_size") % 4 == 0, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.concat(F.lit("1."), size), F.col("p_type"), F.lit("2"), said('é "', size, '"')))
    text = table(spark, sf_dir, "part").select(F.to_json(F.create_map("p_brand", F.struct(F.upper("p_brand").alias("name"), subs.alias("subtopics")))).alias("value"))
    return readers.taxonomy(text).groupBy("topic", "topic_name", "sub", "sub_name").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT 'c' || o_orderkey AS code, o_orderstatus AS paper, CAST(q AS VARCHAR) AS q, CAST(CASE WHEN (o_orderkey + q) % 5 <> 0 THEN o_orderkey % 20 + q END AS INTEGER) AS marks, o_orderpriority || '|' || q AS tags, CASE WHEN q = 1 THEN 'says "' || o_orderstatus || '"' END AS what
FROM orders, generate_series(1, o_orderkey % 4) AS t(q)""")
def a11_newest_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of papers in JSON maps; keys that begin with _ are left out, and so are papers without questions. An order is a map of one paper and a note."""
    k = F.col("o_orderkey")
    ask = lambda q: F.struct(q.cast("string").alias("q"), F.when((k + q) % 5 != 0, k % 20 + q).alias("marks"), F.array(F.col("o_orderpriority"), q.cast("string")).alias("tags"), F.when(q == 1, said('says "', F.col("o_orderstatus"), '"')).alias("what"))
    asked = F.when(k % 4 > 0, F.transform(F.sequence(F.lit(1), (k % 4).cast("int")), ask))
    paper = F.struct(F.col("o_orderstatus").alias("paper"), asked.alias("questions"))
    text = table(spark, sf_dir, "orders").select(F.to_json(F.create_map(F.lit("_note"), paper, said("c", k), paper)).alias("value"))
    return readers.newest_papers(text).withColumn("tags", F.array_join("tags", "|"))


@query("""WITH u AS (SELECT o_orderkey AS id, o_orderkey % 6 + 3 AS v, 2000 + 15 + o_custkey % 9 AS year, substr('msw', CAST(o_orderkey % 3 + 1 AS INTEGER), 1) AS season, o_orderkey % 9 AS q, CASE WHEN o_orderkey % 4 = 1 THEN 'a' ELSE '' END AS part,
    CASE WHEN o_orderkey % 4 = 1 THEN 'Stem' || chr(10) ELSE '' END || 'Say | ' || o_orderpriority AS text, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'It is ' || o_orderstatus END AS ms, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 5 AS VARCHAR) ELSE '' END AS marks, o_orderkey % 10 = 4 AS dupe FROM orders),
c AS (SELECT *, '3' || v AS variant, '9626_' || season || year % 100 || '_qp_3' || v AS code, q || part AS label FROM u),
k AS (SELECT a.*, CASE WHEN a.id % 10 = 3 AND b.id IS NOT NULL THEN b.variant END AS v2, CASE WHEN a.id % 10 = 3 AND b.id IS NOT NULL THEN b.code END AS code2, b.label AS label2 FROM c a LEFT JOIN c b ON b.id = a.id + 1 AND a.id % 10 = 3 WHERE NOT a.dupe),
e AS (SELECT *, '#### P ' || variant || coalesce(' + ' || v2, '') || ' | ' || upper(season) || ' ' || year || ' | [[' || code || '.pdf|Question' || CASE WHEN code2 IS NULL THEN '' ELSE ' P' || variant END || ']] | [[' || replace(code, 'qp', 'ms') || '.pdf|Answer' || CASE WHEN code2 IS NULL THEN '' ELSE ' P' || variant END || ']]'
    || coalesce(' | [[' || code2 || '.pdf|Question P' || v2 || ']] | [[' || replace(code2, 'qp', 'ms') || '.pdf|Answer P' || v2 || ']]', '') AS head, label || coalesce(' / ' || label2, '') AS no FROM k),
b AS (SELECT *, head || chr(10) || chr(10) || '| No. | Question | Marks |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || no || ' | ' || replace(replace(text, '|', '\\|'), chr(10), '<br>') || ' | ' || marks || ' |' || chr(10) || chr(10)
    || '| Question | Answer | Marks |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| ' || no || ' | ' || CASE WHEN ms = '' THEN '*Mark scheme is a diagram — see the linked PDF.*' ELSE ms END || ' | ' || marks || ' |' || chr(10) || chr(10) || '---' || chr(10) AS block FROM e),
s AS (SELECT DISTINCT id, year, block, unnest([id % 3 + 1, id % 2 + 2]) AS t, id % 11 AS z FROM b WHERE id % 8 <> 5),
p AS (SELECT *, t || '.' || z AS sub, t || ' ' || 'T-' || t AS file FROM s WHERE z < 10)
SELECT '3' AS paper, file, 1 AS kind, 1 AS level, sub, CAST(year AS INTEGER) AS year, id, block FROM p
UNION ALL SELECT DISTINCT '3', file, 1, 0, sub, NULL, NULL, '## ' || sub || ' S' || sub || chr(10) FROM p
UNION ALL SELECT DISTINCT '3', file, 0, 0, NULL, NULL, NULL, '# ' || t || ' T/' || t || ' — Paper 3' || chr(10) FROM p""")
def b04_topic_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of topic files. An order is a question, every tenth has a reprint; subtopics are made from parts' sizes."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    code = said("9626_", F.substring(F.lit("msw"), (k % 3 + 1).cast("int"), F.lit(1)), 15 + F.col("o_custkey") % 9, "_qp_3", k % 6 + 3)
    units = o.select(
        k.alias("id"), code.alias("paper"), (k % 9).cast("string").alias("q"), F.when(k % 4 == 1, "a").alias("part"), F.when(k % 4 == 1, "Stem").when(k % 4 == 2, " ").alias("stem"), F.lit(None).cast("string").alias("part_stem"),
        said("Say | ", F.col("o_orderpriority")).alias("text"), F.when(k % 14 == 0, " ").when(k % 7 != 0, said("It is ", F.col("o_orderstatus"))).alias("ms"), F.when(k % 5 != 0, k % 5).alias("marks"), F.when(k % 10 == 4, k - 1).alias("dupe_of"), F.when(k % 10 == 3, F.array(k + 1)).alias("also_in"),
    )
    sub = lambda t: said(t, ".", k % 11)
    tags = o.where(k % 8 != 5).select(k.alias("id"), F.array(sub(k % 3 + 1), sub(k % 2 + 2)).alias("topics"))
    t = F.explode(F.array(*(F.lit(str(i)) for i in (1, 2, 3)))).alias("topic")
    tree = table(spark, sf_dir, "part").select((F.col("p_size") % 10).cast("string").alias("z")).distinct().select(t, "z")
    tree = tree.select("topic", said("T/", F.col("topic")).alias("topic_name"), said(F.col("topic"), ".", F.col("z")).alias("sub"), said("S", F.col("topic"), ".", F.col("z")).alias("sub_name"))
    return topics.topic_files(units, tags, tree).select("paper", "file", "kind", "level", "sub", "year", "id", "block")
