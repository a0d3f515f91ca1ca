"""Queries of the report operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.functions import text as fn
from lectern.operators import quality, reports, segments, stats
from lectern.operators.dedup import reprints
from lectern.plans.base import query, table, units

THEMES = [("en", "ing", ["ing\\b", "ings"]), ("en", "tion", ["tion"]), ("de", "keit", ["keit"]), ("fr", "eaux", ["eaux", "aux"]), ("es", "cion", ["ción"])]


@query("WITH h AS (SELECT doc_id, lang, unnest([CASE WHEN lang = 'en' AND regexp_matches(text, '(?i)ing|ings') THEN 'ing' END, CASE WHEN lang = 'en' AND regexp_matches(text, '(?i)tion') THEN 'tion' END, CASE WHEN lang = 'de' AND regexp_matches(text, '(?i)keit') THEN 'keit' END, CASE WHEN lang = 'fr' AND regexp_matches(text, '(?i)eaux|aux') THEN 'eaux' END, CASE WHEN lang = 'es' AND regexp_matches(text, '(?i)ción') THEN 'cion' END]) AS theme FROM documents) SELECT lang, theme, count(DISTINCT doc_id) AS n FROM h WHERE theme IS NOT NULL GROUP BY lang, theme")
def e10_theme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = [(k, n, [p.replace("\\b", "") for p in ps]) for k, n, ps in THEMES]
    return reports.theme_counts(table(spark, sf_dir, "documents"), "doc_id", "lang", "text", themes)


@query("WITH r AS (SELECT source, max(CAST(regexp_matches(text, 'idiot|clown') AS INT)) AS m FROM documents GROUP BY source) SELECT CAST(sum(m) AS BIGINT) AS mentioning, count(*) AS covering FROM r")
def e33_mention_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.mention_rate(table(spark, sf_dir, "documents"), "source", "text", "idiot|clown")


@query("WITH UNITS, g AS (SELECT topic, sub, CAST(sum(marks) AS BIGINT) AS marks FROM x GROUP BY topic, sub), r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY marks DESC, sub) AS r FROM g) SELECT topic, CASE WHEN r <= 3 THEN sub ELSE 'rest' END AS sub, CAST(sum(marks) AS BIGINT) AS marks FROM r GROUP BY 1, 2")
def k16_folded_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = units(spark, sf_dir).select("marks", F.explode("tags").alias("sub")).withColumn("topic", stats.topic_of(F.col("sub")))
    return reports.folded_tail(u.groupBy("topic", "sub").agg(F.sum("marks").alias("marks")), ["topic"], "sub", "marks", 3)


@query("WITH UNITS, h AS (SELECT DISTINCT sub, topic, year * 10 + season AS c FROM x), g AS (SELECT * FROM (SELECT DISTINCT sub, topic FROM h), (SELECT DISTINCT c FROM h)) SELECT g.sub, g.c, CASE WHEN h.sub IS NOT NULL THEN 'hit' WHEN EXISTS (SELECT 1 FROM h n WHERE n.topic = g.topic AND n.c = g.c) THEN 'present' ELSE 'absent' END AS state FROM g LEFT JOIN h ON h.sub = g.sub AND h.topic = g.topic AND h.c = g.c")
def k17_presence_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = units(spark, sf_dir)
    h = u.select((F.col("year") * 10 + F.col("season")).alias("c"), F.explode("tags").alias("sub")).withColumn("topic", stats.topic_of(F.col("sub")))
    return reports.presence_strip(h, h, "sub", "topic", "c").select("sub", F.col("c").cast("int").alias("c"), "state")


@query("""WITH UNITS, r AS (SELECT q, NULL AS sub, paper, q AS task, year * 10 + season AS sitting, CASE WHEN command <> 'NOT SPECIFIED' THEN list_sort(tags) END AS part, marks FROM u
  UNION ALL SELECT NULL, sub, paper, q, year * 10 + season, CASE WHEN command <> 'NOT SPECIFIED' THEN list_sort(tags) END, marks FROM t),
tk AS (SELECT q, sub, sitting, CAST(sum(marks) AS BIGINT) AS m FROM r GROUP BY q, sub, sitting, paper, task), pt AS (SELECT q, sub, CAST(sum(marks) AS BIGINT) AS m FROM r WHERE part IS NOT NULL GROUP BY q, sub, paper, task, part),
s AS (SELECT q, sub, count(*) AS sittings, string_agg(sitting || CASE WHEN n > 1 THEN ' (' || n || ' times)' ELSE '' END, ', ' ORDER BY sitting) AS times FROM (SELECT q, sub, sitting, count(*) AS n FROM tk GROUP BY q, sub, sitting) GROUP BY q, sub),
a AS (SELECT q, sub, CAST(sum(c) AS BIGINT) AS n, min(m) AS least, max(m) AS most, string_agg(CAST(m AS VARCHAR), ' or ' ORDER BY m) AS values, count(*) FILTER (WHERE c > 1) AS repeats FROM (SELECT q, sub, m, count(*) AS c FROM tk GROUP BY q, sub, m) GROUP BY q, sub),
b AS (SELECT q, sub, CAST(sum(c) AS BIGINT) AS n, min(m) AS least, max(m) AS most, string_agg(CAST(m AS VARCHAR), ' or ' ORDER BY m) AS values, count(*) FILTER (WHERE c > 1) AS repeats FROM (SELECT q, sub, m, count(*) AS c FROM pt GROUP BY q, sub, m) GROUP BY q, sub)
SELECT a.q, a.sub, s.sittings, s.times, a.n, a.least, a.most, a.values, a.repeats, coalesce(b.n, 0) AS part_n, b.least AS part_least, b.most AS part_most, coalesce(b.values, '') AS part_values, coalesce(b.repeats, 0) AS part_repeats
FROM a JOIN s ON a.q IS NOT DISTINCT FROM s.q AND a.sub IS NOT DISTINCT FROM s.sub LEFT JOIN b ON a.q IS NOT DISTINCT FROM b.q AND a.sub IS NOT DISTINCT FROM b.sub""")
def e45_mark_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each question number and, as the reports have them, each subtopic: the sittings with their numbers of tasks, and the marks of tasks and of their parts. What has the same tags is one part of a question; without a command a question has none."""
    u = units(spark, sf_dir)
    of = F.concat(F.array(F.struct("q", F.lit(None).cast("string").alias("sub"))), F.transform("tags", lambda s: F.struct(F.lit(None).cast("int").alias("q"), s.alias("sub"))))
    part = F.when(F.col("command") != "NOT SPECIFIED", F.array_sort("tags"))
    r = reports.mark_ranges(u.select(F.explode(of).alias("of"), "paper", F.col("q").alias("task"), (F.col("year") * 10 + F.col("season")).alias("sitting"), part.alias("part"), "marks").select("of.*", "*").drop("of"), ["q", "sub"], task=["paper", "task"])
    times = F.transform("times", lambda t: F.concat(t["sitting"].cast("string"), F.when(t["n"] > 1, F.concat(F.lit(" ("), t["n"].cast("string"), F.lit(" times)"))).otherwise("")))
    return r.withColumns({"times": F.array_join(times, ", ")} | {c: F.array_join(c, " or ") for c in ("values", "part_values")})


@query("WITH UNITS SELECT paper, CAST(sum(marks) AS BIGINT) AS total, CAST(sum(marks) - 90 AS BIGINT) AS off FROM u GROUP BY paper HAVING sum(marks) <> 90")
def e40_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.total_check(units(spark, sf_dir), 90)


@query("WITH UNITS SELECT paper, q, command, CAST(sum(marks) AS BIGINT) AS marks FROM u GROUP BY GROUPING SETS ((paper, q), (paper, q, command))")
def e56_two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.two_levels(units(spark, sf_dir))


@query("WITH UNITS SELECT 'total' AS rule, paper FROM u GROUP BY paper HAVING NOT sum(marks) BETWEEN 90 AND 140 UNION ALL SELECT DISTINCT 'twice', paper FROM (SELECT paper, q FROM u GROUP BY paper, q HAVING count(*) > 1)")
def e59_constraint_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.constraint_breaks(units(spark, sf_dir), 90, 140)


@query("WITH UNITS, i AS (SELECT topic, sub, sum(marks * (60 // len(tags))) AS part FROM x WHERE marks > 0 GROUP BY topic, sub), s AS (SELECT topic, sub, 100.0 * part / sum(part) OVER (PARTITION BY topic) AS pct FROM i), l AS (SELECT topic, max(pct) AS lead FROM s GROUP BY topic HAVING count(*) > 1 AND max(pct) < 97), p AS (SELECT topic, round_even(100.0 * sum(part) / (SELECT sum(part) FROM i), 6) AS pct FROM i GROUP BY topic) SELECT topic, pct, lead, lead > 50 AS concentrated FROM p JOIN l USING (topic) WHERE pct >= 1 ORDER BY pct DESC, topic LIMIT 4")
def e69_splittable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E69; the limit is the report's."""
    u = units(spark, sf_dir)
    t = stats.fractional_shares(u).select("topic", F.bround("pct", 6).alias("pct"))
    return reports.splittable(stats.share_inside(u), t)


@query("WITH n AS (SELECT p_name, count(*) AS n FROM part GROUP BY p_name) SELECT p_partkey, CASE WHEN n > 1 THEN p_name || '_' || p_brand ELSE p_name END AS file FROM part JOIN n USING (p_name)")
def e74_collision_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return reports.collision_names(p, "p_name", F.col("p_brand"), "file").select("p_partkey", "file")


@query("WITH f AS (SELECT l_suppkey, l_returnflag || l_linestatus AS o, min(l_partkey * 10 + l_linenumber) AS m FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, string_agg(o, ',' ORDER BY m, o) AS owners FROM f GROUP BY l_suppkey")
def e75_owners_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("o"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("at"))
    return reports.owners_in_order(li, "l_suppkey", "o", "at").select("l_suppkey", F.array_join("owners", ",").alias("owners"))


@query("SELECT o_orderkey, greatest(3, least(34, CAST(round_even(1.7 * (o_orderkey % 25), 0) AS INTEGER))) AS lines, CASE WHEN o_orderkey % 4 >= 2 AND o_orderkey % 7 > 0 AND o_orderkey % 7 <= 0.6 * (o_orderkey % 11) THEN 'split' ELSE 'whole' END AS how FROM orders")
def k07_answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K07."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", reports.answer_lines(k % 25).alias("lines"), reports.split_or_whole(k % 4, k % 7, k % 11).alias("how"))


@query("SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 30) * 6 + 15 ELSE o_orderkey % 30 + o_orderkey % 9 END AS BIGINT) AS total FROM orders")
def h26_number_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the numbers of made headings, a range or a list."""
    k = F.col("o_orderkey")
    head = F.when(k % 2 == 0, F.concat((k % 30).cast("string"), F.lit(" - "), (k % 30 + 5).cast("string"))).otherwise(F.concat((k % 30).cast("string"), F.lit(" and "), (k % 9).cast("string")))
    total = F.aggregate(reports.number_list(head), F.lit(0).cast("long"), lambda s, x: s + x)
    return table(spark, sf_dir, "orders").select("o_orderkey", total.alias("total"))


@query(r"WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.?])\s+', '\1' || chr(1), 'g'), chr(1))) AS sentence FROM documents) SELECT doc_id, count(*) AS n, CAST(sum(length(sentence)) AS BIGINT) AS chars FROM s WHERE length(sentence) BETWEEN 31 AND 699 AND regexp_matches('  ' || regexp_replace(lower(sentence), '[^\p{L}\p{N}\p{M}_]+', '  ', 'g'), ' the') GROUP BY doc_id")
def h28_sentences_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H07, H28."""
    s = reports.sentences_naming(table(spark, sf_dir, "documents"), "doc_id", "text", "the")
    return s.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sentence")).alias("chars"))


@query(r"SELECT doc_id, len(string_split(text, chr(10))) - len(regexp_extract_all(text, '\n[a-z/)]')) AS lines FROM documents")
def h11_reflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.split(reports.reflowed(F.col("text")), "\n", -1)).cast("long").alias("lines"))


@query("WITH a AS (SELECT p_type AS w FROM part WHERE p_size < 20), b AS (SELECT p_type AS w FROM part WHERE p_size >= 10) SELECT 'union' AS op, count(*) AS n FROM (SELECT w FROM a UNION SELECT w FROM b) UNION ALL SELECT 'minus', count(*) FROM (SELECT w FROM a EXCEPT ALL SELECT w FROM b) UNION ALL SELECT 'both', count(*) FROM (SELECT w FROM a INTERSECT SELECT w FROM b) UNION ALL SELECT 'bag', count(*) FROM (SELECT w FROM a UNION ALL SELECT w FROM b)")
def g06_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G06, G07."""
    p = table(spark, sf_dir, "part")
    a, b = p.where("p_size < 20").select("p_type"), p.where("p_size >= 10").select("p_type")
    one = lambda name, df: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
    return one("union", a.union(b).distinct()).union(one("minus", a.exceptAll(b))).union(one("both", a.intersect(b))).union(one("bag", a.unionAll(b)))


@query("SELECT event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type ORDER BY n DESC, first LIMIT 3")
def g02_most_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most common, ties by first occurrence; the limit is the feature."""
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"))
    return e.orderBy(F.desc("n"), "first").limit(3)


@query("WITH f AS (SELECT text, list(doc_id ORDER BY doc_id) AS ids FROM documents GROUP BY text) SELECT ids[1] AS keeper, unnest(ids[2:]) AS reprint FROM f WHERE len(ids) > 1")
def d17_keeper_reprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("k"))
    return reprints(d, [F.col("k")], F.col("doc_id"), "doc_id")


@query("WITH UNITS, s AS (SELECT topic, count(DISTINCT year * 10 + season) AS sittings, CAST(sum(marks) AS BIGINT) AS marks FROM x GROUP BY topic) SELECT topic, sittings, marks, marks / sittings AS per_sitting FROM s")
def e44_average_when_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = units(spark, sf_dir).select("year", "season", "marks", F.explode("tags").alias("t")).groupBy(stats.topic_of(F.col("t")).alias("topic")).agg(F.count_distinct("year", "season").alias("sittings"), F.sum("marks").alias("marks"))
    return u.withColumn("per_sitting", F.col("marks") / F.col("sittings"))


@query("WITH UNITS, s AS (SELECT sub, count(DISTINCT year * 10 + season) AS n, CAST(sum(marks) AS BIGINT) AS marks FROM x GROUP BY sub) SELECT CAST(row_number() OVER (ORDER BY CASE WHEN n >= 2 THEN 0 ELSE 1 END, n DESC, marks DESC, sub) AS INTEGER) AS rank, sub, n, marks FROM s ORDER BY rank LIMIT 15")
def e68_most_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 15, as the report has them."""
    s = units(spark, sf_dir).select("year", "season", "marks", F.explode("tags").alias("sub")).groupBy("sub").agg(F.count_distinct("year", "season").alias("n"), F.sum("marks").alias("marks"))
    order = [F.when(F.col("n") >= 2, 0).otherwise(1), F.desc("n"), F.desc("marks"), F.asc("sub")]
    return s.orderBy(*order).limit(15).withColumn("rank", F.row_number().over(Window.orderBy(*order))).select("rank", "sub", "n", "marks")


@query("WITH UNITS, p AS (SELECT topic, 100.0 * count(DISTINCT paper) / (SELECT count(DISTINCT paper) FROM u) AS pct FROM x GROUP BY topic) SELECT topic, pct FROM p WHERE pct >= 50 AND topic NOT IN (SELECT topic FROM x WHERE paper = (SELECT max(paper) FROM u))")
def e64_absent_usual(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = units(spark, sf_dir)
    newest = u.agg(F.max("paper").alias("paper"))
    there = u.join(F.broadcast(newest), "paper").select(F.explode("tags").alias("t")).select(stats.topic_of(F.col("t")).alias("topic")).distinct()
    return stats.paper_share(u).where("pct >= 50").join(there, "topic", "left_anti").select("topic", "pct")


@query("WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS n FROM (SELECT doc_id, '| ' || replace(line, ' ', ' | ') || ' |' AS line FROM l) WHERE len(string_split(line, '|')) - 1 <> 4 GROUP BY doc_id")
def e52_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = segments.line_table(table(spark, sf_dir, "documents"), "doc_id", "text").withColumn("line", F.concat(F.lit("| "), F.replace(F.col("line"), F.lit(" "), F.lit(" | ")), F.lit(" |")))
    return quality.malformed_rows(lines, "line").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("WITH f AS (SELECT source, sha256(string_agg(p, '' ORDER BY p)) AS print FROM (SELECT source, d[1:3] || sha256(string_agg(d, '' ORDER BY d)) AS p FROM (SELECT source, sha256(CAST(doc_id AS VARCHAR) || chr(1) || text || chr(1)) AS d FROM documents) GROUP BY source, d[1:3]) GROUP BY source), g AS (SELECT source, sha256(string_agg(p, '' ORDER BY p)) AS print FROM (SELECT source, d[1:3] || sha256(string_agg(d, '' ORDER BY d)) AS p FROM (SELECT source, sha256(CAST(doc_id AS VARCHAR) || chr(1) || text || chr(1)) AS d FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)) GROUP BY source, d[1:3]) GROUP BY source) SELECT f.source, f.print <> g.print OR g.print IS NULL AS stale FROM f LEFT JOIN g USING (source)")
def d28_stale_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prints of before against those of inputs that lost their toxic documents."""
    d = table(spark, sf_dir, "documents")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    now = quality.fingerprints(d.join(toxic, "doc_id", "left_anti"), ["source"], "doc_id", "text")
    return quality.stale(quality.fingerprints(d, ["source"], "doc_id", "text"), now, "source")


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'reports' WHEN page_id % 5 = 1 THEN 'thresholds' ELSE 'paper' || CASE WHEN (page_id % 40) < 10 THEN page_id % 40 ELSE page_id % 40 // 10 END END AS folder, 's' || page_id % 26 AS sitting, CAST(page_id % 9 AS VARCHAR) AS task, CASE WHEN page_id % 2 = 0 THEN '(c)' END AS part FROM pages")
def c23_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of made file names, and parts of made refs."""
    k = F.col("page_id")
    kind = F.when(k % 5 == 0, "er").when(k % 5 == 1, "gt").otherwise("qp")
    name = F.concat(F.lit("9626_s24_"), kind, F.lit("_"), F.lpad((k % 40).cast("string"), 2, "0"), F.lit(".pdf"))
    ref = F.concat(F.lit("s"), (k % 26).cast("string"), F.lit(" "), (k % 9).cast("string"), F.when(k % 2 == 0, "(c)").otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", reports.routed(name).alias("folder"), reports.ref_parts(ref).alias("r")).select("page_id", "folder", "r.*")


@query(r"SELECT doc_id, substr(trim(regexp_replace(regexp_replace(text, '!\[[^\]]*\]\([^)]*\)|\.{2,}', ' ', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')), 1, 420) AS stem FROM documents")
def a07_compact_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A06, A07."""
    bare = F.regexp_replace("text", r"!\[[^\]]*\]\([^)]*\)|\.{2,}", " ")
    return table(spark, sf_dir, "documents").select("doc_id", F.substring(fn.squeeze(bare), 1, 420).alias("stem"))


@query("SELECT source, count(DISTINCT lang) AS kept, (SELECT count(DISTINCT lang) FROM documents) AS available, min(n_chars) AS least, max(n_chars) AS most, count(*) AS n FROM documents GROUP BY source")
def e27_kept_and_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E27."""
    d = table(spark, sf_dir, "documents")
    g = d.groupBy("source").agg(F.count_distinct("lang").alias("kept"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.count(F.lit(1)).alias("n"))
    return g.crossJoin(F.broadcast(d.agg(F.count_distinct("lang").alias("available"))))
