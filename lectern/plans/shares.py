"""Queries of the counting and share operators over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.operators import stats
from lectern.plans.base import query, table, units

#: The share of split marks: every unit here has two distinct topics.
SHARES = """sh AS (SELECT topic, sum(marks * (60 // n)) AS part FROM (SELECT DISTINCT paper, q, marks, topic, n, rid FROM
  (SELECT y.*, unnest(list_distinct(list_transform(tags, lambda z: split_part(z, '.', 1)))) AS topic, len(list_distinct(list_transform(tags, lambda z: split_part(z, '.', 1)))) AS n
   FROM (SELECT *, row_number() OVER () AS rid FROM u) y WHERE marks > 0)) GROUP BY topic),
pr AS (SELECT topic, count(DISTINCT paper) AS papers FROM x GROUP BY topic),
al AS (SELECT count(DISTINCT paper) AS n FROM u)"""


@query("WITH UNITS SELECT 'topic' AS level, topic AS name, count(*) AS n, CAST(sum(marks) AS BIGINT) AS marks, count(*) FILTER (WHERE paper NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')) AS n_unique FROM x GROUP BY topic UNION ALL SELECT 'subtopic', sub, count(*), CAST(sum(marks) AS BIGINT), count(*) FILTER (WHERE paper NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')) FROM x GROUP BY sub")
def e01_tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E01-E03. Orders with status P stand for reprints."""
    u = units(spark, sf_dir)
    return stats.tag_counts(u, table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("paper")))


@query("WITH UNITS SELECT topic, count(DISTINCT paper) AS papers, 100.0 * count(DISTINCT paper) / (SELECT count(DISTINCT paper) FROM u) AS pct FROM x GROUP BY topic")
def e04_paper_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.paper_share(units(spark, sf_dir))


@query(f"WITH UNITS, {SHARES} SELECT topic, part / 60.0 AS marks, 100.0 * part / (SELECT sum(part) FROM sh) AS pct, papers, 100.0 * papers / (SELECT n FROM al) AS appears_pct FROM sh FULL JOIN pr USING (topic)")
def e12_fractional_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E12, E14, E34."""
    return stats.fractional_shares(units(spark, sf_dir))


@query("WITH UNITS, i AS (SELECT sub, topic, sum(marks * (60 // len(tags))) AS part FROM x WHERE marks > 0 GROUP BY sub, topic) SELECT topic, sub, 100.0 * part / sum(part) OVER (PARTITION BY topic) AS pct FROM i")
def e13_share_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.share_inside(units(spark, sf_dir))


@query("WITH UNITS SELECT marks, count(*) AS n FROM u WHERE marks > 0 GROUP BY marks")
def e07_marks_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT paper, q, CAST(sum(marks) AS BIGINT) AS marks FROM u GROUP BY paper, q), h AS (SELECT marks, count(*) AS n FROM g WHERE marks > 0 GROUP BY marks) SELECT marks, n, 100.0 * n / (SELECT sum(n) FROM h) AS pct FROM h")
def e15_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sizes(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT paper, q, CAST(sum(marks) AS BIGINT) AS marks FROM u GROUP BY paper, q HAVING sum(marks) > 0) SELECT q, count(*) AS n, round_even(avg(marks), 1) AS mean, min(marks) AS least, max(marks) AS most FROM g GROUP BY q")
def e09_question_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.question_marks(units(spark, sf_dir))


@query("WITH UNITS SELECT year, topic, count(*) AS n FROM x WHERE paper NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY year, topic")
def e11_year_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.year_trend(units(spark, sf_dir), table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("paper")))


@query("WITH UNITS SELECT q, topic, count(*) AS n FROM x GROUP BY q, topic")
def e08_position_by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.position_by_topic(units(spark, sf_dir))


@query("WITH UNITS, p AS (SELECT paper, count(DISTINCT q) AS n, max(year * 10 + season) AS s FROM u GROUP BY paper), e AS (SELECT min(n) AS least, max(n) AS most, count(*) AS papers, arg_max(n, s * 100000000000 + paper) AS newest FROM p) SELECT least, most, papers, (SELECT count(*) FROM p WHERE n = least) AS fewest, newest FROM e")
def e16_questions_per_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.questions_per_paper(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT paper, q, sum(marks) AS m, max(year * 10 + season) AS s FROM u GROUP BY paper, q HAVING sum(marks) > 0), p AS (SELECT paper, count(*) AS n, max(s) AS s FROM g GROUP BY paper), e AS (SELECT min(n) AS least, max(n) AS most, count(*) AS papers, arg_max(n, s * 100000000000 + paper) AS newest FROM p) SELECT least, most, papers, (SELECT count(*) FROM p WHERE n = least) AS fewest, newest FROM e")
def e17_tasks_per_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.questions_per_paper(units(spark, sf_dir), marked_only=True)


@query("WITH UNITS, a AS (SELECT topic, 100.0 * count(DISTINCT paper) / (SELECT count(DISTINCT paper) FROM u WHERE year < 1998) AS p FROM x WHERE year < 1998 GROUP BY topic), b AS (SELECT topic, 100.0 * count(DISTINCT paper) / (SELECT count(DISTINCT paper) FROM u WHERE year >= 1998) AS p FROM x WHERE year >= 1998 GROUP BY topic) SELECT topic, coalesce(a.p, 0) AS then, coalesce(b.p, 0) AS now, coalesce(a.p, 0) >= 10 AND coalesce(b.p, 0) = 0 AS retired FROM a FULL JOIN b USING (topic)")
def d24_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D24, E32, E36."""
    return stats.presence_split(units(spark, sf_dir), 1998)


@query("WITH UNITS SELECT command, count(*) AS parts, CAST(sum(marks) AS BIGINT) AS marks, 100.0 * sum(marks) / (SELECT sum(marks) FROM u) AS pct FROM u GROUP BY command")
def e18_command_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.command_shares(units(spark, sf_dir))


@query("WITH UNITS SELECT command, count(*) AS parts, avg(marks) AS mean, max(marks) AS most, count(*) FILTER (WHERE marks = (SELECT max(marks) FROM u)) AS at_top FROM u WHERE marks > 0 GROUP BY command")
def e19_command_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.command_sizes(units(spark, sf_dir))


@query("WITH UNITS, s AS (SELECT *, row_number() OVER (ORDER BY year DESC, season DESC) AS r FROM (SELECT DISTINCT year, season FROM u)), d AS (SELECT DISTINCT topic, year, season FROM x) SELECT topic, CAST(max(year * 10 + season) // 10 AS INTEGER) AS last_year, CAST(max(year * 10 + season) % 10 AS INTEGER) AS last_season, count(*) FILTER (WHERE r <= 4) AS hits FROM d JOIN s USING (year, season) GROUP BY topic")
def e21_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.recency(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT paper, CAST(sum(marks) AS BIGINT) AS total FROM u GROUP BY paper), r AS (SELECT total, row_number() OVER (ORDER BY total) AS r, count(*) OVER () AS n FROM g), b AS (SELECT min(total) FILTER (WHERE r >= ceil(0.25 * n)) AS lo, min(total) FILTER (WHERE r >= ceil(0.75 * n)) AS hi FROM r) SELECT CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(*) AS n, 100.0 * count(*) FILTER (WHERE total BETWEEN lo AND hi) / count(*) AS inside_pct FROM g, b GROUP BY lo, hi")
def e28_percentile_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = units(spark, sf_dir).groupBy("paper").agg(F.sum("marks").alias("total"))
    out = stats.band(rows, "total", 0.25, 0.75, [])
    return out.withColumns({"lo": F.col("lo").cast("double"), "hi": F.col("hi").cast("double")})


@query("WITH UNITS, g AS (SELECT topic, paper, CAST(sum(marks * 30) AS BIGINT) AS part FROM x WHERE marks > 0 GROUP BY topic, paper), r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY part) AS r, count(*) OVER (PARTITION BY topic) AS n FROM g), b AS (SELECT topic, min(part) FILTER (WHERE r >= ceil(0.25 * n)) AS lo, min(part) FILTER (WHERE r >= ceil(0.75 * n)) AS hi FROM r GROUP BY topic) SELECT topic, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(*) AS n, 100.0 * count(*) FILTER (WHERE part BETWEEN lo AND hi) / count(*) AS inside_pct FROM g JOIN b USING (topic) GROUP BY topic, lo, hi")
def e30_topic_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.topic_bands(units(spark, sf_dir))
    return out.withColumns({"lo": F.col("lo").cast("double"), "hi": F.col("hi").cast("double")})


@query("WITH UNITS SELECT paper, q, CAST(sum(marks) AS BIGINT) AS total FROM u GROUP BY paper, q HAVING sum(marks) > 0")
def e29_task_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.question_totals(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT paper, q, CAST(sum(marks) AS BIGINT) AS total, max(year * 10 + season) AS s FROM u GROUP BY paper, q HAVING sum(marks) > 0), b AS (SELECT * FROM g ORDER BY total DESC, s DESC, paper DESC, q DESC LIMIT 1) SELECT b.paper, b.q, b.total, min(g.total) AS least_other, max(g.total) AS most_other FROM b LEFT JOIN g ON g.paper = b.paper AND g.q <> b.q GROUP BY b.paper, b.q, b.total")
def e31_biggest_task(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.biggest_task(units(spark, sf_dir))


MAP = "n AS (SELECT q, count(DISTINCT paper) AS n FROM u GROUP BY q), h AS (SELECT q, topic, count(DISTINCT paper) AS hits FROM x GROUP BY q, topic)"


@query(f"WITH UNITS, {MAP} SELECT q, n, topic, hits FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY hits DESC, topic) AS r FROM h) JOIN n USING (q) WHERE r = 1 AND n >= 10")
def e25_task_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.task_map(units(spark, sf_dir))


@query(f"WITH UNITS, {MAP} SELECT topic, q, n, share FROM (SELECT topic, q, n, 100.0 * hits / n AS share, row_number() OVER (PARTITION BY topic ORDER BY 100.0 * hits / n DESC, n DESC, q) AS r FROM h JOIN n USING (q) WHERE n >= ceil((SELECT count(DISTINCT paper) FROM u) / 2)) WHERE r = 1")
def e26_strongest_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.strongest_positions(units(spark, sf_dir))


@query(f"WITH UNITS, {SHARES}, p AS (SELECT topic, round_even(100.0 * part / (SELECT sum(part) FROM sh), 6) AS pct FROM sh), r AS (SELECT row_number() OVER (ORDER BY pct DESC, topic) AS rank, topic, pct, round_even(sum(pct) OVER (ORDER BY pct DESC, topic ROWS UNBOUNDED PRECEDING), 6) AS running FROM p), b AS (SELECT *, coalesce(lag(running) OVER (ORDER BY rank), 0) AS before FROM r) SELECT CAST(rank AS INTEGER) AS rank, topic, pct, running, CASE WHEN running >= 30 AND before < 30 THEN 'E' WHEN running >= 60 AND before < 60 THEN 'C' WHEN running >= 80 AND before < 80 THEN 'A' END AS reached FROM b")
def e24_grade_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stats.fractional_shares(units(spark, sf_dir)).select("topic", F.bround("pct", 6).alias("pct"))
    return stats.ladder(s, [("E", 30.0), ("C", 60.0), ("A", 80.0)])


@query("WITH UNITS, g AS (SELECT sub AS name, CAST(sum(marks) AS BIGINT) AS weight FROM x GROUP BY sub) SELECT CAST(row_number() OVER (ORDER BY weight DESC, name) AS INTEGER) AS rank, name, weight, 100.0 * sum(weight) OVER (ORDER BY weight DESC, name ROWS UNBOUNDED PRECEDING) / sum(weight) OVER () AS running_pct FROM g")
def e42_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = stats.tag_counts(units(spark, sf_dir)).where("level = 'subtopic'")
    return stats.pareto(t, "name", "marks")


@query("WITH UNITS SELECT topic, sub, count(*) AS n, count(DISTINCT paper) AS papers, CAST(sum(marks) AS BIGINT) AS marks FROM x GROUP BY ROLLUP (topic, sub)")
def e39_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rollup_marks(units(spark, sf_dir))


@query("WITH UNITS, g AS (SELECT sub, count(DISTINCT year * 10 + season) AS n, CAST(sum(marks) AS BIGINT) AS marks FROM x GROUP BY sub), c AS (SELECT sub, n, marks, CASE WHEN n >= 2 AND n >= 0.5 * (SELECT count(DISTINCT year * 10 + season) FROM u) THEN 'core' WHEN n >= 2 THEN 'regular' ELSE 'rare' END AS tier FROM g) SELECT tier, count(*) AS n, CAST(sum(marks) AS BIGINT) AS marks FROM c GROUP BY tier")
def e43_tier_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E41, E43."""
    u = units(spark, sf_dir)
    of = u.agg(F.count_distinct("year", "season").alias("of"))
    g = u.select("year", "season", "marks", F.explode("tags").alias("sub")).groupBy("sub").agg(F.count_distinct("year", "season").alias("n"), F.sum("marks").alias("marks"))
    return g.crossJoin(F.broadcast(of)).groupBy(stats.tier(F.col("n"), F.col("of")).alias("tier")).agg(F.count(F.lit(1)).alias("n"), F.sum("marks").alias("marks"))


@query("WITH UNITS SELECT topic, CAST(sum(marks) FILTER (WHERE season = 0) AS BIGINT) AS march, CAST(sum(marks) FILTER (WHERE season = 1) AS BIGINT) AS june, CAST(sum(marks) FILTER (WHERE season = 2) AS BIGINT) AS november FROM x GROUP BY topic")
def e39_sitting_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = units(spark, sf_dir).select("season", "marks", F.explode("tags").alias("t")).withColumn("topic", stats.topic_of(F.col("t")))
    p = t.groupBy("topic").pivot("season", [0, 1, 2]).agg(F.sum("marks"))
    return p.select("topic", F.col("0").alias("march"), F.col("1").alias("june"), F.col("2").alias("november"))


@query("WITH UNITS, d AS (SELECT paper, count(*) FILTER (WHERE len(list_filter(tags, lambda z: starts_with(z, 'FLAG R'))) > 0) AS d, count(*) AS n FROM u GROUP BY paper) SELECT paper FROM d WHERE 2 * d >= n")
def c11_reprinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.reprinted(units(spark, sf_dir).withColumn("flag", F.exists("tags", lambda t: F.startswith(t, F.lit("FLAG R")))), "flag")


@query("WITH UNITS SELECT paper, CAST(sum(marks) AS BIGINT) AS total FROM u GROUP BY paper HAVING sum(marks) = CASE WHEN min(year) < 1998 THEN 90 ELSE 70 END")
def c12_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12-C14."""
    return stats.reconciled(units(spark, sf_dir), F.when(F.col("year") < 1998, 90).otherwise(70))


@query("SELECT year, avg(raw) AS mean_raw, avg(raw / 5000.0) AS mean_pct FROM (SELECT *, row_number() OVER (PARTITION BY year ORDER BY m DESC) AS r FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, month(o_orderdate) AS m, avg(o_totalprice) AS raw FROM orders GROUP BY 1, 2)) WHERE r <= 6 GROUP BY year")
def e35_mean_of_last_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of the last six sessions (months) of each year."""
    o = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("m")).agg(F.avg("o_totalprice").alias("raw"))
    last = o.withColumn("r", F.row_number().over(Window.partitionBy("year").orderBy(F.desc("m")))).where("r <= 6")
    return last.groupBy("year").agg(F.avg("raw").alias("mean_raw"), F.avg(F.col("raw") / 5000.0).alias("mean_pct"))


@query("WITH UNITS, s AS (SELECT sub, sum(marks * 30) / 60.0 / (SELECT count(DISTINCT paper) FROM u) AS v FROM x GROUP BY sub) SELECT sub, v, CASE WHEN v < 0.25 THEN 'rarely asked' WHEN round_even(v, 0) >= 3 THEN 'HIGH' WHEN round_even(v, 0) = 2 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM s")
def e46_marks_per_paper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E46, E47."""
    u = units(spark, sf_dir)
    n = u.agg(F.count_distinct("paper").alias("papers"))
    m = stats.split_marks(u, lambda t: t).groupBy(F.col("name").alias("sub")).agg(F.sum("part").alias("part")).crossJoin(F.broadcast(n))
    v = F.col("part") / float(stats.SPLIT) / F.col("papers")
    label = F.when(v < 0.25, "rarely asked").when(F.bround(v, 0) >= 3, "HIGH").when(F.bround(v, 0) == 2, "MEDIUM").otherwise("LOW")
    return m.select("sub", v.alias("v"), label.alias("priority"))
