"""Queries of the ordered-row operators and of the joins over events, conversations, orders and small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fn
from lectern.operators import dedup, graphs, joins, sequences
from lectern.plans.base import query, table, units


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked FROM conversations")
def f04_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was asked last."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.char_length("text").cast("long")).alias("v"))
    return sequences.carried(c, ["conv_id"], ["turn"], "v", "asked").select("conv_id", "turn", "asked")


@query("SELECT event_id, user_id, (SELECT arg_max(s.value, s.ts) FROM events s WHERE s.event_type = 'purchase' AND s.user_id = e.user_id AND s.ts <= e.ts) AS last_purchase FROM events e WHERE event_type <> 'purchase'")
def d12_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The purchase in force at each other event."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    rows = e.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    facts = e.where("event_type = 'purchase'").select("user_id", "ts", "value")
    return sequences.as_of(rows, facts, ["user_id"], "ts", "value", "last_purchase").select("event_id", "user_id", "last_purchase")


@query("WITH d AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h FROM events), g AS (SELECT user_id, h, h - row_number() OVER (PARTITION BY user_id ORDER BY h) AS run FROM d) SELECT user_id, min(h) AS first, max(h) AS last, count(*) AS n FROM g GROUP BY user_id, run")
def f10_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", F.expr("timestampdiff(HOUR, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("h"))
    return sequences.islands(e, ["user_id"], "h")


INTERVALS = "i AS (SELECT l_suppkey AS g, CAST(l_partkey AS BIGINT) AS lo, CAST(l_partkey + l_quantity AS BIGINT) AS hi FROM lineitem), m AS (SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY g ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM i), r AS (SELECT *, sum(fresh) OVER (PARTITION BY g ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM m), b AS (SELECT g, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM r GROUP BY g, run)"


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("g"), lo.alias("lo"), (lo + F.col("l_quantity")).cast("long").alias("hi"))


@query(f"WITH {INTERVALS} SELECT * FROM b")
def f11_merged_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F08, F09, F11."""
    return sequences.merged_intervals(intervals(spark, sf_dir), ["g"], "lo", "hi", 1)


@query(f"WITH {INTERVALS} SELECT * FROM (SELECT g, hi AS gap_lo, lead(lo) OVER (PARTITION BY g ORDER BY lo) AS gap_hi, (hi + lead(lo) OVER (PARTITION BY g ORDER BY lo)) / 2 AS cut FROM b) WHERE gap_hi IS NOT NULL")
def f12_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.gaps_between(f11_merged_intervals(spark, sf_dir), ["g"], "lo", "hi")


@query("SELECT conv_id, turn, length(text) AS n, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations")
def f07_adjacent(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.char_length("text").cast("long").alias("n"), "role")
    return sequences.adjacent(c, ["conv_id"], ["turn"], "role").drop("role")


@query("WITH d AS (SELECT DISTINCT s_nationkey AS g, s_suppkey AS o, s_suppkey % 7 AS v FROM supplier) SELECT a.g, a.o, array_to_string(list_sort(list_distinct(list(b.v))), ',') AS seen FROM d a JOIN d b ON a.g = b.g AND b.o <= a.o GROUP BY a.g, a.o")
def e58_running_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("o"), F.array(F.col("s_suppkey") % 7).alias("v"))
    r = sequences.running_set(s, ["g"], ["o"], "v", "seen")
    return r.select("g", "o", F.array_join(F.transform("seen", lambda x: x.cast("string")), ",").alias("seen"))


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 70")
def g04_capped_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap is the feature."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    r = sequences.ranked(li, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")], 70)
    return r.drop("l_partkey")


@query("SELECT user_id, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value, count(*) AS n FROM events GROUP BY user_id")
def g09_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later row of a key wins."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return e.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("l"), F.count(F.lit(1)).alias("n")).select("user_id", "l.event_type", "l.value", "n")


@query("WITH y AS (SELECT o_orderpriority AS g, CAST(year(o_orderdate) AS INTEGER) AS y, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2), t AS (SELECT g, arg_max(y, v) AS peak_year, max(v) AS peak FROM y GROUP BY g), a AS (SELECT y.g, y.y, v, lag(v) OVER (PARTITION BY y.g ORDER BY y.y) AS b FROM y), s AS (SELECT a.g, min(a.y) AS stop FROM a JOIN t USING (g) WHERE a.y > peak_year AND NOT v < b GROUP BY a.g) SELECT t.g AS o_orderpriority, peak_year, peak, CAST(coalesce((SELECT max(a.y) FROM a WHERE a.g = t.g AND a.y > peak_year AND a.y < coalesce(stop, 9999)), peak_year) AS INTEGER) AS fell_until FROM t LEFT JOIN s USING (g)")
def e61_falling_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.year("o_orderdate").alias("y"), "o_totalprice")
    return sequences.falling_run(o, "o_orderpriority", "y", "o_totalprice")


@query("WITH s AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS season FROM orders), e AS (SELECT min(year * 100 + season) AS a, max(year * 100 + season) AS b FROM s), g AS (SELECT CAST(y AS INTEGER) AS year, season FROM e, generate_series(CAST(a // 100 AS BIGINT), CAST(b // 100 AS BIGINT)) t(y), (SELECT DISTINCT season FROM s) WHERE y * 100 + season > a AND y * 100 + season < b) SELECT year, season FROM g ANTI JOIN s USING (year, season)")
def d25_calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions are the months with an order. The tables lack none, so the result is empty; a test has gaps."""
    o = table(spark, sf_dir, "orders")
    return joins.calendar_gaps(o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("season")))


@query("WITH p AS (SELECT source AS sitting, lang AS variant, md5(text) AS t FROM documents), v AS (SELECT sitting, variant, count(*) AS parts FROM p GROUP BY 1, 2), q AS (SELECT a.sitting, a.variant AS a, b.variant AS b, b.parts FROM v a JOIN v b ON a.sitting = b.sitting AND a.variant < b.variant) SELECT q.sitting, a, b, parts, c AS copied, 2 * c >= parts AS twin FROM (SELECT q.*, (SELECT count(*) FROM p y WHERE y.sitting = q.sitting AND y.variant = q.b AND y.t IN (SELECT t FROM p x WHERE x.sitting = q.sitting AND x.variant = q.a)) AS c FROM q) q")
def d18_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "documents").select(F.col("source").alias("sitting"), F.col("lang").alias("variant"), F.md5(F.col("text").cast("binary")).alias("text"))
    return joins.twins(p).select("sitting", "a", "b", "parts", "copied", "twin")


@query("WITH c AS (SELECT DISTINCT o_custkey % 50 AS k, o_orderpriority AS owner FROM orders), e AS (SELECT k, list_sort(list(owner)) AS a FROM c GROUP BY k) SELECT k, owner, array_to_string(list_filter(a, lambda x: x <> owner), ',') AS also FROM c JOIN e USING (k)")
def d21_shared_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D21."""
    c = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("k"), F.col("o_orderpriority").alias("owner"))
    return joins.shared_claims(c, ["k"], "owner").select("k", "owner", F.array_join("also", ",").alias("also"))


@query("WITH w AS (SELECT p_brand AS id, p_name AS name, p_partkey FROM part), h AS (SELECT DISTINCT p_brand AS id, lower(p_name) AS h FROM part WHERE p_size > 25) SELECT id, name, p_partkey FROM w WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.id = w.id AND ends_with(h.h, lower(w.name)))")
def d22_not_shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D22."""
    p = table(spark, sf_dir, "part")
    names = p.select(F.col("p_brand").alias("id"), F.col("p_name").alias("name")).distinct()
    gone = joins.not_shipped(names, p.where("p_size > 25").select(F.col("p_brand").alias("id"), F.col("p_name").alias("have")).distinct())
    return p.select(F.col("p_brand").alias("id"), F.col("p_name").alias("name"), "p_partkey").join(gone, ["id", "name"], "left_semi")


@query("SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2")
def d05_default_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    return joins.named(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey").select("c_custkey", "name")


@query("WITH a AS (SELECT s_suppkey AS id, 'dir' || CAST((s_suppkey + k) % 40 AS VARCHAR) AS dir, k FROM supplier, generate_series(0, 2) t(k)), p AS (SELECT 'dir' || CAST(n_nationkey AS VARCHAR) AS dir FROM nation) SELECT s_suppkey AS id, (SELECT arg_min(a.dir, k) FROM a SEMI JOIN p USING (dir) WHERE a.id = s_suppkey) AS dir FROM supplier")
def d16_first_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    a = s.select("id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("priority")).withColumn("dir", F.concat(F.lit("dir"), ((F.col("id") + F.col("priority")) % 40).cast("string")))
    present = table(spark, sf_dir, "nation").select(F.concat(F.lit("dir"), F.col("n_nationkey").cast("string")).alias("dir"))
    return joins.first_alias(s, a, present)


@query("WITH f AS (SELECT text, min(doc_id) AS first FROM documents GROUP BY text), u AS (SELECT doc_id AS id, CASE WHEN first <> doc_id THEN first END AS dupe_of FROM documents JOIN f USING (text)) SELECT id, coalesce(a.quality, b.quality) AS quality FROM u LEFT JOIN labels a ON a.doc_id = id LEFT JOIN labels b ON b.doc_id = dupe_of")
def d02_inherited_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy without a label has that of the first."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.sha2(F.col("text").cast("binary"), 256).alias("k"))
    u = dedup.folded(d, [F.col("k")], F.col("id"), "id").select("id", "dupe_of")
    tags = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.array("quality").alias("tags"))
    return joins.inherited_tags(u, tags).select("id", F.col("tags")[0].alias("quality"))


@query("WITH UNITS, v AS (SELECT DISTINCT p_type || '.' || p_brand AS tag FROM part WHERE p_size < 25) SELECT sub AS tag, count(*) AS n FROM x WHERE NOT EXISTS (SELECT 1 FROM v WHERE tag = sub) GROUP BY sub")
def d04_invalid_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tax = table(spark, sf_dir, "part").where("p_size < 25").select(F.concat_ws(".", "p_type", "p_brand").alias("tag")).distinct()
    u = units(spark, sf_dir).select(F.col("paper").alias("id"), "tags")
    return joins.invalid_tags(u, tax).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query("WITH RECURSIVE p AS (SELECT user_id AS a, CAST(substr(props, 7, length(props) - 7) AS BIGINT) + 1000000 AS b FROM events WHERE event_type = 'signup'), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r AS (SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a) SELECT a AS node, min(b) AS component FROM r GROUP BY a")
def d27_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and the values of their signups, linked."""
    k = F.get_json_object("props", "$.k").cast("long") + 1000000
    e = table(spark, sf_dir, "events").where("event_type = 'signup'").select(F.col("user_id").alias("u"), k.alias("v"))
    return graphs.components(e)


@query("SELECT o_orderkey, CASE WHEN h = 0 THEN '' ELSE h || 'h ' END || m || 'm' AS duration, h * 60 + m AS minutes, CASE WHEN q <= 20 THEN ['zero','one','two','three','four','five','six','seven','eight','nine','ten','eleven','twelve','thirteen','fourteen','fifteen','sixteen','seventeen','eighteen','nineteen','twenty'][q + 1] ELSE CAST(q AS VARCHAR) END AS word FROM (SELECT o_orderkey, CAST(o_orderkey % 4 AS INTEGER) AS h, CAST(o_orderkey % 60 AS INTEGER) AS m, CAST(o_orderkey % 25 AS INTEGER) AS q FROM orders)")
def h22_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H18, H22."""
    h, m, q = ((F.col("o_orderkey") % n).cast("int") for n in (4, 60, 25))
    d = F.concat(F.when(h == 0, "").otherwise(F.concat(h.cast("string"), F.lit("h "))), m.cast("string"), F.lit("m"))
    return table(spark, sf_dir, "orders").select("o_orderkey", d.alias("duration"), fn.minutes(d).alias("minutes"), fn.number_word(q).alias("word"))


@query("SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, replace(replace(c_name || '/' || c_mktsegment || ':', '/', '-'), ':', '-') AS safe FROM customer")
def h24_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", fn.slug(F.col("c_name")).alias("slug"), fn.safe_name(F.concat("c_name", F.lit("/"), "c_mktsegment", F.lit(":"))).alias("safe"))
