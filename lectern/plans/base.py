"""The tables as the operators know them, and the register of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import sittings_key

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query by its function's name; sql may use UNITS, the WITH list that unit rows come from."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql.replace("UNITS0", UNITS.split("),\nt AS")[0].replace("u AS", "u0 AS", 1) + ")").replace("UNITS", UNITS)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task joins and groups at most, about.
TASK_ROWS = 500_000


def tasks_for(rows: DataFrame, n: int) -> int | None:
    """Over how many tasks n rows are dealt; null where the session's own number of partitions is enough."""
    tasks = -(-n // TASK_ROWS)
    return tasks if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def spread(rows: DataFrame, n: int, key: str) -> DataFrame:
    """rows dealt by key over as many tasks as n of them need, so what a task holds doesn't grow with the table; as they are where the session's own number of partitions is enough."""
    tasks = tasks_for(rows, n)
    return rows.repartition(tasks, key) if tasks else rows


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as unit rows: an order is a paper, a line number a question, the quantity its marks, type and brand of the part and the line's flags its tags. Orders come last, so that units lie by paper and grouping by paper needs no shuffle."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    n = lines.count()
    typed = spread(lines, n, "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    j = spread(typed, n, "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    s = sittings_key(F.col("o_orderdate"))
    return j.select(
        F.col("l_orderkey").alias("paper"),
        F.col("l_linenumber").alias("q"),
        F.col("l_quantity").cast("long").alias("marks"),
        s["year"].alias("year"),
        s["season"].alias("season"),
        F.array_distinct(F.array(F.concat_ws(".", "p_type", "p_brand"), F.concat(F.lit("FLAG "), F.concat_ws(".", "l_returnflag", "l_linestatus")))).alias("tags"),
        F.substring("o_orderpriority", 3, 100).alias("command"),
    )


UNITS = """u AS (SELECT l_orderkey AS paper, l_linenumber AS q, CAST(l_quantity AS BIGINT) AS marks, CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN month(o_orderdate) <= 4 THEN 0 WHEN month(o_orderdate) <= 8 THEN 1 ELSE 2 END AS season,
  list_distinct([p_type || '.' || p_brand, 'FLAG ' || l_returnflag || '.' || l_linestatus]) AS tags, substr(o_orderpriority, 3) AS command
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
t AS (SELECT paper, q, marks, year, season, command, tags, unnest(tags) AS sub FROM u),
x AS (SELECT *, split_part(sub, '.', 1) AS topic FROM t)"""
