"""Operators over ordered rows: carried values, as-of joins, islands, intervals, running sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.operators.graphs import cut


def dealt(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """rows over ranges of (by, order), with __range, each row's range. Rows of one place are in one range, and a group with a third of all rows lies in as many as it fills. Ranges are drawn from a look at the rows and then used more than once,
    so they are cut off."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(n, *by, *order).withColumn("__range", F.spark_partition_id()))


def running(ranges: DataFrame, by: list[str], order: list[str], value: Column, how: str, out: str, *, own: bool = True) -> DataFrame:
    """ranges (see dealt) with out: of a value's rows so far in its group, with the row itself if own, the sum, the max or the last one that isn't null; null before there is any.

    Each range is gone through by itself; what its group has before it comes from one row for each group and range. So no group needs a task of its own."""
    v = ranges.withColumn("__v", value).withColumn("__g", F.struct(*by, "__range"))
    local = Window.partitionBy("__g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    whole = {"sum": F.sum("__v"), "max": F.max("__v"), "last": F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order)))}[how]
    fold = lambda c: F.last(c, ignorenulls=True) if how == "last" else getattr(F, how)(c)
    ends = v.groupBy("__g").agg(whole.alias("__whole")).select("__g", F.struct(*(F.col(f"__g.{c}") for c in by)).alias("__b"), "__whole")
    ends = ends.select("__g", fold("__whole").over(Window.partitionBy("__b").orderBy("__g.__range").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    near = fold("__v").over(local)
    both = {"sum": F.coalesce(F.col("__near") + F.col("__before"), "__near", "__before"), "max": F.greatest("__near", "__before"), "last": F.coalesce("__near", "__before")}[how]
    return v.withColumn("__near", near).join(ends, "__g").withColumn(out, both).drop("__v", "__g", "__near", "__before")


def carried(rows: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last value that isn't null, up to each row of its group."""
    return running(dealt(rows, by, order), by, order, F.col(value), "last", out).drop("__range")


def as_of(rows: DataFrame, facts: DataFrame, by: list[str], at: str, value: str, out: str) -> DataFrame:
    """rows with the value of the latest fact of their group at or before them (facts: by, at, value; equal times: the largest value). Rows and facts are merged and the value carried, so nothing is paired."""
    f = facts.groupBy(*by, at).agg(F.max(value).alias(out))
    marked = f.select(*by, at, out, F.lit(0).alias("__side"), *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c not in (*by, at)))
    both = marked.unionByName(rows.withColumns({out: F.lit(None).cast(dict(f.dtypes)[out]), "__side": F.lit(1)})).withColumnRenamed(out, "__fact")
    return carried(both, by, [at, "__side"], "__fact", out).where("__side = 1").drop("__side", "__fact")


def islands(rows: DataFrame, by: list[str], position: str) -> DataFrame:
    """by, first, last, n: runs of positions that follow each other without a gap. Repeated positions count once."""
    d = rows.select(*by, position).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(position))
    g = d.withColumn("__run", F.col(position) - rank)
    return g.groupBy(*by, "__run").agg(F.min(position).alias("first"), F.max(position).alias("last"), F.count(F.lit(1)).alias("n")).drop("__run")


def merged_intervals(rows: DataFrame, by: list[str], lo: str, hi: str, gap: float = 0) -> DataFrame:
    """by, lo, hi, n: intervals that overlap, or lie at most gap apart, as one."""
    r = running(dealt(rows.select(*by, lo, hi), by, [lo, hi]), by, [lo, hi], F.col(hi), "max", "__reach", own=False)
    fresh = F.when(F.col(lo) <= F.col("__reach") + F.lit(gap), 0).otherwise(1)
    g = running(r.withColumn("__new", fresh), by, [lo, hi], F.col("__new"), "sum", "__run")
    return g.groupBy(*by, "__run").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count(F.lit(1)).alias("n")).drop("__run")


def gaps_between(bands: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """by, gap_lo, gap_hi, cut (the middle): what no interval covers between the first and the last of a group. bands are merged already."""
    w = Window.partitionBy(*by).orderBy(lo)
    g = bands.select(*by, F.col(hi).alias("gap_lo"), F.lead(lo).over(w).alias("gap_hi")).where("gap_hi is not null")
    return g.withColumn("cut", (F.col("gap_lo") + F.col("gap_hi")) / 2)


def adjacent(rows: DataFrame, by: list[str], order: list[str], value: str, out: str = "next") -> DataFrame:
    """Each row with the value of the one after it in its group, or null."""
    return rows.withColumn(out, F.lead(value).over(Window.partitionBy(*by).orderBy(*order)))


def running_set(rows: DataFrame, by: list[str], order: list[str], values: str, out: str) -> DataFrame:
    """Each row with the distinct values of its array column so far in its group, sorted; rows of one place see each other's. Every row stays, equal ones too.

    Only where a value is first seen does a set grow: the places of first sight are found, a set is put together for each, and rows look up the last one. So sets are as many as distinct values, not as rows."""
    at = F.struct(*order)
    first = rows.select(*by, at.alias("__at"), F.explode(values).alias("__v")).groupBy(*by, "__v").agg(F.min("__at").alias("__at"))
    new = first.groupBy(*by, "__at").agg(F.collect_set("__v").alias("__new"))
    grown = new.select(*by, "__at", F.array_sort(F.flatten(F.collect_list("__new").over(Window.partitionBy(*by).orderBy("__at")))).alias("__seen"))
    seen = as_of(rows.withColumn("__at", at), grown, by, "__at", "__seen", out).drop("__at")
    return seen.withColumn(out, F.coalesce(out, F.array().cast(dict(grown.dtypes)["__seen"])))


def outermost(intervals: DataFrame, by: list[str], lo: str, hi: str) -> DataFrame:
    """by, lo, hi: the distinct intervals of a group that lie in no other one. One pass over each group by lower end, the longer first: an interval lies in another if an end before reached as far."""
    w = Window.partitionBy(*by).orderBy(lo, F.desc(hi)).rowsBetween(Window.unboundedPreceding, -1)
    d = intervals.select(*by, lo, hi).distinct().withColumn("__reach", F.max(hi).over(w))
    return d.where(F.col("__reach").isNull() | (F.col("__reach") < F.col(hi))).drop("__reach")


def ranked(rows: DataFrame, by: list[str], order: list[Column], n: int, out: str = "rank") -> DataFrame:
    """The first n rows of each group in an order."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= n)


def falling_run(rows: DataFrame, by: str, year: str, value: str) -> DataFrame:
    """by, peak_year, peak, fell_until: the newest year of a group's highest yearly mean and the last year of the strict fall that follows it."""
    y = rows.groupBy(by, year).agg(F.avg(value).alias("v"))
    top = y.groupBy(by).agg(F.max(F.struct("v", year)).alias("t")).select(by, F.col("t.v").alias("peak"), F.col(f"t.{year}").alias("peak_year"))
    w = Window.partitionBy(by).orderBy(year)
    after = y.withColumn("before", F.lag("v").over(w)).join(top, by).where(F.col(year) > F.col("peak_year"))
    stop = after.where(~(F.col("v") < F.col("before"))).groupBy(by).agg(F.min(year).alias("stop"))
    ok = after.join(stop, by, "left").where(F.col("stop").isNull() | (F.col(year) < F.col("stop"))).groupBy(by).agg(F.max(year).alias("fell_until"))
    return top.join(ok, by, "left").select(by, "peak_year", "peak", F.coalesce("fell_until", "peak_year").alias("fell_until"))


def running_total(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """rows with running, the sum of a value so far in its group, and pct, that of the group's whole. order tells all rows of a group apart, or rows of one place are summed in any order."""
    r = running(dealt(rows, by, order), by, order, F.col(value), "sum", "running").withColumn("__b", F.struct(*by))
    whole = rows.groupBy(F.struct(*by).alias("__b")).agg(F.sum(value).alias("__whole"))
    return r.join(whole, "__b").withColumn("pct", 100.0 * F.col("running") / F.col("__whole")).select(*rows.columns, "running", "pct")
