"""Ranks within groups when many rows are equal: equal tuples are kept once with their number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.common import stored

#: Positions that one exploded array holds at most; a tuple with more equal rows is restored in several.
STRETCH = 1 << 16
#: A column and whether its larger values come first. Nulls always come last.
Order = list[tuple[str, bool]]


def ordering(keys: Order) -> list[Column]:
    return [F.desc_nulls_last(c) if larger else F.asc_nulls_last(c) for c, larger in keys]


def ranged(tuples: DataFrame, order: list[Column]) -> DataFrame:
    """tuples dealt over ranges of their order, with __range, the number of each's range. As the ranges are used twice and must not be drawn anew, they are written to the shared folder."""
    n = int(tuples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(tuples.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()))


def ranked(rows: DataFrame, group: list[str], tie: Order, then: Order, max_place: int | None = None) -> DataFrame:
    """A row for each row: the columns of group, tie and then, pos (from 1, within its group, by tie and then), place (the same) and tied (how many rows of its group have its values of tie).

    With max_place only rows of at most that place are given; they are counted and placed against all rows all the same. Other columns of rows are left out. Nulls in group are values of their own; in tie and then they come
    last and equal each other. Repeated rows follow each other, each with a pos of its own. No rows give none.

    Equal rows become one tuple with a count, so the first shuffle carries a group's copies once. Tuples are dealt by ranges of (group, order), so a group with a third of all rows lies in as many tasks as it fills. A running
    sum of counts within each range, on top of the sum of the group's ranges before (one number per group and range), is the first pos of a tuple; a sequence from there restores its copies. With max_place, only a range's first so many tuples of each group are
    shuffled for that: those behind them cannot stand at such a place.
    """
    ties, rest = [c for c, _ in tie], [c for c, _ in then]
    order = ordering([*tie, *then])
    counted = rows.groupBy(*group, *ties, *rest).agg(F.count(F.lit(1)).alias("__n"))
    tuples = ranged(counted, [F.asc_nulls_first(c) for c in group] + order)
    tuples = tuples.select(F.struct(*group).alias("__group"), F.struct(*ties).alias("__tie"), *ties, *rest, "__range", "__n")  # a struct equals another with nulls in the same fields
    parts = tuples.groupBy("__group", "__range").agg(F.sum("__n").alias("__c"))
    before = F.sum("__c").over(Window.partitionBy("__group").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("__group", "__range", F.coalesce(before, F.lit(0)).alias("__ahead"))
    own = Window.partitionBy("__group", "__range").orderBy(*order)
    near = tuples
    if max_place is not None:  # a tuple stands behind all tuples before it, each of a row at least
        near = near.withColumn("__nth", F.row_number().over(own)).where(F.col("__nth") <= max_place).drop("__nth")
    near = near.withColumn("__near", F.coalesce(F.sum("__n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = near.join(parts, ["__group", "__range"]).withColumn("__first", F.col("__ahead") + F.col("__near") + 1)
    last = F.col("__first") + F.col("__n") - 1
    if max_place is not None:
        placed, last = placed.where(F.col("__first") <= max_place), F.least(last, F.lit(max_place))
    placed = placed.withColumn("__last", last)
    alike = tuples.groupBy("__group", "__tie").agg(F.sum("__n").alias("tied"))
    placed = placed.join(alike, ["__group", "__tie"])
    out = placed.select("__group", *ties, *rest, "tied", "__last", F.explode(F.sequence("__first", "__last", F.lit(STRETCH).cast("long"))).alias("__at"))
    out = out.select("__group.*", *ties, *rest, "tied", F.explode(F.sequence("__at", F.least(F.col("__at") + STRETCH - 1, F.col("__last")))).alias("pos"))
    return out.withColumn("place", F.col("pos"))


def scaled(value: Column, by: int) -> Column:
    """floor(by * value + 0.5) as a long; null for null and NaN."""
    return F.floor(by * F.nanvl(value.cast("double"), F.lit(None).cast("double")) + 0.5).cast("long")


def vendor_groups(sale_lines: DataFrame) -> DataFrame:
    """Sale lines as rows to rank: vendor_id, part (item_id mod 5) and month are the group (-1 for a null part or month; all three -1 for sales whose number's crc32 is divisible by 5), tens the tens of the quantity, percent the discount."""
    one = F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    whole = lambda c: F.when(one, F.lit(-1)).otherwise(c).cast("long")
    month = F.coalesce(100 * F.year("shipped_at") + F.month("shipped_at"), F.lit(-1))
    return sale_lines.select(
        whole(F.col("vendor_id")).alias("vendor_id"),
        whole(F.coalesce(F.col("item_id") % 5, F.lit(-1))).alias("part"),
        whole(month).alias("month"),
        F.floor(F.col("quantity") / 10).cast("long").alias("tens"),
        scaled(F.col("discount"), 100).alias("percent"),
        F.col("sale_id").cast("long").alias("sale_id"),
        F.col("line_no").cast("long").alias("line_no"),
        F.col("quantity").cast("long").alias("quantity"),
        scaled(F.col("amount"), 100).alias("amount_cents"),
    )


def first_lines(sale_lines: DataFrame, max_place: int = 2) -> DataFrame:
    """The lines of at most max_place in each group of vendor_groups: larger tens first, then smaller percent, then sale_id, line_no, quantity and amount_cents. Null or broken numbers come last."""
    then = [(c, False) for c in ("sale_id", "line_no", "quantity", "amount_cents")]
    return ranked(vendor_groups(sale_lines), ["vendor_id", "part", "month"], [("tens", True), ("percent", False)], then, max_place)
