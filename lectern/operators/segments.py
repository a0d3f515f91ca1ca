"""Segmentation of texts into questions, parts, blocks and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.operators.graphs import cut


def accepted_starts(numbers: Column) -> Column:
    """Of an array of numbers (nulls: no number) the places, from 0, that begin a question: the first must be 1, each later one the number before plus one. A fold, since it depends on what was accepted."""
    start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("at"), F.array().cast("array<int>").alias("places"))

    def step(s: Column, n: Column) -> Column:
        ok = F.coalesce(n == s["last"] + 1, F.lit(False))
        return F.struct(F.when(ok, n).otherwise(s["last"]).alias("last"), (s["at"] + 1).alias("at"), F.when(ok, F.concat(s["places"], F.array(s["at"]))).otherwise(s["places"]).alias("places"))

    return F.aggregate(numbers, start, step)["places"]


def line_table(rows: DataFrame, ident: str, text: str) -> DataFrame:
    """ident, pos (from 0), line."""
    return rows.select(ident, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("pos", "line"))


def marked_blocks(lines: DataFrame, ident: str, marker: Column) -> DataFrame:
    """ident, block, first, n, body: a block ends at each marker line; what follows the last is a block of its own."""
    w = Window.partitionBy(ident).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    b = lines.withColumn("block", F.coalesce(F.sum(marker.cast("int")).over(w), F.lit(0)).cast("long"))
    g = b.groupBy(ident, "block").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("l"))
    return g.select(ident, "block", "first", "n", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("body"))


def heading_sections(lines: DataFrame, ident: str, heading: Column) -> DataFrame:
    """ident, section (from 1), title, n, chars: lines under each heading; what stands before the first is left out."""
    w = Window.partitionBy(ident).orderBy("pos")
    s = lines.withColumn("h", heading).withColumn("section", F.sum(F.col("h").cast("int")).over(w)).where("section > 0")
    return s.groupBy(ident, "section").agg(F.min_by("line", "pos").alias("title"), F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars"))


def batches(rows: DataFrame, by: list[str], order: list[str], ident: str, size: int = 80) -> DataFrame:
    """by, batch (from 0), ids: sorted rows in batches of a fixed size.

    Rows are numbered along one order over all groups, range by range, so a group with a third of all rows needs no task of its own. The sorted rows are cut off, as their ranges must not be drawn twice."""
    cols = [*by, *order]
    r = cut(rows.select(*dict.fromkeys([*cols, ident])).repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("__m", F.monotonically_increasing_id()))
    r = r.withColumn("__range", F.shiftright("__m", 33))
    parts = r.groupBy(*by, "__range").agg(F.min("__m").alias("__low"), F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*by, "__range", (F.coalesce(before, F.lit(0)) - F.col("__low")).alias("__shift"))
    b = r.join(parts, [*by, "__range"]).withColumn("__n", F.col("__m") + F.col("__shift")).withColumn("batch", F.floor(F.col("__n") / size).cast("long"))
    return b.groupBy(*by, "batch").agg(F.array_sort(F.collect_list(F.struct("__n", F.col(ident).alias("__id")))).alias("x")).select(*by, "batch", F.transform("x", lambda s: s["__id"]).alias("ids"))
