"""Sinks: partitioned JSON lines, rendered text, batches, split outputs, keyed patches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partitioned_json(df: DataFrame, path: str, by: str, order: list[str]) -> None:
    """JSON lines, one folder for each value of by, sorted. A value's rows are spread by size, not forced into one task."""
    df.repartitionByRange(by, *order).sortWithinPartitions(by, *order).write.mode("overwrite").partitionBy(by).json(path)


def rendered(df: DataFrame, path: str, by: list[str], line: Column) -> None:
    """A text line for each row in a folder for each group."""
    df.select(*by, line.alias("value")).write.mode("overwrite").partitionBy(*by).text(path)


def split_output(df: DataFrame, keep: Column, kept_path: str, other_path: str) -> None:
    """Rows that meet a condition to one place, the others (and those for which it is null) to another."""
    ok = F.coalesce(keep, F.lit(False))
    df.where(ok).write.mode("overwrite").parquet(kept_path)
    df.where(~ok).write.mode("overwrite").parquet(other_path)


def patched(df: DataFrame, patches: DataFrame, key: str, column: str) -> DataFrame:
    """df with patches (key, find, put) applied to a text column; a patch whose find isn't there changes nothing, so applying twice is as once if put doesn't hold find. One patch a key."""
    j = df.join(patches, key, "left")
    new = F.when(F.col("find").isNotNull(), F.replace(F.col(column), F.col("find"), F.col("put"))).otherwise(F.col(column))
    return j.withColumn(column, new).select(*df.columns)
