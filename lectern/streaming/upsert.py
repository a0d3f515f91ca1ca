"""Streams: later rows win, and shares that are refreshed as rows come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("l")).select(key, "l.*")


def upsert_stream(stream: DataFrame, key: str, order: list[str], home: str, checkpoint: str) -> StreamingQuery:
    """Keeps the latest row of each key as Parquet under home/v=<batch>. A batch reads the version before it and writes its own, so one that is run again gives the same result. Runs until the input is used up."""

    def merge(batch: DataFrame, n: int) -> None:
        spark: SparkSession = batch.sparkSession
        whole = last_wins(batch, key, order)
        if n:
            whole = last_wins(spark.read.parquet(f"{home}/v={n - 1}").select(*batch.columns).unionByName(batch), key, order)
        whole.select(*batch.columns).write.mode("overwrite").parquet(f"{home}/v={n}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str, by: str, *, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, by, n in windows of event time; rows later than the watermark are left out."""
    w = F.window(at, width)
    return stream.withWatermark(at, late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")
