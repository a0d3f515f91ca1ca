"""What several training-data operators share: names, batches, durable cuts of lineage, components."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder and all of Spark runs on this machine, as in tests.
LOCAL_CHECKPOINT_DIR = "/tmp/checkpoints/lectern"
#: Rows, and bytes, of an Arrow batch that holds whole texts.
TEXT_BATCH_ROWS, TEXT_BATCH_BYTES = 512, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents")


def small_batches(spark: SparkSession) -> None:
    """Texts can be long: fewer of them in an Arrow batch bound a Python worker's memory. The queries and stages set this for their session, as a plan reads it only when it runs; the operators leave the session alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BATCH_BYTES))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of df has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    name, n = f"__{stem}", 0
    while name.lower() in taken:
        n += 1
        name = f"__{stem}_{n}"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines of the cluster share, as spark.checkpoint.dir names it. Where it is unset, a fixed one in local mode; on a cluster a folder of one machine would lose rows, so that is an error."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return LOCAL_CHECKPOINT_DIR


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the folder that all executors share."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder: for many rows of which columns compress well, a fraction of a checkpoint's size. It stays until the folder is cleared."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def edge_mark(edges: DataFrame) -> tuple:
    """A digest of a set of edges that doesn't depend on their order."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count(F.lit(1)), F.sum(h)).first()
    return tuple(row)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node that each node of an undirected edge list reaches.

    Alternates the large-star and small-star steps until the edges stay as they are. Each step keeps at most as many edges as it was given, and takes
    a minimum per node with partial aggregation, so a node with very many edges needs no task of its own; the joins back to the edges are plain sort-merge joins,
    which the adaptive planner can split. Edges with a null end are left out; loops give a component of one. No edges: no rows.
    """
    pairs = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a is not null and b is not null")
    current = durable(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = edge_mark(current)
    while mark[0]:
        both = current.where("u <> v").unionByName(current.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = durable(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        last, mark = mark, edge_mark(small)
        if mark == last:
            break
        current = small
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))


def ascii_words(text: Column) -> Column:
    """Runs of characters other than space and U+0009 to U+000D; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
