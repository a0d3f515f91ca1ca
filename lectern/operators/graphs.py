"""Connected components of an edge list."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Used only where the session names no shared folder and all of Spark runs on this machine, as in tests.
LOCAL_CHECKPOINT_DIR = "/tmp/checkpoints/lectern"


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder, so that a loop's plan doesn't grow and a lost executor costs no step. On a cluster spark.checkpoint.dir must name that folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(named or LOCAL_CHECKPOINT_DIR)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node that each node reaches.

    Every node has a label, itself at first. In a round it takes the least label of its neighbours, then the label of its label, until nothing changes; long chains halve in each round.
    """
    e = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull()).select(F.col(u).alias("a"), F.col(v).alias("b"))
    e = cut(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(e.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        near = e.join(labels, e.b == labels.node).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("m"))
        better = labels.join(near, labels.node == near.n).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = better.select(F.col("node").alias("k"), F.col("label").alias("far"))
        new = cut(better.join(jump, better.label == jump.k).select("node", "old", F.least("label", "far").alias("label")))
        moved = new.where("old <> label").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels.withColumnRenamed("label", "component")
