"""Corpus pipeline: from raw documents to tokens, a stage at a time.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, line_dedup, mil, pfair, simhash
from lectern.llm.common import free_name, shared_folder, small_batches, table
from lectern.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (a score under mil.CUT) go. It learns from the labels of documents that aren't held out.

    Null and empty texts are scored as one empty passage; rows with null ids are scored like others; repeated rows fare alike. Without labels every score is 0.5 and all stay. No rows give none.
    """
    small_batches(spark)
    model = mil.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return docs.withColumn(score, mil.score(F.col("text"), model)).where(F.col(score) >= mil.CUT).select(*docs.columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document has are cut from the later texts; n_chars follows, and is as it was where the text is null. Every row stays; rows with null ids stay as they are. No rows give none."""
    small_batches(spark)
    size = F.char_length("text").cast("long")
    return line_dedup.cleaned(docs).withColumn("n_chars", F.coalesce(size, F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the smallest id; null, empty and blank texts are one group. Rows with null ids all stay. Unlike texts under one id are judged apart; equal rows are one. No rows give none.

    Shingle width and radius are those of the query of this operator (three words, two bits).
    """
    small_batches(spark)
    return simhash.keep_one_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order in which Pfair scheduling mixes the sources; tickets are the whole square roots of the sources' sizes. A null source is one of its own. No rows give none."""
    return pfair.in_mixed_order(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, place, n_tokens, ids and the text that they decode to, in the order of the mix.

    place is that order. A written table is read by file sizes, so the mix is worked out again here: the same rows give the same places. Null and empty texts have no tokens. Every row stays. No rows give none.
    """
    small_batches(spark)
    place = free_name(docs, "place")
    mixed = pfair.in_mixed_order(docs.select("doc_id", "text", "lang", "source"), place_col=place)
    tokens = mixed.select("doc_id", "lang", "source", F.col(place).alias("place"), bpe.encoded(F.col("text"), bpe.check_file(vocabulary("word_bpe_49k.json"))).alias("t"))
    return tokens.select("doc_id", "lang", "source", "place", F.size("t.ids").cast("long").alias("n_tokens"), "t.ids", "t.decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", bpe_tokens),
]

#: The classifier, the alignment and XXH64 have no SQL; the tests hold each stage against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each result but the last is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    home = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{home}/{k}")
            docs = spark.read.parquet(f"{home}/{k}")
    return docs
