"""The corpus pipeline: documents without toxic, poor and doubled ones, packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelift.llm import jaccard, packing, quality, toxicity
from pricelift.llm.common import scratch, ship, table
from pricelift.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject, learned from the labels of the corpus."""
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    ship(spark)
    return jaccard.drop_near_duplicates(docs, size=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in sequences of 1024 tokens."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Viterbi decoding, components and packing are not expressible; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
