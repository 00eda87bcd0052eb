"""Registered queries over the corpus tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pricelift.llm import ann, bpe, factorisation, html_text, jaccard, licenses, merkle, packing, periodic, quality, sharding, toxicity, warc
from pricelift.llm.common import scratch, ship, table
from pricelift.llm.sql import LICENSE_SQL, MERKLE_SQL, QUALITY_SQL, SHARDING_SQL, WARC_SQL


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch(spark, "archives"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return merkle.manifest_digests(table(spark, sf_dir, "documents"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return factorisation.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = periodic.find_runs(table(spark, sf_dir, "documents"), edit=periodic.planted_tail)
    return periodic.run_digests(found)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_ann": op2_ann,
        "op3_license_scan": op3_license_scan,
        "op4_jaccard": op4_jaccard,
        "op5_html_text": op5_html_text,
        "op6_packing": op6_packing,
        "op7_warc": op7_warc,
        "op8_bpe": op8_bpe,
        "op9_quality": op9_quality,
        "op10_sharding": op10_sharding,
        "op11_merkle": op11_merkle,
        "op12_quality_classifier": op12_quality_classifier,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_license_scan": LICENSE_SQL, "op7_warc": WARC_SQL, "op9_quality": QUALITY_SQL, "op10_sharding": SHARDING_SQL, "op11_merkle": MERKLE_SQL}
