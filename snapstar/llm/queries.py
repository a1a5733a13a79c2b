"""Each corpus operator over the whole documents table, in the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.llm import divergence, fingerprints, language, lexical, licenses, mixing, outliers, packing, pii, secret_scan, simhash, suffixes, token_counts
from snapstar.llm.common import documents


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(documents(spark, sf_dir))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(spark, documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.digest(documents(spark, sf_dir))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(documents(spark, sf_dir))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(spark, documents(spark, sf_dir))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.digest(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_simhash,
        op3_language,
        op4_licenses,
        op5_packing,
        op6_mixing,
        op7_outliers,
        op8_pii,
        op9_suffixes,
        op10_token_counts,
        op11_lexical,
        op12_divergence,
        op13_secrets,
    )
}
ORACLES = {"op6_mixing": mixing.SQL, "op11_lexical": lexical.SQL, "op12_divergence": divergence.SQL}
