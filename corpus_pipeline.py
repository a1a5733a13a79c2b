"""From documents to packed sequences: five corpus operators, one after another, and every corpus query by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.llm import language, mixing, packing, pii, simhash
from snapstar.llm.common import documents
from snapstar.llm.queries import ORACLES, QUERIES
from snapstar.session import remove, scratch, workspace


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without a letter, null texts among them, go.

    The model learns from the rows that aren't held out. Repeated rows and all columns stay.
    """
    model = language.fit(docs.filter(~language.held_out()))
    found = language.predict(docs.select(F.struct("*").alias("_row"), "text"), model)
    return found.filter(F.col("lang_pred") != language.UNKNOWN).select("_row.*")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the operator's shingle and distance; null texts are one group.

    Of repeated rows one stays; all columns are kept.
    """
    return simhash.deduplicate(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the kind in place of each piece of personal data; null texts, repeated rows and all columns stay."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; null sources are one source.

    Texts without words, null ones too, come with whole epochs only. Repeated rows count each on their own; all columns stay.
    """
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences; a null text is an empty document."""
    return packing.digest(spark, docs)


STAGES = [("language", identify), ("near-duplicates", deduplicate), ("personal data", redact), ("mixing", mix), ("packing", pack)]
#: SQL can neither fit the classifiers nor encode tokens; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again.

    What a stage stores for itself goes as it ends, and its rows once the next
    stage has read them, also if that one fails: of unredacted texts no table is
    left. What the last stage reads is there as long as its result is.
    """
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name.replace(" ", "-"))
        try:
            with workspace(spark):
                found = stage(spark, docs, sf_dir)
                found.write.parquet(path)
        finally:
            if before:
                remove(spark, before)
        docs, before = spark.read.schema(found.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_ORACLES = {**ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
