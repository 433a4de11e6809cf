"""A cleaning pipeline over ``documents``: each stage works on what the one before kept.

Quality classifier, exact dedup, near dedup, redaction of personal data, packing.
Every stage is written as Parquet and read again before the next one; what it
read and the tables it wrote for itself are deleted then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusgrams.llm import exact_dedup, nbsvm, packing, pii, probminhash
from corpusgrams.llm.common import delete_table, documents, freed_tables, labels, write_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return nbsvm.keep_good(docs, nbsvm.fit(docs, labels(spark, sf_dir)))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (white space apart) stays."""
    return exact_dedup.keep_first_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return probminhash.keep_one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: The stages hold a trained classifier and a near-duplicate search, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what the stages keep of ``documents``."""
    docs, read = documents(spark, sf_dir), None
    for _, stage in STAGES[:-1]:
        with freed_tables(spark):
            kept = stage(spark, docs, sf_dir)
            written = write_table(kept)
        if read is not None:
            delete_table(spark, read)
        docs, read = spark.read.schema(kept.schema).parquet(written), written
    return STAGES[-1][1](spark, docs, sf_dir)
