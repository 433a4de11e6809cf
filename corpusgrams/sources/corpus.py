"""Corpus sources: tables of lines, text files, phrase tables.

A corpus is a DataFrame of lines ``(doc_id, line_no, file, lang, text)``.  Line
order inside a file is ``(doc_id, line_no)``; every order-dependent operator
uses that key explicitly.  All readers are narrow (scan + explode): no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the test data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPREAD_CONF = "corpusgrams.input.partitions"


def spread(df: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """Hash-repartition an input of few splits (one file, one row group) into
    ``partitions`` by ``keys``; None leaves the scan's own splits, as is right
    for any large input."""
    return df.repartition(partitions, *keys) if partitions else df


def spread_setting(spark: SparkSession) -> int | None:
    """``corpusgrams.input.partitions`` of the session, None where it is unset."""
    value = spark.conf.get(SPREAD_CONF, None)
    return int(value) if value else None


def document_lines(docs: DataFrame, lang: str | None = None, partitions: int | None = None) -> DataFrame:
    """Split ``documents.text`` on newlines: one row per line.

    ``source`` plays the role of the file name; ``lang`` restricts the corpus
    to one language (pushed to the scan as a parquet filter).  ``partitions``:
    see ``spread``.
    """
    if lang is not None:
        docs = docs.filter(F.col("lang") == lang)
    lines = docs.select(
        "doc_id",
        F.col("source").alias("file"),
        "lang",
        F.posexplode(F.split("text", "\n")).alias("line_no", "text"),
    )
    return spread(lines, partitions, "doc_id", "line_no")


def corpus_lines(spark: SparkSession, sf_dir: str, lang: str | None = None) -> DataFrame:
    return document_lines(table(spark, sf_dir, "documents"), lang, spread_setting(spark))


def page_lines(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Raw html pages as lines; the page url stands for the file."""
    lines = pages.select(
        F.col("page_id").alias("doc_id"),
        F.col("url").alias("file"),
        F.posexplode(F.split("html", "\n")).alias("line_no", "text"),
    )
    return spread(lines, partitions, "doc_id", "line_no")


def read_text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``get_clean_files``: every line of every matching file, plus its base name.

    One row per line, no quoting, no header.  ``line_no`` is not available from
    a plain text scan, so the byte position is not kept; order-dependent
    operators should use a table source with an explicit key.
    """
    return (
        spark.read.option("pathGlobFilter", pattern)
        .text(path)
        .select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("file"))
    )


def read_single_column(spark: SparkSession, path: str) -> DataFrame:
    """``load_all_of_it``: a one-column text file with a header line."""
    return (
        spark.read.option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .csv(path)
        .toDF("text")
    )


def user_phrases(conversations: DataFrame) -> DataFrame:
    """User turns as the phrase table, keyed by ``(conv_id, turn)``."""
    return conversations.filter(F.col("role") == "user").select(
        "conv_id", "turn", "text"
    )


def evaluation_texts(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id"), F.col("text"))
