"""Numbered lines of text files, read in parallel splits.

A scan cuts large files into splits; a line's number is known only relative to
its split.  Two passes give the exact number: the first counts the lines of each
split (``_metadata.file_block_start`` tells the splits of a file apart), prefix
sums over a file's splits turn the counts into offsets, and the second adds
them.  Within a split the number follows from ``monotonically_increasing_id``,
which counts a task's rows in reading order; the first id of each split comes
from the same first pass.  So no file is ever sorted or gathered in one task:
the only window runs over one row per split, and that table, as small as the
scan's own list of splits, is broadcast.

Both passes must cut the files into the same splits: they are planned alike, by
the same session, over the file list that is fixed when the reader is called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def _scan(spark: SparkSession, path: str, pattern: str, line_sep: str | None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_name"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_mid"))


def number_lines(spark: SparkSession, path: str, pattern: str = "*.txt", line_sep: str | None = None,
                 whole_file: str = "_name") -> DataFrame:
    """S1 with order: ``file, line_no (from 0), text`` of every line of every matching file.

    ``line_sep``: default any of \\n, \\r\\n, \\r.  ``whole_file``: SQL expression
    over ``_path`` and ``_name`` that names the file a part belongs to, for files
    stored as several parts, which follow each other as Spark numbers them (shorter
    paths first, then by path; default: every file by itself, by its base name).  Empty files give no lines."""
    scan = _scan(spark, path, pattern, line_sep).withColumn("file", F.expr(whole_file))
    splits = cut_lineage(scan.groupBy("file", "_path", "_start").agg(
        F.count(F.lit(1)).alias("_lines"), F.min("_mid").alias("_first")))
    before = Window.partitionBy("file").orderBy(F.length("_path"), "_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_path", "_start", "_first", F.coalesce(F.sum("_lines").over(before), F.lit(0)).alias("_off"))
    out = scan.join(F.broadcast(offsets), ["_path", "_start"])  # one row per split of the scan
    return out.select("file", (F.col("_off") + F.col("_mid") - F.col("_first")).cast("bigint").alias("line_no"), "text")


def corpus_of_files(spark: SparkSession, path: str, pattern: str = "*.txt", line_sep: str | None = None,
                    whole_file: str = "_name") -> DataFrame:
    """Numbered lines as a corpus: ``(doc_id, line_no, file, text)`` with the line's
    number in its file as ``doc_id``, the key that ordered operators use (P1
    samples per chunk, P7 chunk numbers, S9 chunk counts)."""
    lines = number_lines(spark, path, pattern, line_sep, whole_file)
    return lines.select(F.col("line_no").alias("doc_id"), F.lit(0).alias("line_no"), "file", "text")


def single_column(spark: SparkSession, path: str, pattern: str = "*", line_sep: str | None = None) -> DataFrame:
    """S3 with order: ``file, row_no (from 0), text`` of one-column files whose
    first line is a header, which each file's first split drops by its number."""
    lines = number_lines(spark, path, pattern, line_sep)
    return lines.filter(F.col("line_no") > 0).select("file", (F.col("line_no") - 1).alias("row_no"), "text")


def write_lines(lines: DataFrame, path: str, order: list[str], file: str = "file") -> None:
    """Text files, one folder ``<file>=...`` per file, in parts that follow each
    other by name in the stated order.  A large file is several range partitions."""
    ranged = lines.repartitionByRange(file, *order).sortWithinPartitions(file, *order)
    ranged.select(file, "text").write.mode("overwrite").partitionBy(file).text(path)
