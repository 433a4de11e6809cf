"""Text-file readers and chunk writers on files derived from the test tables."""

from pyspark.sql import functions as F

from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src
from corpusgrams.sources import store


def test_read_text_files(spark, sf, tmp_dir):
    lines = src.corpus_lines(spark, sf).filter(~F.col("text").contains("\r"))
    lines.select("text").write.mode("overwrite").text(f"{tmp_dir}/txt")
    got = src.read_text_files(spark, f"{tmp_dir}/txt", "*.txt")
    assert got.count() == lines.count()
    assert got.select("text").exceptAll(lines.select("text")).count() == 0
    assert got.filter(~F.col("file").endswith(".txt")).count() == 0


def test_read_single_column(spark, sf, tmp_dir):
    docs = src.table(spark, sf, "documents").select("source").distinct()
    path = f"{tmp_dir}/one"
    docs.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    got = src.read_single_column(spark, path)
    assert got.columns == ["text"]
    assert sorted(r.text for r in got.collect()) == sorted(r.source for r in docs.collect())


def test_chunk_counts_and_open_dataset(spark, sf, tmp_dir):
    g = tk.line_ngrams(src.corpus_lines(spark, sf), 2, keep=("doc_id",))
    c = g.withColumn("bucket", F.col("doc_id") % 3).groupBy("bucket", "ngram").count()
    store.write_chunk_counts(c, f"{tmp_dir}/chunks")
    back = store.open_dataset(spark, f"{tmp_dir}/chunks")
    assert back.count() == c.count()
    assert {r.bucket for r in back.select("bucket").distinct().collect()} == {0, 1, 2}
