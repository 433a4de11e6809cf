"""The model from windows that are shuffled once."""

import os

import pytest
from pyspark.sql import functions as F

from corpusgrams.operators import tokenize as tk
from corpusgrams.session import ensure_checkpoint_dir, stored
from corpusgrams.sources import corpus as src

TEXTS = ["A b a b a. B", "a b a b a", "", None, "x", "__bos__ a", "a b a b a\nx"]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, "f", "en", t) for i, t in enumerate(TEXTS)] + [(1, "f", "en", TEXTS[1])]  # a repeated row
    return src.document_lines(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string"))


@pytest.mark.parametrize("only", [[1, 2, 3, 4, 5], [1, 5], [3], [4, 5], [1], [2]])
def test_equals_counting_every_ngram(lines, only):
    got = tk.ngram_counts(lines, min(only), max(only), only)
    each = tk.explode_ngrams(tk.corpus_tokens(lines, keep=()), "tokens", 1, 5).filter(F.col("order").isin(only))
    want = tk.count_ngrams(each)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_row_a_token_is_shuffled(spark, lines):
    """The orders above 1 need no exchange beyond that of the windows, and all read the same one."""
    c = tk.ngram_counts(lines)
    c.filter("begins IS NOT NULL AND ngram_count > 1").collect()
    plan = c._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 5 and plan.count("Exchange") == 6  # five readers, and the sum of order 1
    tokens = tk.corpus_tokens(lines, keep=()).agg(F.sum(F.size("tokens"))).first()[0]
    assert tk.token_windows(tk.corpus_tokens(lines, keep=()), 1, 5).count() == tokens
    done = c.groupBy("order").count()
    done.collect()
    assert "ReusedExchange" in done._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_are_compressed_in_the_shared_folder(spark):
    df = spark.range(200_000).select((F.col("id") * 0).cast("string").alias("same words in every row"))
    back = stored(df)
    assert back.count() == 200_000 and back.dtypes == df.dtypes
    folder = back.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert folder.startswith(ensure_checkpoint_dir(spark).replace("file:", ""))
    assert sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)) < 200_000  # a row's checkpoint takes more than 16 bytes


def test_get_model_shuffles_windows_only(spark, sf):
    from corpusgrams.plans import all_queries

    got = all_queries()["get_model"](spark, sf)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ngram" not in plan and "REPARTITION_BY_COL" in plan
    one = got.agg(F.count(F.lit(1)), F.countDistinct("ngram"), F.min("total_ngrams"), F.max("total_ngrams")).first()
    toks = tk.corpus_tokens(src.corpus_lines(spark, sf), keep=())
    assert one[0] == one[1] and one[2] == one[3] == toks.agg(F.sum(F.size("tokens"))).first()[0]


def test_the_stored_model_is_that_of_the_windows(lines):
    for n in (1, 2, 3, 5):
        got, want = tk.stored_counts(lines, n), tk.ngram_counts(lines, 1, n)
        assert got.dtypes == want.dtypes
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0
    assert tk.stored_counts(lines.limit(0)).count() == 0


def test_queries_that_read_the_model_twice_write_windows(spark, sf):
    """A row a different window, not a row an n-gram, and no shuffle of orders 2 and up to read it again."""
    from corpusgrams.plans.stats_queries import counts

    model = counts(spark, sf)
    written = spark.read.parquet(*model.inputFiles())
    assert written.columns == ["pair", "window", "n"] and written.count() < 0.5 * model.count()
    text = model._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1  # that of single words
