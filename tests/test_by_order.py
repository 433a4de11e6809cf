"""The model as one table for each order: ranked, summed and numbered where its rows lie."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusgrams.operators import model as M
from corpusgrams.operators import ranking as W
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src

# words that are beginnings of others, marks inside words, letters beyond ASCII, a marker as a word, a repeated row
TEXTS = ["a b a b a b ab a", "a.b a b c", "a'b a b c. A b c d e", "é a é ab", "ab a b c d e f", "", None, "__eos__ a b", "b", "ab"]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, "f", "en", t) for i, t in enumerate(TEXTS)] + [(0, "f", "en", TEXTS[0])]
    return src.document_lines(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string"))


@pytest.fixture(scope="module")
def counts(lines):
    return tk.ngram_counts(lines).cache()


def rows(df):
    return sorted(map(repr, df.collect()))


def exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].count("Exchange")


def test_numbers_follow_begins_and_ends(lines, counts):
    got = M.numbered(tk.model_by_order(lines, in_ranges=True))
    want = counts.withColumn("ngram_id", F.row_number().over(Window.orderBy("order", "begins", "ends")).cast("bigint"))
    assert rows(got.select(*want.columns)) == rows(want)
    assert rows(M.load_corpus(got)) == rows(M.load_corpus(counts).select(*M.load_corpus(got).columns))


def test_numbering_moves_windows_only(lines):
    """From order 2 on the rows are put in order where the windows were dealt to."""
    three = tk.model_by_order(lines, in_ranges=True)[3]
    assert exchanges(three.sortWithinPartitions("begins", "ends")) == 1
    assert "rangepartitioning(substring_index(window" in three._jdf.queryExecution().executedPlan().toString()


def test_prune_and_mle_equal_the_whole_table(lines, counts):
    parts = tk.model_by_order(lines)
    for k in (1, 2):
        got = W.prune_by_order(parts, k)
        assert rows(got) == rows(W.prune_continuations(counts, k).select(*got.columns))
    assert rows(M.mle_by_order(parts)) == rows(M.mle_next_word(counts))
    assert rows(M.capped_by_order(parts, 3)) == rows(M.cap_per_order(counts, 3))


def test_a_prefix_is_ranked_and_summed_without_a_shuffle(lines):
    three = {3: tk.model_by_order(lines)[3]}
    assert exchanges(W.prune_by_order(three, 2)) == 1
    assert exchanges(M.mle_by_order(three)) == 1


def test_only_single_words_move_to_their_ids(spark):
    ids = spark.createDataFrame([(1, 1, "a", "a", 2), (2, 2, "b", "a", 1), (3, 3, "a b", "a", 1), (4, 2, None, "a", 1)],
                                "ngram_id long, order int, begins string, ends string, ngram_count long")
    got = M.recode_begins(ids, spark.createDataFrame([("a", 7)], "ngram string, wid long"))
    assert sorted((r.ngram_id, r.begins_wid) for r in got.collect()) == [(1, 7), (2, None), (3, None), (4, None)]
    assert "contains(begins" in got._jdf.queryExecution().executedPlan().toString().lower()
