"""Matches of phrases ranked through their contexts; keys repeated or null."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusgrams.operators import model as M
from corpusgrams.operators import ranking as W

COUNTS = [(2, "a", "x", 3), (2, "a", "y", 3), (2, "a", "z", 1), (3, "b a", "x", 1), (3, "b a", "y", 2), (2, "c", "x", 5)]
GRAMS = [(1, 1, "a", "a"), (1, 2, "b", "a"), (2, 1, "c", "c"), (None, 1, "a", "a"), (3, 1, "a", "a"), (3, 1, "a", "a"),
         (3, 2, "b", "a"), (4, 1, "q", "q"), (5, 2, "a", "x"), (5, 2, "c", "x"), (None, 2, "a", "y")]


def tables(spark):
    return (spark.createDataFrame(GRAMS, "k long, order int, begins string, ends string"),
            spark.createDataFrame(COUNTS, "order int, begins string, ends string, ngram_count long"))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_rank_through_contexts(spark):
    g, c = tables(spark)
    w = Window.partitionBy("k").orderBy(F.desc("order"), F.desc("ngram_count"), "ends")
    want = M.next_matches(g, c, ["k"], literal=False).withColumn("rank", F.row_number().over(w))
    got = M.next_word_backoff(g, c, ["k"])
    assert rows(got) == rows(want) and got.dtypes == want.dtypes


def test_options_of_a_phrase_through_the_last_place(spark):
    g, c = tables(spark)
    ctx = g.filter("order >= 2").select("k", "order", "begins").distinct()
    for n in (1, 2, 3, 4, 9):
        want = W.top_k(ctx.join(c, ["order", "begins"]), ["k", "order"], [F.col("ngram_count").desc()], n, ties=True)
        got = M.next_options(g, c, ["k"], n)
        assert rows(got) == rows(want.select(*got.columns))
