"""Totals of a few groups are written out first: no row moves to its group's task."""

import pytest

from corpusgrams.operators import counts as A
from corpusgrams.operators import tokenize as tk
from corpusgrams.plans import all_queries
from corpusgrams.session import stored
from pyspark.sql import functions as F


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def dealt_by(text):
    return [x.split("hashpartitioning(")[1].split(")")[0] for x in text.split("== Initial Plan")[0].split("\n")
            if "Exchange hashpartitioning(" in x]


@pytest.mark.parametrize("name", ["bigram_freq", "top20_bigrams_filtered", "top20_trigrams"])
def test_counts_do_not_move_to_their_source(spark, sf, name):
    by = dealt_by(plan(all_queries()[name](spark, sf)))
    assert sum("gram#" in x for x in by) >= 1
    if name == "bigram_freq":  # the others rank within a source, twenty rows a task
        assert all("gram#" in x for x in by)


@pytest.mark.parametrize("name", ["tf_idf_bigram", "tf_idf_trigram"])
def test_tf_idf_deals_rows_out_once(spark, sf, name):
    by = dealt_by(plan(all_queries()[name](spark, sf)))
    assert len({x.split("#")[0] for x in by}) == 1 and not any(x.startswith("from") for x in by)


def test_frequencies_and_tf_idf_by_hand(spark):
    df = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", None), ("t", "a"), ("t", "b"), (None, "b")], "g string, w string")
    got = {(r.g, r.w): (r.w_count, r.total_w) for r in A.calc_frequency(df, "w", ["g"]).collect()}
    assert got == {("s", "a"): (2, 3), ("s", None): (1, 3), ("t", "a"): (1, 2), ("t", "b"): (1, 2)}
    c = A.count_by(df, ["g", "w"], "n")
    known = df.dropna()
    rows = lambda t: sorted((r.g, r.w, r.n, round(r.tf, 9), round(r.idf, 9)) for r in t.collect())
    want = [("s", "a", 2, 1.0, 0.0), ("t", "a", 1, 0.5, 0.0), ("t", "b", 1, 0.5, round(0.69314718056, 9))]
    assert rows(A.tf_idf(c, "w", "g", "n")) == want
    assert rows(A.tf_idf(c, "w", "g", "n", A.group_totals(known, ["g"], "_doc_total"))) == want


def test_chunk_counts_are_not_combined_before_they_are_dealt_out(spark, sf):
    text = plan(all_queries()["chunk_fivegram_counts"](spark, sf))
    assert "REPARTITION_BY_COL" in text and text.index("HashAggregate") < text.index("REPARTITION_BY_COL")


def test_endcounted_writes_words_only(spark, sf):
    files = all_queries()["endcounted_fivegram"](spark, sf).inputFiles()
    tables = {f.rsplit("/", 1)[0] for f in files if "table-" in f}
    assert len(tables) == 1 and spark.read.parquet(tables.pop()).filter("order <> 1").count() == 0


def test_contractions_are_split_where_the_search_finds_them(spark):
    words = ["don't", "can’t", "cannot", "d'ye", "gimme", "lemme", "gonna", "wanna", "gotta", "more'n", "'tis", "’twas", "plain", "cannots", "it's"]
    got = [r.t for r in spark.createDataFrame([([w, "x"],) for w in words] + [([],)], "t array<string>").select(
        tk.ptb_split(F.col("t")).alias("t")).collect()]
    parts = [["do", "n't"], ["ca", "n’t"], ["can", "not"], ["d", "'ye"], ["gim", "me"], ["lem", "me"], ["gon", "na"], ["wan", "na"],
             ["got", "ta"], ["more", "'n"], ["'t", "is"], ["’t", "was"], ["plain"], ["cannots"], ["it", "'s"]]
    assert got == [p + ["x"] for p in parts] + [[""]]
    assert tk.PTB_MAY_SPLIT.split("|", 1)[1] in tk.ptb_split(F.col("t"))._jc.toString()


def test_chunks_of_an_ngram_are_counted_in_one_exchange(spark, sf):
    by = dealt_by(plan(all_queries()["ngrams_upto"](spark, sf)))
    assert len([x for x in by if "begins#" in x]) == 1 and not any("chunk" in x for x in by)


def test_ngrams_of_frequent_words_do_not_move_for_their_positions(spark, monkeypatch):
    from corpusgrams.operators import counts as A
    from corpusgrams.operators import relabel

    some = [("a b a", 3), ("a b c", 1), ("b b a", 2), (None, 4), ("c x y", 1), ("a b a", 3)]
    df = spark.createDataFrame(some, "ngram string, n long")
    want = None
    for slots in (1, 1 << 10):  # nearly all words in the joins, none there
        monkeypatch.setattr(relabel, "SLOTS", slots)
        got = sorted((tuple(r) for r in A.positional_counts(df, "ngram", 3).collect()), key=str)
        assert len(got) == len(some) and (want is None or got == want)
        want = got
    assert ("a", "b", "b", "b b a", 2, 1, 4, 3) in want and ("y", "x", "c", "c x y", 1, 1, 1, 1) in want
    text = A.positional_counts(df, "ngram", 3)._jdf.queryExecution().optimizedPlan().toString()
    branches = text.split("\n:- ")[1].split("\n+- ")  # the n-grams held as a whole, and the others
    assert text.startswith("Union") and "Join" not in branches[0] and branches[1].count("Join LeftOuter") == 3
