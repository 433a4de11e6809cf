"""Hand-worked cases (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from corpusgrams.functions import text as T
from corpusgrams.operators import clean as C
from corpusgrams.operators import model as M
from corpusgrams.operators import ranking as W
from corpusgrams.operators import smoothing as K
from corpusgrams.operators import tokenize as tk


def one_col(spark, values, name="text"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} string")


def test_line_filter(spark):
    cases = {"12 !!": True, "_": True, "__": True, "1.5_": True, "rt": True, "RT": False, "lol": True,
             "a class=b": True, "—": True, "½": True, "ééé": False, "Ⅳ": False, "٣٤": False, "": False}
    df = one_col(spark, list(cases))
    got = dict(df.select("text", T.is_junk_line(F.col("text")).alias("j")).collect())
    assert got == cases
    kept = {r.text for r in C.clean_text(df).collect()}
    assert kept == {k for k, v in cases.items() if not v}


def test_basic_clean(spark):
    cases = {"a(b)c-d=e 12:34;5/6.7! ok?": "abcde ! ok?", "é1 __x__": "é x", "cómo — 3": "cómo — "}
    df = one_col(spark, list(cases))
    got = dict(df.select("text", T.basic_clean(F.col("text"))).collect())
    assert got == cases


def test_tokens(spark):
    s = "Don't stop. It's 3.5 U.S.A. ok! e-mail me __bos__ a:b don’t #tag @me"
    got = one_col(spark, [s]).select(T.words(F.col("text"))).first()[0]
    assert got == ["don't", "stop", "it's", "3.5", "u.s.a", "ok", "e", "mail", "me", "__bos__",
                   "a", "b", "don’t", "tag", "me"]


def test_sentences_and_markers(spark):
    df = spark.createDataFrame([(1, 0, "f", "Hello there. How are you? fine.,ok")], "doc_id long, line_no int, file string, text string")
    rows = tk.corpus_tokens(df).orderBy("sent_no").collect()
    assert [r.tokens for r in rows] == [
        ["__bos__", "hello", "there", "__eos__"],
        ["__bos__", "how", "are", "you", "__eos__"],
        ["__bos__", "fine", "ok", "__eos__"],
    ]


def test_suffix_grams(spark):
    df = one_col(spark, ["How are  You", "hi"])
    rows = tk.phrase_suffix_grams(df, ("id",), 2).collect()
    got = sorted((r.id, r.order, r.begins, r.ends) for r in rows)
    assert got == [(0, 1, "you", "you"), (0, 2, "are", "you"), (1, 1, "hi", "hi")]


def _counts(spark):
    data = [("a", 1), ("b", 1), ("c", 1), ("d", 2), ("e", 2), ("f", 4)]
    return spark.createDataFrame([(2, "x", w, n) for w, n in data], "order int, begins string, ends string, ngram_count long")


def test_good_turing_tables(spark):
    c = _counts(spark)
    lead = {r.r: (r.n_r, r.n_r_plus_one, r.r_star) for r in K.good_turing_lead(c).collect()}
    assert lead[1][:2] == (3, 2) and math.isclose(lead[1][2], 4 / 3)
    assert lead[2][:2] == (2, 1) and math.isclose(lead[2][2], 1.5)
    assert lead[4][:2] == (1, 0) and lead[4][2] == 0
    gap = {r.r: (r.Nr, r.Nrp1) for r in K.nr_table(c).collect()}
    assert gap == {1: (3, 2), 2: (2, 0), 4: (1, 0)}
    gt = {r.ngram: r for r in K.good_turing(c, 5).collect()}
    assert math.isclose(gt["x a"].Pgt, 0.1212121212, rel_tol=1e-9)
    assert math.isclose(gt["x a"].Pgt_2, 1 / 3)
    assert gt["x d"].Pgt == 0 and gt["x f"].Pgt_2 == 0
    cs5 = {r.ngram: r.c_star for r in K.c_star(c, 5).collect()}
    assert math.isclose(cs5["x a"], 4 / 3) and cs5["x d"] == 0 and cs5["x f"] == 0
    cs3 = {r.ngram: r.c_star for r in K.c_star(c, 3).collect()}
    assert abs(cs3["x a"]) < 1e-12 and math.isclose(cs3["x d"], 8) and cs3["x f"] == 4


@pytest.mark.parametrize(
    "k,d,ck,pk",
    [
        (1, [0, 1.75, 4], [0, 3.5, 16], [0, 0.1794871795, 0.8205128205]),
        (2, [None, None, None], [None, None, None], [None, None, None]),
        (4, [4 / 3, 0.75, 0], [4 / 3, 1.5, 0], [0.4705882353, 0.5294117647, 0]),
    ],
)
def test_katz_dr(spark, k, d, ck, pk):
    rows = sorted(K.katz_dr(K.good_turing_lead(_counts(spark)), k).collect(), key=lambda r: r.r)
    for row, dv, cv, pv in zip(rows, d, ck, pk):
        for got, want in ((row.d_r, dv), (row.C_katz, cv), (row.P_katz, pv)):
            if want is None:
                assert got is None
            else:
                assert abs(got - want) < 1e-9


def test_perplexity(spark):
    df = spark.createDataFrame([(1, math.log(0.5)), (1, math.log(0.25))], "t int, odds double")
    p = M.perplexity(df, ["t"]).first().perplexity
    assert abs(p - 2.8284271247) < 1e-9


def test_top_k_ties(spark):
    df = spark.createDataFrame([("p", "x", 5), ("p", "y", 5), ("p", "z", 3)], "begins string, ends string, n int")
    with_ties = W.top_k(df, ["begins"], [F.col("n").desc()], 1, ties=True)
    assert sorted(r.ends for r in with_ties.collect()) == ["x", "y"]
    no_ties = W.top_k(df, ["begins"], [F.col("n").desc(), F.col("ends")], 1)
    assert [r.ends for r in no_ties.collect()] == ["x"]


def test_prefix_counts(spark):
    corpus = spark.createDataFrame(
        [(2, "a", "b", 3), (2, "a", "c", 1), (3, "a b", "d", 2)], "order int, begins string, ends string, ngram_count long"
    )
    grams = spark.createDataFrame([(3, "a b", "d")], "order int, begins string, ends string")
    assert M.begin_counts(corpus, grams).filter(F.col("order") == 3).count() == 0
    pc = M.prefix_counts(corpus, grams).collect()
    assert [(r.order, r.begins, r.ends, r.prefix_count) for r in pc] == [(3, "a b", "d", 3)]
    mle = {(r.order, r.ends): r.mle for r in M.mle_next_word(corpus).collect()}
    assert mle[(2, "b")] == 0.75


def test_stop_words_match_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert T.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
