"""Hand-worked rows for rules that no row of the test tables hits."""

import pytest
from pyspark.sql import functions as F

from corpusgrams.functions import text as T
from corpusgrams.operators import clean as C
from corpusgrams.operators import tokenize as tk


def texts(spark, *rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, text string")


def kept(df):
    return [r.text for r in df.orderBy("id").collect()]


def test_clean_text_v1_drops_junk_and_the_first_o_slash(spark):
    assert kept(C.clean_text_v1(texts(spark, "aøbø", "12", "12 !!", "rt", "x class=a"))) == ["abø", "12 !!"]


def test_numeric_prefix(spark):
    assert kept(C.strip_numeric_prefix(texts(spark, "12.5_abc", "__", "1a", "x 12"))) == ["abc", "1a", "x 12"]


def test_clean_files(spark):
    got = kept(C.clean_files(texts(spark, "a\x00b é9\x1a\x01", "__bos__ hi __eos__", "x__unk__y\x7f")))
    assert got == ["a b ", "hi", "xy"]


def test_source_name(spark):
    df = texts(spark, "en_US.blogs.txt", "src1")
    assert [r[0] for r in df.orderBy("id").select(T.source_name(F.col("text"))).collect()] == ["blogs", "src1"]


def test_tweets_lose_their_links(spark):
    df = texts(spark, "See https://a.b/c #Tag @me www.x.y ok!")
    assert df.select(tk.tweet_text(F.col("text"))).first()[0] == "See #Tag @me ok"


@pytest.mark.parametrize("pattern, gone, stays", [
    (T.NGRAM_STOP_PATTERN, "rt rt rt", "rt rt"),
    (T.NGRAM_STOP_PATTERN, "amazon. x y", "an amazon x"),
    (T.BIGRAM_STOP_PATTERN, "lol rt", "lol it"),
    (T.BIGRAM_STOP_PATTERN, "1 2", "1 a"),
    (T.TRIGRAM_STOP_PATTERN, "1 2 3", "1 2 a"),
    (T.TRIGRAM_STOP_PATTERN, "NA NA NA", "NA NA x"),
    (T.TOP_TRIGRAM_STOP_PATTERN, "amazon b c", "omg omg omg"),
    (T.WORD_DIGIT_PATTERN, "a1", "ab"),
])
def test_ngram_patterns(spark, pattern, gone, stays):
    assert kept(C.drop_ngram_patterns(texts(spark, gone, stays), "text", pattern)) == [stays]


def test_last_words(spark):
    df = texts(spark, "a b", "a b c d", "")
    assert [r[0] for r in df.orderBy("id").select(tk.last_words(F.col("text"), 3)).collect()] == ["a b", "b c d", ""]


def test_treebank_splits(spark):
    words = ["don't", "can’t", "it's", "cannot", "gonna", "gotta", "wanna", "gimme", "lemme", "d'ye", "more'n", "'tis", "'twas", "na"]
    df = spark.createDataFrame([(words,)], "w array<string>")
    got = df.select(tk.ptb_split(F.col("w"))).first()[0]
    assert " ".join(got) == ("do n't ca n’t it 's can not gon na got ta wan na gim me lem me d 'ye more 'n 't is 't was na")
