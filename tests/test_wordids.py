"""Ids of words that stay when the vocabulary grows."""

import pytest
from pyspark.sql import functions as F

from corpusgrams.operators import wordids as I


def words(spark, n, start=0):
    return spark.createDataFrame([(f"w{i}",) for i in range(start, n)], "word string")


def table(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({w for w, _ in rows}) == len({i for _, i in rows}) == len(rows)
    return dict(rows)


@pytest.mark.parametrize("bits", [60, 9])  # 9 bits: 512 ids, so that most words meet another
def test_ids_of_a_superset_keep_the_old_words(spark, bits):
    old = I.stable_word_ids(words(spark, 120), bits=bits).cache()
    new = table(I.stable_word_ids(words(spark, 200), old, bits=bits))
    assert len(new) == 200
    assert table(old).items() <= new.items()
    if bits == 60:  # without a meeting not even the old table is needed
        assert table(I.stable_word_ids(words(spark, 200))) == new


def test_forced_collisions_move_the_later_word(spark):
    df = words(spark, 60)
    got = table(I.stable_word_ids(df, bits=7))
    first = {r.word: r.i for r in df.select("word", I.proposed_id(F.col("word"), 0, 7).alias("i")).collect()}
    for w, i in first.items():
        rivals = sorted(v for v, j in first.items() if j == i)
        assert (got[w] == i) == (w == rivals[0])
    assert max(got.values()) < 128


def test_old_words_win_over_new_ones_of_one_hash(spark):
    first = {r.word: r.i for r in words(spark, 60).select("word", I.proposed_id(F.col("word"), 0, 7).alias("i")).collect()}
    w, v = next((w, v) for w in sorted(first) for v in sorted(first) if w < v and first[w] == first[v])
    one = lambda x: spark.createDataFrame([(x,)], "word string")
    known = I.stable_word_ids(one(v), bits=7)
    assert table(I.stable_word_ids(one(w), known, bits=7))[v] == first[v]


def test_nulls_repeats_and_nothing(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("",)], "word string")
    assert set(table(I.stable_word_ids(df))) == {"a", ""}
    assert I.stable_word_ids(df.limit(0)).count() == 0


def test_too_few_bits(spark):
    with pytest.raises(ValueError):
        I.stable_word_ids(words(spark, 3), bits=1)
