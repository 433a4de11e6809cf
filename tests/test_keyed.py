"""The stored model keyed by context: no exchange of the model, pruned buckets, same answers."""

import pytest

from corpusgrams.operators import model as M
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src
from corpusgrams.sources import keyed as K

KEY = ["conv_id", "turn", "sentence_id"]


@pytest.fixture(scope="module")
def counts(spark, sf):
    c = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 3).cache()
    yield c
    c.unpersist()


@pytest.fixture(scope="module")
def model(spark, counts):
    return K.store_in_shared_folder(counts, 8)


@pytest.fixture(scope="module")
def grams(spark, sf):
    return tk.user_input_grams(src.user_phrases(src.table(spark, sf, "conversations")), ("conv_id", "turn"), 5).cache()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(text, needle):
    """The plan's lines from ``needle`` up to the top: its chain of parents (less indented lines)."""
    lines = text.split("\n")
    at = next(i for i, x in enumerate(lines) if needle in x)
    depth, chain = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for x in reversed(lines[:at]):
        d = len(x) - len(x.lstrip(" :+-"))
        if d < depth:
            chain.append(x)
            depth = d
    return chain


def test_the_store_holds_the_model(spark, counts, model):
    back = model.select("order", "begins", "ends", "ngram_count")
    assert back.exceptAll(counts).count() == 0 and back.count() == counts.count()
    assert {r.context for r in model.filter("order = 1").select("context").distinct().collect()} == {""}


def test_a_join_on_the_context_moves_only_the_phrases(spark, model, grams):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = K.context_grams(grams, KEY).select("context").distinct()
        text = plan(model.join(asked, "context", "left_semi"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    parents = below(text, "Bucketed: true")
    assert parents and not any("Exchange" in x for x in parents[:parents.index(next(x for x in parents if "SortMergeJoin" in x))])


def test_top_k_of_each_context_needs_no_exchange(spark, model):
    from corpusgrams.operators import ranking as W
    from pyspark.sql import functions as F

    assert "Exchange" not in plan(W.top_k(model, ["context"], [F.col("ngram_count").desc(), F.col("ends")], 3))


def test_literal_contexts_read_their_buckets_only(spark, model, capsys):
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # else the plan does not name the buckets
    spark.conf.set(key, "false")
    try:
        df = K.rows_of_contexts(model, ["the"])
        df.explain("formatted")
    finally:
        spark.conf.unset(key)
    assert "SelectedBucketsCount: 1 out of 8" in capsys.readouterr().out
    want = model.select("context", "order", "begins", "ends", "ngram_count").filter("concat(context, '') = 'the'")
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_next_words_are_those_of_the_backoff(spark, counts, model, grams):
    want = M.next_word_backoff(grams, counts, KEY, k=4, longest_only=True)
    got = K.stored_next_words(grams, model, KEY, 4)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 0


def test_store_replaces_and_takes_empty_models(spark, counts, tmp_dir):
    name = "model_of_the_test"
    K.store_keyed(counts.limit(5), name, 2, f"{tmp_dir}/m")
    assert K.store_keyed(counts.limit(0), name, 2, f"{tmp_dir}/m").count() == 0
    assert K.open_keyed(spark, name).columns == K.STORED
    spark.sql(f"DROP TABLE {name}")


def test_a_model_of_each_order_is_stored_where_it_was_counted(spark, sf, counts, grams):
    lines = src.corpus_lines(spark, sf)
    led = K.store_in_shared_folder(tk.model_by_order(lines, 3), 8)
    assert led.columns == K.LED
    assert sorted(map(tuple, led.select("order", "begins", "ends", "ngram_count").collect())) == sorted(map(tuple, counts.collect()))
    assert led.selectExpr("context", "lead").distinct().groupBy("context").count().filter("count > 1").count() == 0
    want = M.next_word_backoff(grams, counts, KEY, k=4, longest_only=True)
    got = K.stored_next_words(grams, led, KEY, 4)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one = K.rows_of_contexts(led, ["the", "__bos__ the"])
    assert one.count() == counts.filter("order > 1 and begins in ('the', '__bos__ the')").count() > 0
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from corpusgrams.operators import ranking as W
        from pyspark.sql import functions as F

        assert "Exchange" not in plan(W.top_k(led, ["lead", "context"], [F.col("ngram_count").desc(), F.col("ends")], 3))
        text = plan(K.stored_next_words(grams, led, KEY, 4))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    for at in (i for i, x in enumerate(text.split("\n")) if "Bucketed: true" in x):  # the rank is taken in the buckets
        parents = below("\n".join(text.split("\n")[:at + 1]), "Bucketed: true")
        first = next((i for i, x in enumerate(parents) if "Exchange" in x), len(parents))
        assert any("Window" in x for x in parents[:first])


def test_the_query_deals_only_order_two_out_again(spark, sf):
    from corpusgrams.plans import all_queries

    text = all_queries()["stored_next_words"](spark, sf)._jdf.queryExecution().analyzed().toString()
    read = [x for x in text.split("\n") if "Relation spark_catalog" in x and "model_" in x]
    assert read and all("[lead#" in x for x in read)
