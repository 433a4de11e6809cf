"""Joins that must survive a hot key, and next-word results worked out by hand."""

from pyspark.sql import functions as F

from corpusgrams.operators import counts as A
from corpusgrams.operators import model as M

MODEL = [(1, "a", "a", 4), (1, "b", "b", 3), (2, "a", "b", 3), (2, "a", "c", 1), (3, "a b", "d", 2), (3, "a b", "e", 2)]


def model(spark):
    return spark.createDataFrame(MODEL, "order int, begins string, ends string, ngram_count long")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_are_joined_as_plain_shuffles(spark):
    """No aggregate directly below the join: adaptive execution can split a hot prefix."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(M.mle_next_word(model(spark).filter("order > 1")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin"):plan.index("CartesianProduct") if "CartesianProduct" in plan else None]
    assert "keys=[order" not in join


def test_mle(spark):
    got = {(r.order, r.begins, r.ends): r.mle for r in M.mle_next_word(model(spark)).collect()}
    assert got[2, "a", "b"] == 0.75 and got[3, "a b", "d"] == 0.5 and got[1, "a", "a"] == 4 / 7


def test_next_options_keep_to_their_order(spark):
    grams = spark.createDataFrame([(1, 1, "b", "b"), (1, 2, "a", "b"), (1, 3, "a b", "x")], "id int, order int, begins string, ends string")
    got = {(r.order, r.begins, r.ends) for r in M.next_options(grams, model(spark), ["id"], 1).collect()}
    assert got == {(2, "a", "b"), (3, "a b", "d"), (3, "a b", "e")}  # ties stay, no order-1 row


def test_full_matches_leave_order_one_out(spark):
    grams = spark.createDataFrame([(1, "a", "a"), (2, "a", "b")], "order int, begins string, ends string")
    assert [(r.order, r.ends) for r in M.full_matches(model(spark), grams).collect()] == [(2, "b")]


def test_backoff_returns_all_orders_and_options_cut(spark):
    grams = spark.createDataFrame([(7, 1, "b", "b"), (7, 2, "a", "b"), (7, 1, "a", "a")], "id int, order int, begins string, ends string")
    all_of = M.next_word_backoff(grams, model(spark), ["id"]).orderBy("rank").collect()
    assert [(r.order, r.ends, r["rank"]) for r in all_of] == [(3, "d", 1), (3, "e", 2), (2, "b", 3), (2, "c", 4)]
    few = M.next_word_backoff(grams, model(spark), ["id"], k=1, longest_only=True).collect()
    assert [(r.order, r.ends) for r in few] == [(3, "d")]


def test_continuations_sum_before_they_spread(spark):
    grams = spark.createDataFrame([(7, 2, "a", "x"), (7, 2, "a", "y")], "id int, order int, begins string, ends string")
    got = {(r.ends, r.prefix_count) for r in M.eval_continuations(grams, model(spark), ["id"]).collect()}
    assert got == {("b", 8), ("c", 8)}


def test_source_against_others_and_histogram(spark):
    t = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a"), ("y", "a"), ("z", "c")], "s string, w string")
    got = {(r.w, r.base, r.origin, r.proportion) for r in A.source_against_others(t, "s", "w", "x").collect()}
    assert got == {("a", 0.5, "y", 1.0), ("c", None, "z", 1.0)}
    c = spark.createDataFrame([("x", 1), ("x", 1), ("x", 8)], "s string, n long")
    assert {(r.bin, r.n_words) for r in A.frequency_histogram(c, "s", "n", 4).collect()} == {(0, 2), (3, 1)}
    assert A.frequency_histogram(c, "s", "n", 4, top=0.2).agg(F.sum("n_words")).first()[0] == 2
