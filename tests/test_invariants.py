"""Invariants of the corpus pipeline."""

from pyspark.sql import functions as F

from corpusgrams.operators import model as M
from corpusgrams.operators import ordinals as O
from corpusgrams.operators import ranking as W
from corpusgrams.operators import smoothing as K
from corpusgrams.operators import splits as P
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src


def test_unigram_sum_and_order_sums(spark, sf):
    lines = src.corpus_lines(spark, sf)
    toks = tk.corpus_tokens(lines)
    sizes = toks.select(F.size("tokens").alias("n"))
    counts = tk.ngram_counts(lines)
    per_order = {r.order: r.s for r in counts.groupBy("order").agg(F.sum("ngram_count").alias("s")).collect()}
    for n in range(1, 6):
        want = sizes.select(F.sum(F.greatest(F.col("n") - n + 1, F.lit(0)))).first()[0]
        assert per_order[n] == want


def test_mle_sums_to_one(spark, sf):
    counts = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 3)
    m = M.mle_next_word(counts)
    bad = m.groupBy("order", F.when(F.col("order") > 1, F.col("begins")).alias("p")).agg(
        F.sum("mle").alias("s")).filter(F.abs(F.col("s") - 1) > 1e-9)
    assert bad.count() == 0


def test_pgt2_sums_to_one(spark, sf):
    counts = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 3)
    s = K.good_turing(counts).groupBy("order").agg(F.sum("Pgt_2").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in s)


def test_split_is_a_partition(spark, sf):
    s = tk.sentences(src.corpus_lines(spark, sf))
    sp = P.stratified_split(s, "file", ["doc_id", "line_no", "sent_no"], 42, 0.75)
    assert sp.count() == s.count()
    assert sp.select("doc_id", "line_no", "sent_no").distinct().count() == s.count()
    per = sp.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("split") == "training").cast("int")).alias("t"))
    assert all(r.t == int(r.n * 0.75) for r in per.collect())


def test_pruned_subset_of_corpus(spark, sf):
    counts = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 3)
    pr = W.prune_continuations(counts, 3)
    assert pr.join(counts, ["order", "begins", "ends", "ngram_count"], "left_anti").count() == 0
    assert pr.groupBy("order", "begins").count().filter(F.col("count") > 3).count() == 0


def test_counts_unchanged_under_repartition(spark, sf):
    lines = src.corpus_lines(spark, sf)
    a = tk.ngram_counts(lines, 1, 3)
    b = tk.ngram_counts(lines.repartition(7, "text"), 1, 3)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ordinals_equal_row_number(spark, sf):
    from pyspark.sql import Window

    lines = src.corpus_lines(spark, sf)
    want = lines.withColumn("w", F.row_number().over(Window.partitionBy("file").orderBy("doc_id", "line_no")))
    got = P.line_ordinals(lines, ["file"])
    j = got.join(want, ["doc_id", "line_no"])
    assert j.filter(F.col("ordinal") != F.col("w")).count() == 0
    g = O.global_row_number(lines.select("doc_id", "line_no"), ["doc_id", "line_no"], "rid")
    wg = lines.select("doc_id", "line_no", F.row_number().over(Window.orderBy("doc_id", "line_no")).alias("w"))
    assert g.join(wg, ["doc_id", "line_no"]).filter(F.col("rid") != F.col("w")).count() == 0
