"""Counting below a bitmap of the asked n-grams: same results, fewer rows."""

from pyspark.sql import functions as F

from corpusgrams.operators import model as M
from corpusgrams.operators import prefilter as PF
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src

ORDERS = [1, 2, 3, 4, 5]


def lines_of(spark, texts):
    return spark.createDataFrame([(i, 0, "f", t) for i, t in enumerate(texts)],
                                 "doc_id long, line_no int, file string, text string")


def grams(spark, rows):
    return spark.createDataFrame(rows, "order int, begins string, ends string")


ASKED = [(2, "a", "b"), (3, "a b", "c"), (1, "c", "c"), (4, "x y z", "w"), (2, "not", "there")]
TEXTS = ["a b c a b", "c a b d. a b", "x y z w q", "z z z"]


def rows(df):
    return sorted(tuple(r) for r in df.select("order", "begins", "ends", "ngram_count").collect())


def plain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_asked_row_is_counted_in_full(spark):
    lines, asked = lines_of(spark, TEXTS), grams(spark, ASKED)
    full = tk.ngram_counts(lines)
    for join, part in (
        (["order", "begins", "ends"], PF.counts_for_grams(lines, asked, ORDERS)),
        (["order", "begins"], PF.counts_of_contexts(lines, asked, ORDERS)),
    ):
        assert rows(part.join(asked, join, "left_semi")) == rows(full.join(asked, join, "left_semi"))
        assert set(rows(part)) <= set(rows(full)) and part.count() < full.count()
    assert rows(M.full_matches(PF.counts_for_matches(lines, asked, [2, 3, 4, 5]), asked)) == rows(M.full_matches(full, asked))
    both = PF.counts_for_matches(lines, asked, ORDERS, prefixes=True)
    assert rows(M.prefix_counts(both, asked)) == rows(M.prefix_counts(full, asked))
    strings = spark.createDataFrame([("a b",), ("z",), (None,)], "s string")
    assert {(r.begins, r.ends, r.ngram_count) for r in PF.counts_of_strings(lines, strings, [1, 2]).collect()} == {
        ("a", "b", 4), ("z", "z", 4)}


def test_a_full_bitmap_only_costs_rows(spark):
    """64 bits for hundreds of keys: nearly everything passes, the joined result stays."""
    lines = lines_of(spark, [f"w{i} w{i + 1} w{i * 7 % 90}" for i in range(90)])
    full = tk.ngram_counts(lines, 1, 2)
    keys = full.select("order", "begins", "ends").filter("ngram_count > 1")
    bits = PF.asked_bits(keys, 64)
    part = PF.counted_where(lines, [PF.may_be_asked(bits, F.col("order"), F.col("begins"), F.col("ends"), bits=64)], [1, 2])
    assert rows(part.join(keys, keys.columns, "left_semi")) == rows(full.join(keys, keys.columns, "left_semi"))


def test_nothing_asked_nothing_counted(spark):
    lines, none = lines_of(spark, TEXTS), grams(spark, [])
    assert PF.counts_for_grams(lines, none, ORDERS).count() == 0
    assert PF.counts_of_contexts(lines, none, ORDERS).count() == 0


def test_the_bitmap_has_one_size(spark):
    for n in (0, 1, 5000):
        words = PF.asked_bits(spark.range(n), 4096).first().words
        assert len(words) == 64
        assert sum(bin(w & (2**64 - 1)).count("1") for w in words) <= n
    for k in (0, 63, 64, 4095):
        at = spark.range(200_000).select("id", F.pmod(F.xxhash64("id"), F.lit(4096)).alias("at")).filter(F.col("at") == k).first()
        words = PF.asked_bits(spark.range(at.id, at.id + 1), 4096).first().words
        assert [(i, w & (2**64 - 1)) for i, w in enumerate(words) if w] == [(k // 64, 1 << (k % 64))]


def test_counted_rows_follow_the_phrases_not_the_corpus(spark, sf):
    lines = src.corpus_lines(spark, sf).select("doc_id", "line_no", "file", "text")
    asked = tk.evaluation_grams(src.evaluation_texts(src.table(spark, sf, "benchmark")), ("item_id",), 5)
    # the same corpus, and three times as much text of other words
    other = lines.withColumn("text", F.regexp_replace("text", r"(\p{L}+)", "zq$1"))
    more = lines.unionByName(other).unionByName(other).unionByName(other)
    small, large = (PF.counts_for_grams(x, asked, ORDERS) for x in (lines, more))
    n_small, n_large = small.count(), large.count()
    model = tk.ngram_counts(lines).count()
    assert n_small < 0.1 * model
    # markers and false positives only: nothing like four times the rows
    assert n_large < 1.5 * n_small  # the corpus has twice the distinct n-grams: more false positives only


def test_occurrences_go_before_the_aggregate(spark):
    plan = plain(PF.counts_for_grams(lines_of(spark, TEXTS), grams(spark, ASKED), ORDERS))
    assert plan.index("Exchange") < plan.index("getbit") if "getbit" in plan else plan.index("Exchange") < plan.index("bit_get")
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_bitmap_of_many_keys_stays_mostly_unset(spark):
    """Half a megabyte is too little for millions of asked contexts: nearly every n-gram would pass."""
    assert [PF.bits_for(n) for n in (0, 1, 1 << 18)] == [PF.BITS] * 3
    assert PF.bits_for((1 << 18) + 1) == 1 << 23 and PF.bits_for(10**9) == PF.MOST_BITS
    n = 1_000_000
    bits = PF.bits_for(n)
    keys = spark.range(n).selectExpr("cast(id as string) as k")
    bitmap = PF.asked_bits(keys, bits)
    others = spark.range(n, n + 100_000).selectExpr("cast(id as string) as k")
    assert keys.filter(~PF.may_be_asked(bitmap, keys["k"], bits=bits)).count() == 0
    assert others.filter(PF.may_be_asked(bitmap, others["k"], bits=bits)).count() < 10_000


def test_many_asked_strings_and_contexts_let_few_others_through(spark):
    lines = lines_of(spark, [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(50)])
    many = spark.range(600_000).selectExpr("concat('z', id) as s")
    asked = many.union(spark.createDataFrame([("w3x4 w3x5",), ("w0x0",), (None,)], "s string"))
    got = PF.counts_of_strings(lines, asked, [1, 2])
    assert got.count() < 600  # of 20,000; a bitmap of half a megabyte lets 2,700 through
    assert {("w3x4", "w3x5", 1), ("w0x0", "w0x0", 1)} <= {(r.begins, r.ends, r.ngram_count) for r in got.collect()}
    contexts = many.select(F.lit(2).alias("order"), F.col("s").alias("begins")).union(
        spark.createDataFrame([(2, "w3x4"), (2, None)], "order int, begins string"))
    got = PF.counts_of_contexts(lines, contexts, [2])
    assert got.count() < 100 and ("w3x4", "w3x5", 1) in {(r.begins, r.ends, r.ngram_count) for r in got.collect()}
