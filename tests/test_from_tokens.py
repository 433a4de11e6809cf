"""Model queries worked out from token arrays, without the model being written out and joined."""

import pytest
from pyspark.sql import functions as F

from corpusgrams.operators import smoothing as K
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src

TEXTS = ["A b a b a. B a b", "a b a b a", "", None, "x", "__bos__ a __eos__ b a", "a b a b a\nx", "c a b a. c a b d? c a b a b"]


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, "f", "en", t) for i, t in enumerate(TEXTS)] + [(1, "f", "en", TEXTS[1]), (None, None, None, TEXTS[0])]
    return src.document_lines(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string"))


def rows(df):
    return sorted((tuple(None if x is None else round(x, 8) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [1, 5])
def test_back_off_weights_of_windows_are_those_of_the_model(lines, k):
    got = K.katz_alpha_of_tokens(tk.corpus_tokens(lines, keep=()), k)
    want = K.katz_alpha(tk.ngram_counts(lines), k)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 0


def test_back_off_weights_move_windows_once(spark, sf):
    from corpusgrams.plans import all_queries

    text = plan(all_queries()["katz_alpha"](spark, sf))
    moved = [x.split("hashpartitioning(")[1] for x in text.split("\n") if "Exchange hashpartitioning(" in x]
    assert "REPARTITION_BY_COL" in text and not any("begins#" in x or "ends#" in x for x in moved)  # no join by words


def test_ids_are_looked_up_once_a_token(spark, sf, lines):
    from corpusgrams.operators import model as M
    from corpusgrams.operators import relabel
    from corpusgrams.plans import all_queries

    counts = tk.ngram_counts(lines)
    vocab = M.vocabulary(counts)
    got = relabel.encoded(relabel.id_windows(tk.corpus_tokens(lines, keep=()), vocab))
    want = M.encode_ngrams(counts, vocab)
    assert got.columns == want.columns and [t for _, t in got.dtypes] == [t for _, t in want.dtypes]
    assert rows(got) == rows(want) and got.count() > 0
    text = plan(all_queries()["encoded_model"](spark, sf))
    moved = [x.split("hashpartitioning(")[1] for x in text.split("\n") if "Exchange hashpartitioning(" in x]
    assert not any("begins#" in x or "ends#" in x or "gram#" in x for x in moved)


@pytest.mark.parametrize("prop", [0.0, 0.4, 0.8, 1.0])
def test_rare_words_go_before_ngrams_are_formed(spark, sf, lines, prop):
    from corpusgrams.operators import model as M
    from corpusgrams.operators import relabel
    from corpusgrams.plans import all_queries

    lines = lines.unionByName(lines.limit(1).withColumn("text", F.lit("__unk__ a zz zz q")))
    counts = tk.ngram_counts(lines)
    rare, _ = M.rare_words(counts, prop)
    tokens = relabel.trimmed(tk.corpus_tokens(lines, keep=()), rare)
    got = tk.count_windows(tk.token_windows(tokens, 1, 5), [1, 2, 3, 4, 5])
    assert rows(got) == rows(M.trim_unknown(counts, prop).select(*got.columns)) and got.count() > 0
    assert "array_contains(_ws" not in plan(all_queries()["trim_unk"](spark, sf))  # no model row is taken apart


def test_the_keyed_store_is_zstd(spark, lines):
    from corpusgrams.sources import keyed

    counts = tk.ngram_counts(lines)
    model = keyed.store_in_shared_folder(counts, 4)
    assert model.columns == keyed.STORED and all(".zstd." in f for f in model.inputFiles())
    assert rows(model.select(*counts.columns)) == rows(counts)


def test_words_of_positions_do_not_move_beside_their_ngram(spark):
    from corpusgrams.operators import counts as A

    df = spark.createDataFrame([("a b a", 3), ("a b c", 1), ("b b a", 2)], "ngram string, n long")
    got = A.positional_counts(df, "ngram", 3)
    assert got.columns == ["word3", "word2", "word1", "ngram", "n", "word1_count", "word2_count", "word3_count"]
    assert rows(got.select("ngram", "word1_count", "word2_count", "word3_count")) == [("a b a", 2, 3, 2), ("a b c", 2, 3, 1), ("b b a", 1, 3, 2)]
    assert len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) == 2  # the rows and the totals of all positions


def test_id_labels_are_in_the_ids_order(spark):
    from corpusgrams.operators import relabel

    ids = [0, 1, 9, 10, 35, 36, 71, 1295, 1296, 2**31, 2**40]
    df = spark.createDataFrame([(i,) for i in ids], "i long").select("i", relabel.id_label(F.col("i")).alias("l"))
    got = df.select("i", "l", relabel.id_of_label(F.col("l")).cast("long").alias("back")).collect()
    assert all(r.back == r.i and min(r.l) > " " for r in got)
    assert [r.i for r in sorted(got, key=lambda r: r.l)] == ids


def test_all_orders_of_ids_share_one_exchange(lines):
    import re

    from corpusgrams.operators import model as M
    from corpusgrams.operators import relabel

    windows = relabel.id_windows(tk.corpus_tokens(lines, keep=()), M.vocabulary(tk.ngram_counts(lines)))
    text = relabel.encoded(windows)._jdf.queryExecution().optimizedPlan().toString()
    nodes = [re.sub(r"#\d+L?", "", x.lstrip(" :+-")) for x in text.split("\n")]
    below = [tuple(nodes[i:i + 3]) for i, x in enumerate(nodes) if x.startswith("RepartitionByExpression")]
    assert len(below) == 5 and len(set(below)) == 1  # no order leaves columns out below its exchange


@pytest.mark.parametrize("slots", [1, 8, 1 << 16])
def test_frequent_words_do_not_move_for_their_labels(spark, lines, monkeypatch, slots):
    from corpusgrams.operators import model as M
    from corpusgrams.operators import relabel

    monkeypatch.setattr(relabel, "SLOTS", slots)
    tokens = tk.corpus_tokens(lines, keep=())
    words = M.counted_vocabulary(tk.ngram_counts(lines)).select(F.col("word").alias("ngram"), F.col("node").alias("wid"), "ngram_count")
    arrays = relabel.numbered_arrays(tokens)
    got = relabel.labelled(arrays, words, F.col("wid"))
    each = arrays.select("sid", F.posexplode(F.split("words", " ")).alias("at", "ngram"))
    assert rows(got) == rows(each.join(words, "ngram").select("sid", "at", "wid")) and got.count() > 0
    held = relabel.frequent_labels(words.select(F.col("ngram").alias("word"), F.col("wid").alias("label"), F.col("ngram_count").alias("times")))
    top = max(words.collect(), key=lambda r: (r.ngram_count, r.ngram))
    assert held.select(F.size("slots").alias("n")).first().n == slots
    assert (top.ngram, top.wid) in {tuple(x) for x in held.first().slots}
