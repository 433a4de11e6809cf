"""Language-model queries over the n-gram table.

The corpus is ``(order, begins, ends, ngram_count)``; phrase-side inputs are
tables keyed by the caller's key columns, and every query answers all phrases
in one job.  Joins are plain equi-joins: adaptive execution broadcasts the
phrase side when it is measured small and splits skewed partitions between
plain shuffles; totals of a hot prefix (``__bos__``, frequent words) are
written out first for that.  Top-k continuations are pruned per prefix before
the join, ties kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import cut_lineage, stored
from . import ordinals as O
from . import prefilter as PF
from . import ranking as W
from .tokenize import ngram_string

KEY = ["order", "begins", "ends"]


# ---------------------------------------------------------------------------
# Corpus tables
# ---------------------------------------------------------------------------
def load_corpus(counts: DataFrame, with_ids: bool = True, slice_maximum: int | None = None,
                lines_maximum: int | None = None) -> DataFrame:
    """M4: the union of the five order tables with order-1 ``ends`` NULL and a
    dense ``ngram_id`` in (order, begins, ends) order (kept where ``counts`` has it).

    ``lines_maximum`` reads the first rows of each order only, ``slice_maximum``
    then keeps the most frequent continuations of each ``begins``."""
    c = counts if lines_maximum is None else cap_per_order(counts, lines_maximum)
    if slice_maximum is not None:
        c = W.prune_continuations(c, slice_maximum)
    c = c.withColumn("ends", F.when(F.col("order") == 1, F.lit(None)).otherwise(F.col("ends")))
    if not with_ids or "ngram_id" in c.columns:
        return c
    return O.global_row_number(c, ["order", "begins", "ends"], "ngram_id")


def numbered(by_order: dict[int, DataFrame]) -> DataFrame:
    """The model with its ``ngram_id``, from the tables of each order dealt out by
    ranges (``tokenize.counts_by_order``), which are numbered where they lie.

    No character of a word sorts before the blank, so the order of the words is that
    of the first two and then of all; order 1, a row a word, is put in ranges here."""
    key = ["begins", "ends"]
    parts = [by_order[k].drop("pair") if k > 1 else by_order[k].repartitionByRange(*key) for k in sorted(by_order)]
    return O.number_in_ranges(parts, key, "ngram_id")


def corpus_size(counts: DataFrame) -> DataFrame:
    """M4: rows per order (the ``N`` of each table)."""
    return counts.groupBy("order").agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_total(counts: DataFrame) -> DataFrame:
    """M4: the total ``N`` beside that of each order (``order`` null), in one pass."""
    return counts.rollup("order").agg(F.count(F.lit(1)).alias("n_rows"))


def cap_per_order(counts: DataFrame, n: int) -> DataFrame:
    """S4 ``lines_maximum``: the first ``n`` rows of each order in
    (begins, ends) order (explicit order replaces file order)."""
    return W.top_k(counts, ["order"], [F.col("begins"), F.col("ends")], n)


def capped_by_order(by_order: dict[int, DataFrame], n: int) -> DataFrame:
    """``cap_per_order`` of the tables of each order: a task keeps its first ``n`` rows
    in a heap, nothing else is sorted or moved."""
    return reduce(DataFrame.unionByName, [
        c.select(*KEY, "ngram_count").orderBy("begins", "ends").limit(n) for c in by_order.values()])


def end_counted(grams: DataFrame, unigrams: DataFrame) -> DataFrame:
    """N-gram counts of one order joined with the unigram count of their
    last word: ``end_count`` and ``MLE = ngram_count / end_count``.

    Both inputs are count tables (the unigram one of order 1); the join is on
    ``ends`` and is skew-safe (hot last words such as ``__eos__`` are split
    by adaptive skew handling; the unigram side has one row per word)."""
    uni = unigrams.filter(F.col("order") == 1).select("ends", F.col("ngram_count").alias("end_count"))
    return grams.join(uni, "ends").withColumn("MLE", F.col("ngram_count") / F.col("end_count"))


def prefix_totals(counts: DataFrame) -> DataFrame:
    """Sum of counts per (order, begins): the denominator of P(w | begins).
    For order 1 the 'prefix' is empty: the total of the order."""
    hi = counts.filter(F.col("order") > 1).groupBy("order", "begins").agg(
        F.sum("ngram_count").alias("prefix_total")
    )
    return hi


def mle_next_word(counts: DataFrame) -> DataFrame:
    """M9: ``P(ends | begins) = count / sum(count of the prefix)``; order 1
    uses the order's total (aggregate + join, no per-prefix window)."""
    # written out: adaptive execution splits a hot prefix only between plain shuffles
    hi = counts.filter(F.col("order") > 1).join(stored(prefix_totals(counts)), ["order", "begins"])
    one = counts.filter(F.col("order") == 1)
    one_tot = one.agg(F.sum("ngram_count").alias("prefix_total"))
    one = one.crossJoin(F.broadcast(one_tot))
    out = hi.unionByName(one)
    return out.withColumn("mle", F.col("ngram_count") / F.col("prefix_total"))


def mle_by_order(by_order: dict[int, DataFrame]) -> DataFrame:
    """``mle_next_word`` from the tables of each order (``tokenize.counts_by_order``):
    from order 3 on a prefix's rows lie together, and only those of order 2 move."""
    parts = []
    for k, c in by_order.items():
        if k == 1:
            t = c.crossJoin(F.broadcast(c.agg(F.sum("ngram_count").alias("prefix_total"))))
        elif k == 2:
            t = c.join(prefix_totals(c), ["order", "begins"])
        else:
            t = c.withColumn("prefix_total", F.sum("ngram_count").over(Window.partitionBy("pair", "begins")))
        parts.append(t.select(*KEY, "ngram_count", "prefix_total"))
    return reduce(DataFrame.unionByName, parts).withColumn("mle", F.col("ngram_count") / F.col("prefix_total"))


# ---------------------------------------------------------------------------
# Phrase-side queries
# ---------------------------------------------------------------------------
def odds_of(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """M1 ``odds_of``: grams joined with the model on (order, begins, ends),
    then with the unigram count of ``ends`` as ``prefix_count``;
    ``odds = ln(ngram_count / prefix_count)``."""
    uni = counts.filter(F.col("order") == 1).select(
        F.col("ends").alias("_w"), F.col("ngram_count").alias("prefix_count")
    )
    j = grams.join(counts, KEY).join(uni, F.col("ends") == F.col("_w")).drop("_w")
    return j.withColumn("odds", F.ln(F.col("ngram_count") / F.col("prefix_count")))


def perplexity(odds: DataFrame, key: list[str]) -> DataFrame:
    """M3: ``(1/exp(sum odds))^(1/N)`` per text, computed as
    ``exp(-avg(odds))`` (same value, no underflow)."""
    return odds.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.exp(-F.avg("odds")).alias("perplexity")
    )


def next_options(grams: DataFrame, counts: DataFrame, key: list[str], maxopts: int = 40) -> DataFrame:
    """M2 ``next_options``: continuations of the grams' ``begins`` in the table
    of the same order (2 and up; an order-1 row continues nothing), the
    ``maxopts`` most frequent per phrase and order, ties kept.

    The corpus is first cut to the top ``maxopts`` (with ties) of every
    (order, begins) that a phrase asks for - exact, since a row in a phrase's
    top-k is in its own prefix's top-k.  The count of a phrase's last place follows
    from the first ``maxopts`` rows of each prefix; ties, which can be as many as the
    vocabulary, then meet the phrases in the last join and are not moved again.
    ``counts`` is read twice.
    """
    ctx = grams.filter(F.col("order") >= 2).select(*key, "order", "begins").distinct()
    wanted = counts.join(ctx.select("order", "begins").distinct(), ["order", "begins"], "left_semi")
    most = [F.col("ngram_count").desc()]
    pruned = W.top_k(wanted, ["begins", "order"], most, maxopts, ties=True).select("order", "begins", "ends", "ngram_count")
    first = W.top_k(wanted, ["begins", "order"], most, maxopts).select("order", "begins", "ngram_count")
    last = W.top_k(ctx.join(first, ["order", "begins"]), [*key, "order"], most, maxopts, rank_col="_place").filter(
        F.col("_place") == maxopts).select(*[F.col(c).alias(f"_of_{c}") for c in [*key, "order"]], F.col("ngram_count").alias("_least"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*key, "order"]])
    asked = ctx.join(last, same, "left").select(*key, "order", "begins", "_least")
    return asked.join(pruned, ["order", "begins"]).filter(
        F.col("ngram_count") >= F.coalesce("_least", F.lit(0))).select(*key, "order", "begins", "ends", "ngram_count")


def next_matches(grams: DataFrame, counts: DataFrame, key: list[str], literal: bool = True) -> DataFrame:
    """M5 ``nextmatches``: each suffix gram ``g`` of order k matches corpus
    rows of order k+1 whose ``begins`` equals the gram's words.

    ``literal=True`` builds the match string as ``begins || ' ' || ends`` for
    every order, as the reference does (an order-1 gram then reads "w w");
    ``literal=False`` uses the gram's words (the plain suffix).
    """
    if literal:
        words = F.concat_ws(" ", F.col("begins"), F.col("ends"))
    else:
        words = ngram_string(F.col("begins"), F.col("ends"), F.col("order"))
    g = grams.select(*key, (F.col("order") + 1).alias("order"), words.alias("begins"))
    return g.join(counts, ["order", "begins"]).select(*key, "order", "begins", "ends", "ngram_count")


def next_word_backoff(grams: DataFrame, counts: DataFrame, key: list[str], k: int | None = None,
                      longest_only: bool = False) -> DataFrame:
    """M5 with plain suffixes: every continuation of every suffix of a sentence,
    of all matching orders, with its ``rank`` (order desc, count desc, word).
    ``counts`` is read by several branches.

    ``k`` keeps the first so many of each matched context, ``longest_only`` the
    longest context that the corpus knows."""
    if k is not None:
        ctx = grams.select(
            (F.col("order") + 1).alias("order"),
            ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("begins"),
        ).distinct()
        wanted = counts.join(ctx, ["order", "begins"], "left_semi")
        counts = W.top_k(wanted, ["begins", "order"], [F.col("ngram_count").desc(), F.col("ends")], k)
    w = Window.partitionBy(*key).orderBy(F.desc("order"), F.desc("ngram_count"), "ends")

    def ranked(m: DataFrame) -> DataFrame:
        return m.select(*key, "order", "begins", "ends", "ngram_count").withColumn("rank", F.row_number().over(w))

    if longest_only:
        m = next_matches(grams, counts, key, literal=False)
        return ranked(m.join(m.groupBy(*key).agg(F.max("order").alias("order")), [*key, "order"]))
    # A key with one gram an order: a match's rank is its place in its context after all
    # matches of the longer ones, so that only contexts are ranked and no match is moved.
    of_order = F.count(F.lit(1)).over(Window.partitionBy(*key, "order"))
    g = grams.withColumn("_same", of_order).withColumn("_same", F.max("_same").over(Window.partitionBy(*key)))
    again = ranked(next_matches(g.filter(F.col("_same") > 1), counts, key, literal=False))
    ctx = g.filter(F.col("_same") == 1).select(
        *key, (F.col("order") + 1).alias("order"), ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("begins"))
    sizes = counts.groupBy("order", "begins").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*key).orderBy(F.desc("order")).rowsBetween(Window.unboundedPreceding, -1)
    met = ctx.join(sizes, ["order", "begins"]).withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("order", "begins").orderBy(F.desc("ngram_count"), "ends"))
    once = met.drop("_size").join(counts.withColumn("_place", place), ["order", "begins"]).select(
        *key, "order", "begins", "ends", "ngram_count", (F.col("_before") + F.col("_place")).cast("int").alias("rank"))
    return once.unionByName(again)


def eval_continuations(grams: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """M6 ``whole_eval_kabang``: the text's grams matched on (order, begins);
    ``prefix_count`` = sum of matched counts per (order, begins); then every
    continuation of those prefixes."""
    # occurrences of a prefix times the prefix's own total: no row per continuation before the sum
    asked = grams.groupBy(*key, "order", "begins").agg(F.count(F.lit(1)).alias("_times"))
    totals = counts.groupBy("order", "begins").agg(F.sum("ngram_count").alias("_total"))
    pc = asked.join(totals, ["order", "begins"]).select(
        *key, "order", "begins", (F.col("_times") * F.col("_total")).alias("prefix_count"))
    return pc.join(counts, ["order", "begins"]).select(*key, "order", "begins", "ends", "ngram_count", "prefix_count")


def full_matches(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """J2 ``fullmatches``: corpus rows whose ``ends`` is among the grams'
    ends and whose ``begins`` is among the grams' begins (two semi-joins).
    ``ends`` of an order-1 corpus row is NULL, so it never matches."""
    counts = load_corpus(counts, with_ids=False)
    e = grams.select("ends").distinct()
    b = grams.select("begins").distinct()
    return counts.join(e, "ends", "left_semi").join(b, "begins", "left_semi")


def drop_last_word(c):
    return F.regexp_replace(c, " [^ ]+$", "")


def begin_counts(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """M7 ``begincounts`` as written: ``prefix`` = begins without its last
    word; begins-counts are summed for (prefix, order-1) but joined on the
    *same* order, so mostly orders 1-2 find a partner."""
    fm = full_matches(counts, grams).withColumn("prefix", drop_last_word(F.col("begins")))
    sofar = fm.filter(F.col("order") >= 2).select(
        F.col("prefix").alias("begins"), (F.col("order") - 1).alias("order")
    )
    sb = sofar.select("begins").distinct()
    so = sofar.select("order").distinct()
    bc = (
        counts.join(sb, "begins", "left_semi").join(so, "order", "left_semi")
        .groupBy("begins", "order").agg(F.sum("ngram_count").alias("begins_count"))
        .withColumnRenamed("begins", "prefix")
    )
    return fm.join(bc, ["prefix", "order"])


def prefix_counts(counts: DataFrame, grams: DataFrame) -> DataFrame:
    """M7 as documented: for each full match of order n >= 2, the count of
    the (n-1)-gram equal to its ``begins``."""
    fm = full_matches(counts, grams).filter(F.col("order") >= 2)
    lower = counts.select(
        (F.col("order") + 1).alias("order"),
        ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("begins"),
        F.col("ngram_count").alias("prefix_count"),
    )
    return fm.join(lower, ["order", "begins"])


def odds_of_phrases(grams: DataFrame, counts: DataFrame, key: list[str], total: DataFrame | None = None) -> DataFrame:
    """M8 ``odds_of_phrases``: count of each gram (0 when unseen) and of its
    prefix; an order-1 gram's prefix count is the total number of order-1
    occurrences (one row ``_total``; by default the sum of ``counts``);
    ``odds = count / prefix_count`` (0 when undefined)."""
    model = counts.select(
        ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("ngram"), "ngram_count"
    )
    if total is None:
        total = counts.filter(F.col("order") == 1).agg(F.sum("ngram_count").alias("_total"))
    g = grams.select(
        *key, "order",
        ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("ngram"),
        F.when(F.col("order") > 1, F.col("begins")).alias("prefix"),
    )
    g = g.join(model, "ngram", "left").withColumn("ngram_count", F.coalesce("ngram_count", F.lit(0)))
    pm = model.select(F.col("ngram").alias("prefix"), F.col("ngram_count").alias("prefix_count"))
    g = g.join(pm, "prefix", "left").crossJoin(F.broadcast(total))
    g = g.withColumn(
        "prefix_count", F.when(F.col("prefix").isNull(), F.col("_total")).otherwise(F.col("prefix_count"))
    ).drop("_total")
    return g.withColumn(
        "odds", F.coalesce(F.try_divide(F.col("ngram_count"), F.col("prefix_count")).cast("double"), F.lit(0.0))
    )


def phrase_lookup(phrases: DataFrame, counts: DataFrame, key: list[str]) -> DataFrame:
    """M11 ``searcher``: the last two words of each phrase; the count of that
    bigram and of its first word (NULL when unseen)."""
    w = T.words(F.col("text"))
    p = phrases.select(*key, F.slice(w, -2, 2).alias("_g")).filter(F.size("_g") == 2)
    p = p.select(*key, F.element_at("_g", 1).alias("prefix"), F.element_at("_g", 2).alias("_e"))
    bi = counts.filter(F.col("order") == 2).select(
        F.col("begins").alias("prefix"), F.col("ends").alias("_e"), "ngram_count"
    )
    uni = counts.filter(F.col("order") == 1).select(F.col("ends").alias("prefix"), F.col("ngram_count").alias("prefix_count"))
    out = p.join(bi, ["prefix", "_e"], "left").join(uni, "prefix", "left")
    return out.select(*key, F.concat_ws(" ", "prefix", "_e").alias("ngram"), "prefix", "ngram_count", "prefix_count")


# ---------------------------------------------------------------------------
# Vocabulary, encoding, trimming
# ---------------------------------------------------------------------------
def vocabulary(counts: DataFrame) -> DataFrame:
    """Distinct words of the unigram table with ``wid`` in word order."""
    words = counts.filter(F.col("order") == 1).select(F.col("ends").alias("ngram")).distinct()
    return O.global_row_number(words, ["ngram"], "wid")


def counted_vocabulary(counts: DataFrame) -> DataFrame:
    """Each word of the unigram table once, written out: word, node (its ``wid``), ngram_count."""
    words = counts.filter(F.col("order") == 1).select(F.col("ends").alias("word"), "ngram_count")
    return stored(O.global_row_number(words, ["word"], "node"))


def _explode_words(counts: DataFrame) -> DataFrame:
    """(n-gram key, position, word) for every word of every n-gram."""
    words = F.when(F.col("order") == 1, F.array("ends")).otherwise(
        F.concat(F.split("begins", " "), F.array("ends"))
    )
    return counts.select(*KEY, "ngram_count", F.posexplode(words).alias("wpos", "word"))


def _regroup(exploded: DataFrame, value: str, keep: list[str]) -> DataFrame:
    """Re-assemble the per-word rows of each n-gram in position order."""
    g = exploded.groupBy(*KEY, *keep).agg(
        F.array_sort(F.collect_list(F.struct("wpos", F.col(value).alias("v")))).alias("_ws")
    )
    return g.withColumn("_ws", F.transform("_ws", lambda s: s["v"]))


def encode_ngrams(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Every n-gram as word ids: ``begins_ids`` (blank-joined ids of the
    context) and ``ends_id``."""
    ex = _explode_words(counts).join(vocab.select(F.col("ngram").alias("word"), "wid"), "word", "left")
    g = _regroup(ex.withColumn("wid", F.col("wid").cast("string")), "wid", ["ngram_count"])
    n = F.size("_ws")
    return g.select(
        "order",
        F.when(n == 1, F.element_at("_ws", 1)).otherwise(F.array_join(F.slice("_ws", 1, n - 1), " ")).alias("begins_ids"),
        F.element_at("_ws", -1).cast("int").alias("ends_id"),
        "ngram_count",
    )


def recode_begins(counts_with_ids: DataFrame, vocab: DataFrame) -> DataFrame:
    """J5 ``recode_ngrams``: ``begins`` replaced by its word id when it is a
    single known word, NULL otherwise; every row kept (left join).  Rows whose
    ``begins`` holds a blank are no single word and do not move for the join."""
    v = vocab.select(F.col("ngram").alias("begins"), F.col("wid").alias("begins_wid"))
    several = F.coalesce(F.contains("begins", F.lit(" ")), F.lit(False))
    found = counts_with_ids.filter(~several).join(v, "begins", "left")
    rest = counts_with_ids.filter(several).withColumn("begins_wid", F.lit(None).cast(v.schema["begins_wid"].dataType))
    columns = ["ngram_id", "begins_wid", "order", "ends", "ngram_count"]
    return found.select(*columns).unionByName(rest.select(*columns))


def recode_single(table: DataFrame, id_col: str, word_col: str, vocab: DataFrame) -> DataFrame:
    """J5 ``recode_single``: (id, word) -> (id, word id); unknown words drop."""
    v = vocab.select(F.col("ngram").alias(word_col), "wid")
    return table.select(id_col, word_col).join(v, word_col).select(id_col, F.col("wid").alias("ngram"))


def word_classes(counts: DataFrame, most_frequent_first: bool = False) -> DataFrame:
    """One row per distinct word count: ``wc``, ``n_words`` with that count, and
    the words and occurrences of this and all earlier classes (``words_to``,
    ``sum_to``).  A corpus of T tokens has fewer than ``sqrt(2 T)`` classes, so
    the running sums are windows over a small table, never over the vocabulary."""
    by = F.col("wc").desc() if most_frequent_first else F.col("wc").asc()
    running = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    classes = counts.filter(F.col("order") == 1).groupBy(F.col("ngram_count").alias("wc")).agg(
        F.count(F.lit(1)).alias("n_words"))
    return classes.select("wc", "n_words", F.sum("n_words").over(running).alias("words_to"),
                          F.sum(F.col("wc") * F.col("n_words")).over(running).alias("sum_to"))


def rare_words(counts: DataFrame, prop: float) -> tuple[DataFrame, DataFrame]:
    """M13's words: the ``floor(prop * V)`` least frequent ones (ties by word), and
    one row with the count ``cutoff`` of the last of them (null when there is none).

    The cut-off follows from the classes; words below it are taken as they are,
    and only those with exactly that count are put in order."""
    classes = word_classes(counts)
    wanted = classes.agg(F.floor(F.max("words_to") * F.lit(float(prop))).alias("_wanted"))
    at_cut = (F.col("words_to") - F.col("n_words") < F.col("_wanted")) & (F.col("_wanted") <= F.col("words_to"))
    last = classes.crossJoin(F.broadcast(wanted)).filter(at_cut)  # one row, or none
    cut = cut_lineage(last.agg(F.max("wc").alias("cutoff"),
                               F.max(F.col("_wanted") - (F.col("words_to") - F.col("n_words"))).alias("ties")))
    words = counts.filter(F.col("order") == 1).select(F.col("ends").alias("word"), F.col("ngram_count").alias("wc"))
    cutoff = cut.select("cutoff").scalar()
    below = words.filter(F.col("wc") < cutoff).select("word")
    tied = O.global_row_number(words.filter(F.col("wc") == cutoff).select("word"), ["word"], "_rk")
    tied = tied.filter(F.col("_rk") <= cut.select("ties").scalar()).select("word")
    return cut_lineage(below.unionByName(tied)), cut.select("cutoff")


def trim_unknown(counts: DataFrame, prop: float = 0.4, max_order: int = 5) -> DataFrame:
    """M13 ``trim(prop)``: the ``floor(prop * V)`` least frequent words (ties
    by word) become ``__unk__`` in every order; counts are re-summed.

    An n-gram is no more frequent than any of its words, so one above the
    cut-off holds no rare word; of the others a bitmap of the rare words lets
    through those that may hold one.  Only they are taken apart (the marked
    words alone, an exact join behind the bitmap) and summed again; all others
    stay as they are, without a shuffle."""
    rare, cutoff = rare_words(counts, prop)
    bits = PF.asked_bits(rare)
    words = F.when(F.col("order") == 1, F.array("ends")).otherwise(F.concat(F.split("begins", " "), F.array("ends")))
    c = counts.select(*KEY, "ngram_count", words.alias("_ws"))

    def marked(i: int):
        w = F.get("_ws", F.lit(i))
        return F.when(w.isNotNull() & PF.may_be_asked(bits, w), w)

    may = F.array_compact(F.array(*[marked(i) for i in range(max_order)]))
    seldom = F.coalesce(F.col("ngram_count") <= cutoff.scalar(), F.lit(False))
    c = c.withColumn("_may", F.when(seldom, may).otherwise(F.array().cast("array<string>")))
    c = stored(c.withColumn("_touched", (F.size("_may") > 0) | F.array_contains("_ws", T.TOKEN_UNK)))
    marks = c.filter("_touched").select(*KEY, "ngram_count", "_ws", F.explode_outer(F.array_distinct("_may")).alias("word"))
    found = marks.join(rare.withColumn("_rare", F.lit(True)), "word", "left")
    grams = found.groupBy(*KEY, "ngram_count", "_ws").agg(F.collect_set(F.when(F.col("_rare"), F.col("word"))).alias("_out"))
    ws = F.transform("_ws", lambda w: F.when(F.array_contains("_out", w), F.lit(T.TOKEN_UNK)).otherwise(w))
    g = grams.select("order", "ngram_count", ws.alias("_ws"))
    n = F.size("_ws")
    again = g.select(
        "order",
        F.when(n == 1, F.element_at("_ws", 1)).otherwise(F.array_join(F.slice("_ws", 1, n - 1), " ")).alias("begins"),
        F.element_at("_ws", -1).alias("ends"),
        "ngram_count",
    ).groupBy(*KEY).agg(F.sum("ngram_count").alias("ngram_count"))
    return c.filter(~F.col("_touched")).select(*KEY, "ngram_count").unionByName(again)


def coverage(counts: DataFrame, fractions: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """The smallest number of most frequent words whose counts cover
    each fraction of all word instances.

    From the classes of words with the same count: the class in which the
    running sum first reaches the fraction, and how many of its words that
    takes.  The vocabulary is never ranked."""
    c = word_classes(counts, most_frequent_first=True)
    total = c.agg(F.max("sum_to").alias("_tot"))
    c = c.crossJoin(F.broadcast(total))  # one-row scalar
    mins = []
    for i, f in enumerate(fractions):
        need = F.ceil(F.col("_tot") * F.lit(float(f)))
        before = F.col("sum_to") - F.col("wc") * F.col("n_words")
        of_class = F.greatest(F.lit(1), F.call_function("div", need - before + F.col("wc") - 1, F.col("wc")))
        rank = (F.col("words_to") - F.col("n_words") + of_class).cast("bigint")
        mins.append(F.min(F.when(F.col("sum_to") >= need, rank)).alias(f"f{i}"))
    rows = F.array(*[
        F.struct(F.lit(float(f)).alias("fraction"), F.col(f"f{i}").alias("n_words"))
        for i, f in enumerate(fractions)
    ])
    return c.agg(*mins).select(F.inline(rows))
