"""Sentences, tokens and n-grams.

The central table is built by ``ngram_counts``: sentences -> token arrays with
``__bos__``/``__eos__`` -> one *window* per token (it and the next four words)
-> shuffled once by the window's first two words -> one aggregate per order.
An n-gram of order 2 and up is the beginning of windows that all lie in one
partition, so its count needs no shuffle of its own: a token crosses the network
once, not once an order.  Words (order 1) are summed over the partitions' counts.
A hot prefix (``__bos__``) is dealt out by the word after it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stored_in_buckets

NGRAM_KEY = ["order", "begins", "ends"]


# ---------------------------------------------------------------------------
# Sentences
# ---------------------------------------------------------------------------
def sentences(lines: DataFrame, keep: tuple[str, ...] = ("doc_id", "line_no", "file")) -> DataFrame:
    """One row per non-blank sentence of every line, numbered by ``sent_no``.

    ``lines`` needs a ``text`` column; the ``keep`` columns are carried along.
    """
    return lines.select(
        *keep, F.posexplode(T.split_sentences(F.col("text"))).alias("sent_no", "text")
    )


def annotated(sentence: Column, with_eos: bool = True) -> Column:
    """``annotate``: the sentence string with its markers (single blanks)."""
    parts = [F.lit(T.TOKEN_BOS + " "), sentence]
    if with_eos:
        parts.append(F.lit(" " + T.TOKEN_EOS))
    return F.concat(*parts)


def sentence_tokens(sents: DataFrame, with_eos: bool = True) -> DataFrame:
    """Add ``tokens``: lower-cased words of the sentence, wrapped in markers."""
    return sents.withColumn("tokens", T.with_markers(T.words(F.col("text")), with_eos))


def corpus_tokens(lines: DataFrame, keep: tuple[str, ...] = ("doc_id", "line_no", "file")) -> DataFrame:
    """lines -> sentences -> marked token arrays (``keep`` + sent_no, tokens)."""
    s = sentences(lines, keep)
    return s.select(*keep, "sent_no", T.with_markers(T.words(F.col("text"))).alias("tokens"))


# ---------------------------------------------------------------------------
# N-gram generation
# ---------------------------------------------------------------------------
def explode_ngrams(df: DataFrame, tokens: str = "tokens", min_order: int = 1,
                   max_order: int = 5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every n-gram of order ``min_order..max_order`` of a token array.

    Output ``keep + (pos, order, begins, ends)``; ``begins`` is the words but
    the last (the word itself for order 1), ``ends`` the last word.  Uses two
    generators over ``sequence`` (code-generated, no lambda functions).
    """
    a = F.col(tokens)
    n = F.size(a)
    positions = F.when(n >= min_order, F.sequence(F.lit(1), n - min_order + 1)).otherwise(
        F.array().cast("array<int>")
    )
    step1 = df.select(*keep, a.alias("_a"), F.explode(positions).alias("pos"))
    a1, n1, i = F.col("_a"), F.size(F.col("_a")), F.col("pos")
    step2 = step1.select(
        *keep, "_a", "pos",
        F.explode(F.sequence(F.lit(min_order), F.least(F.lit(max_order), n1 - i + 1))).alias("order"),
    )
    o = F.col("order")
    return step2.select(
        *keep,
        "pos",
        o.alias("order"),
        F.when(o == 1, F.element_at(a1, i))
        .otherwise(F.array_join(F.slice(a1, i, o - 1), " "))
        .alias("begins"),
        F.element_at(a1, i + o - 1).alias("ends"),
    )


def ngram_string(begins: Column, ends: Column, order: Column) -> Column:
    """``begins ends`` (the word itself for order 1)."""
    return F.when(order == 1, ends).otherwise(F.concat_ws(" ", begins, ends))


def count_ngrams(ngrams: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A1: ``groupBy(by + order, begins, ends)`` -> ``ngram_count`` (bigint)."""
    return ngrams.groupBy(*by, *NGRAM_KEY).agg(F.count(F.lit(1)).alias("ngram_count"))


def ngram_counts(lines: DataFrame, min_order: int = 1, max_order: int = 5,
                 only: list[int] | None = None) -> DataFrame:
    """T7 + A1: the n-gram model table ``(order, begins, ends, ngram_count)``
    for all orders in one scan and one shuffle of windows.  ``only`` keeps a
    subset of the orders."""
    toks = corpus_tokens(lines, keep=())
    orders = sorted(only) if only is not None else list(range(min_order, max_order + 1))
    if max(orders) < 3:  # few distinct n-grams: counted before the shuffle
        g = explode_ngrams(toks, "tokens", min_order, max_order)
        return count_ngrams(g.filter(F.col("order").isin(orders)) if only is not None else g)
    return count_windows(token_windows(toks, min(orders), max(orders)), orders)


def token_windows(df: DataFrame, shortest: int, longest: int, tokens: str = "tokens") -> DataFrame:
    """``window``: each token and up to ``longest - 1`` words after it, blank-joined;
    windows of fewer than ``shortest`` words are left out."""
    n = F.size(tokens)
    starts = F.when(n >= shortest, F.sequence(F.lit(1), n - shortest + 1)).otherwise(F.array().cast("array<int>"))
    at = df.select(F.col(tokens).alias("_a"), F.explode(starts).alias("_i"))
    return at.select(F.array_join(F.slice("_a", F.col("_i"), longest), " ").alias("window"))


def count_windows(windows: DataFrame, orders: list[int]) -> DataFrame:
    """The model rows of ``orders`` from windows (``counts_by_order``), in one table."""
    parts = counts_by_order(windows, orders).values()
    return reduce(DataFrame.unionByName, [p.drop("pair") for p in parts])


def counts_by_order(windows: DataFrame, orders: list[int], in_ranges: bool = False) -> dict[int, DataFrame]:
    """The model rows of each of ``orders`` from windows, which are shuffled once by their
    first two words: every order reads the same (reused) exchange.

    Orders 2 and up keep ``pair``, the two words, by which their rows lie in the
    partitions: from order 3 on all rows of a ``begins`` lie together.  ``in_ranges``
    deals the pairs out by ranges, so that the partitions follow each other in
    (begins, ends) order.

    The n-gram passes a generator and its length is tested on the count, so that
    no filter of one order moves below the exchange and makes it another one."""
    pair = F.substring_index("window", " ", 2)
    dealt = (windows.repartitionByRange(pair) if in_ranges else windows.repartition(pair)).select(
        "window", pair.alias("pair"))

    def grams(order: int) -> DataFrame:
        gram = F.substring_index("window", " ", order)
        if order > 1:
            gram = F.when(F.substring_index("window", " ", order - 1) != F.col("window"), gram)
        g = dealt.select("pair", F.explode_outer(F.array(gram)).alias("gram"))
        c = g.groupBy("pair", "gram").agg(F.count("gram").alias("ngram_count")).filter(F.col("ngram_count") > 0)
        if order == 1:
            c = c.select(F.col("gram").alias("word"), "ngram_count").groupBy("word").agg(F.sum("ngram_count").alias("ngram_count"))
            c = c.withColumnRenamed("word", "gram")
        begins = F.col("gram") if order == 1 else F.substring_index("gram", " ", order - 1)
        return c.select(*([] if order == 1 else ["pair"]), F.lit(order).alias("order"), begins.alias("begins"),
                        F.substring_index("gram", " ", -1).alias("ends"), "ngram_count")

    return {k: grams(k) for k in orders}


def stored_counts(lines: DataFrame, max_order: int = 5) -> DataFrame:
    """``ngram_counts`` for queries that read the model more than once: the different windows
    with their numbers are written, a third of the model's rows, in buckets of their
    first two words, so that each order is counted from them without another shuffle.
    In a bucket they are sorted, and so are its counts as they come: the model's files are smaller."""
    windows = token_windows(corpus_tokens(lines, keep=()), 1, max_order)
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pair = F.substring_index("window", " ", 2)
    dealt = windows.repartition(parts, pair).select(pair.alias("pair"), "window")
    seen = dealt.groupBy("pair", "window").agg(F.count(F.lit(1)).alias("n"))
    seen = stored_in_buckets(seen, "pair", parts, sort="window")

    def grams(order: int) -> DataFrame:
        gram = F.substring_index("window", " ", order)
        if order > 1:
            gram = F.when(F.substring_index("window", " ", order - 1) != F.col("window"), gram)
        c = seen.select("pair", gram.alias("gram"), "n").filter(F.col("gram").isNotNull())
        c = c.groupBy(*(["pair"] if order > 1 else []), "gram").agg(F.sum("n").alias("ngram_count"))
        begins = F.col("gram") if order == 1 else F.substring_index("gram", " ", order - 1)
        return c.select(F.lit(order).alias("order"), begins.alias("begins"), F.substring_index("gram", " ", -1).alias("ends"), "ngram_count")

    return reduce(DataFrame.unionByName, [grams(k) for k in range(1, max_order + 1)])


def model_by_order(lines: DataFrame, max_order: int = 5, in_ranges: bool = False) -> dict[int, DataFrame]:
    """``ngram_counts`` as one table for each order (see ``counts_by_order``)."""
    windows = token_windows(corpus_tokens(lines, keep=()), 1, max_order)
    return counts_by_order(windows, list(range(1, max_order + 1)), in_ranges)


def line_words(lines: DataFrame, keep: tuple[str, ...] = ("doc_id", "line_no", "file")) -> DataFrame:
    """T4 ``unnest_tokens``: lower-cased words of each line, one per row."""
    return lines.select(
        *keep, F.posexplode(T.words(F.col("text"))).alias("word_no", "word")
    )


def line_ngrams(lines: DataFrame, n: int, keep: tuple[str, ...] = ("doc_id", "line_no", "file")) -> DataFrame:
    """T5 ``unnest_ngrams(n)``: sliding n-grams of each line, no markers.

    Lines with fewer than ``n`` words give no row (the reference's NA row is
    dropped up front).
    """
    toks = lines.select(*keep, T.words(F.col("text")).alias("tokens"))
    g = explode_ngrams(toks, "tokens", n, n, keep)
    return g.select(*keep, "pos", ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("ngram"))


# ---------------------------------------------------------------------------
# Phrase-side parsing
# ---------------------------------------------------------------------------
def suffix_grams(words_col: Column, max_order: int) -> Column:
    """T10 ``parse_gram_of_order``: the suffix grams of order ``min(max, n)..1``
    of a word array, as ``array<struct<order, begins, ends>>``.  Order 1 has
    ``begins == ends``."""
    n = F.size(words_col)
    top = F.least(F.lit(max_order), n)

    def one(k: Column) -> Column:
        g = F.slice(words_col, -k, k)
        return F.struct(
            k.alias("order"),
            F.when(k == 1, F.element_at(g, 1))
            .otherwise(F.array_join(F.slice(g, 1, k - 1), " "))
            .alias("begins"),
            F.element_at(g, -1).alias("ends"),
        )

    ks = F.when(n >= 1, F.sequence(top, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.transform(ks, one)


def squished_words(text: Column) -> Column:
    """``str_squish`` + lower + split on blank (the phrase parser's words)."""
    s = T.squish(text)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(F.lower(s), " "))


def phrase_suffix_grams(phrases: DataFrame, key: tuple[str, ...], max_order: int = 3,
                        text: str = "text") -> DataFrame:
    """T10 for a table of phrases: one row per (phrase, suffix gram)."""
    return phrases.select(
        *key, F.inline(suffix_grams(squished_words(F.col(text)), max_order))
    )


def user_input_grams(phrases: DataFrame, key: tuple[str, ...], order: int = 5,
                     with_eos: bool = False, text: str = "text") -> DataFrame:
    """T11 ``parse_grams_from_user_input``: basic clean -> sentences with the
    begin marker -> suffix grams of order ``order..1`` per sentence."""
    cleaned = phrases.select(*key, T.basic_clean(F.col(text)).alias("text"))
    sents = cleaned.select(
        *key, F.posexplode(T.split_sentences(F.col("text"))).alias("sentence_id", "text")
    )
    marked = sents.select(*key, "sentence_id", annotated(F.col("text"), with_eos).alias("text"))
    return marked.select(
        *key, "sentence_id", F.inline(suffix_grams(squished_words(F.col("text")), order))
    )


def evaluation_grams(texts: DataFrame, key: tuple[str, ...], max_order: int = 5,
                     text: str = "text") -> DataFrame:
    """T12 ``parse_grams_for_evaluation``: every n-gram of order 1..max of the
    sentences of a text (with both markers), with position."""
    lines = texts.select(*key, F.col(text).alias("text"))
    toks = corpus_tokens(lines, keep=key)
    return explode_ngrams(toks, "tokens", 1, max_order, keep=(*key, "sent_no"))


def last_words(text: Column, n: int) -> Column:
    """T14 ``trunc_phrase``: the last ``n`` blank-separated words, re-joined (all
    of them where there are fewer)."""
    parts = F.split(text, " ")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), " ")


def word_from_end(text: Column, how_many: int = 1) -> Column:
    """T15 ``v_last_words``: the single word ``how_many`` from the end."""
    return F.try_element_at(F.split(text, " "), F.lit(-how_many))


def split_last_word(ngram: Column) -> tuple[Column, Column]:
    """T17 from a string: (prefix = all but the last word, last word).  A
    unigram has prefix == word."""
    return (
        F.regexp_replace(ngram, " [^ ]+$", ""),
        F.regexp_extract(ngram, "[^ ]+$", 0),
    )


def ngram_order(ngram: Column) -> Column:
    """Number of blanks + 1."""
    without = F.replace(ngram, F.lit(" "), F.lit(""))
    return (F.octet_length(ngram) - F.octet_length(without) + 1).cast("int")


# Penn-Treebank contraction split (T8), token by token: "don't" -> "do n't",
# "can't" -> "ca n't", "it's" -> "it 's", "cannot" -> "can not", "gonna" ->
# "gon na" (fixed values: the public rule set; also with typographic marks).
PTB_SPLITS = (
    r"^(.+?)(n['’]t|['’](?:ll|re|ve|s|m|d))$",
    r"^(can)(not)$",
    r"^(d)(['’]ye)$",
    r"^(gim|lem)(me)$",
    r"^(gon|wan)(na)$",
    r"^(got)(ta)$",
    r"^(more)(['’]n)$",
    r"^(['’]t)(is|was)$",
)
PTB_MAY_SPLIT = "['’]|cannot|gimme|lemme|gonna|wanna|gotta"  # every token that is split holds one of these


def ptb_split(tokens: Column) -> Column:
    """Split contractions inside a token array (flat result)."""
    def split(w: Column) -> Column:
        for pattern in PTB_SPLITS:
            w = F.regexp_replace(w, pattern, "$1 $2")
        return w

    whole = F.array_join(tokens, " ")
    # most sentences hold nothing to split: told by one search, not by eight a token
    return F.split(F.when(whole.rlike(PTB_MAY_SPLIT), F.array_join(F.transform(tokens, split), " ")).otherwise(whole), " ")


def tweet_text(sentence: Column) -> Column:
    """T3 tweet branch: strip URLs, keep case, keep #tags/@users, drop other
    punctuation; tokens re-joined with blanks."""
    no_url = F.regexp_replace(sentence, T.URL_PATTERN, "")
    return F.array_join(F.regexp_extract_all(no_url, F.lit(T.TWEET_TOKEN_PATTERN), 0), " ")
