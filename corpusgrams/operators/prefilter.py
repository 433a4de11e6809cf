"""Counting only the n-grams that a set of phrases asks for.

A few phrases need few rows of the model, but the model is a count over the
whole corpus.  ``asked_bits`` turns the wanted keys into a bitmap of ``BITS`` bits or, where many
phrases would set too large a part of them, of ``bits_for`` their number (at most
``MOST_BITS``), one row of long words built by a hash aggregate.  ``may_be_asked`` tests a key's bit in it; the n-gram
generator is filtered with that test before the counting aggregate, so
occurrences of n-grams that nobody asked for are never aggregated or shuffled.
A set bit may be another key's: the exact join on the key stays behind it, and
the result does not depend on the bitmap's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from . import tokenize as tk

BITS = 1 << 22  # half a megabyte, for each bitmap
MOST_BITS = 1 << 26  # eight megabytes
BITS_A_KEY = 16  # one key in so many of those that nobody asked for passes


def bits_for(n_keys: int) -> int:
    """A power of two: the bits of a bitmap that ``n_keys`` keys leave mostly unset."""
    return min(max(BITS, 1 << (BITS_A_KEY * max(n_keys, 1) - 1).bit_length()), MOST_BITS)


def _bit(columns: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def asked_bits(keys: DataFrame, bits: int = BITS) -> DataFrame:
    """One row: ``words array<bigint>``, bit i % 64 of word i / 64 set for the hash
    of every row of ``keys`` (all its columns, in order); no keys: no bit."""
    at = keys.select(_bit([keys[c] for c in keys.columns], bits).alias("at"))
    words = at.groupBy(F.expr("at div 64").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))).alias("set"))
    empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("set"))
    both = empty.unionByName(words).groupBy("word").agg(F.bit_or("set").alias("set"))  # bits / 64 rows, always
    ordered = F.array_sort(F.collect_list(F.struct("word", "set")))
    return cut_lineage(both.agg(F.transform(ordered, lambda x: x["set"]).alias("words")))


def may_be_asked(bitmap: DataFrame, *columns: Column, bits: int = BITS) -> Column:
    """Whether the key's bit is set: True for every asked key, False for nearly all others.

    The bitmap is a scalar subquery: each task gets its one value."""
    at = _bit(list(columns), bits)
    word = F.get(bitmap.scalar(), F.floor(at / 64).cast("int"))
    return F.getbit(word, (at % 64).cast("int")) == 1


def asked_twice(keys: DataFrame, *columns: Column) -> Column:
    """``may_be_asked`` for ``keys`` (written out, each once), which may be many: two bitmaps of
    other hashes, as large as the keys' number needs, and both bits must be set."""
    bits, salt = bits_for(keys.count()), F.lit(1)
    one, two = asked_bits(keys, bits), asked_bits(keys.select(salt.alias("_salt"), "*"), bits)
    return may_be_asked(one, *columns, bits=bits) & may_be_asked(two, salt, *columns, bits=bits)


def counted_where(lines: DataFrame, keep: list[Column], orders: list[int]) -> DataFrame:
    """The model rows (order, begins, ends, ngram_count) of ``orders`` for which
    any of ``keep`` holds; the other occurrences go before they are counted."""
    toks = tk.corpus_tokens(lines, keep=())
    grams = tk.explode_ngrams(toks, "tokens", min(orders), max(orders))
    if len(orders) < max(orders) - min(orders) + 1:
        grams = grams.filter(F.col("order").isin(orders))
    return tk.count_ngrams(grams.filter(reduce(lambda a, b: a | b, keep)))


def whole_gram() -> Column:
    """The n-gram's words as one string."""
    return tk.ngram_string(F.col("begins"), F.col("ends"), F.col("order"))


# --- the model rows that each phrase query needs -----------------------------


def counts_for_grams(lines: DataFrame, grams: DataFrame, orders: list[int]) -> DataFrame:
    """Counts of the grams (order, begins, ends) themselves and of the word each ends with."""
    order = F.col("order").cast("int")
    wanted = grams.select(order, "begins", "ends").distinct()
    words = wanted.select(F.lit(1).alias("order"), F.col("ends").alias("begins"), "ends")
    bits = asked_bits(wanted.unionByName(words))
    return counted_where(lines, [may_be_asked(bits, order, F.col("begins"), F.col("ends"))], sorted({1, *orders}))


def counts_of_contexts(lines: DataFrame, contexts: DataFrame, orders: list[int]) -> DataFrame:
    """Counts of every n-gram whose (order, begins) is a row of ``contexts``."""
    order = F.col("order").cast("int")
    wanted = stored(contexts.select(order.alias("order"), "begins").distinct())
    return counted_where(lines, [asked_twice(wanted, order, F.col("begins"))], orders)


def counts_for_matches(lines: DataFrame, grams: DataFrame, orders: list[int], prefixes: bool = False) -> DataFrame:
    """Counts of the n-grams with any gram's ``begins`` and any gram's ``ends``;
    with ``prefixes`` also of those that are, as a whole, some gram's ``begins``."""
    begins, ends = asked_bits(grams.select("begins").distinct()), asked_bits(grams.select("ends").distinct())
    keep = [may_be_asked(ends, F.col("ends")) & may_be_asked(begins, F.col("begins"))]
    if prefixes:
        keep.append(may_be_asked(begins, whole_gram()))
    return counted_where(lines, keep, orders)


def counts_for_begins(lines: DataFrame, grams: DataFrame, shorter: Column, orders: list[int]) -> DataFrame:
    """``counts_for_matches``, and counts of all n-grams whose ``begins`` is ``shorter`` of any gram."""
    begins, ends = asked_bits(grams.select("begins").distinct()), asked_bits(grams.select("ends").distinct())
    less = asked_bits(grams.select(shorter.alias("begins")).distinct())
    return counted_where(lines, [may_be_asked(ends, F.col("ends")) & may_be_asked(begins, F.col("begins")),
                                 may_be_asked(less, F.col("begins"))], orders)


def counts_of_strings(lines: DataFrame, strings: DataFrame, orders: list[int]) -> DataFrame:
    """Counts of the n-grams whose words, joined by blanks, are a row of ``strings`` (one column)."""
    wanted = stored(strings.dropna().distinct())
    return counted_where(lines, [asked_twice(wanted, whole_gram())], orders)
