"""Counts, frequencies and tf-idf.

Per-group totals are an aggregate joined back on the group key rather than a
window ``sum() over (partition by group)``: a window sends every row of a
group to one task, which a source holding a third of the corpus would
overload.  The totals side has one row per group; adaptive execution turns
the join into a broadcast once that side is measured small.  It splits a
skewed partition only between two plain shuffles, not beside an aggregate on
the join key; where a single key can be hot and the totals are many, they are
written out before the join (``positional_counts``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import relabel


def count_by(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """``count(keys)`` -> one row per key with ``name`` (bigint)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def attach_totals(df: DataFrame, group: list[str], value: str, total: str) -> DataFrame:
    """Add ``total = sum(value)`` of the row's group (whole table when
    ``group`` is empty: a one-row aggregate, cross-joined as a broadcast)."""
    if not group:
        tot = df.agg(F.sum(value).cast("bigint").alias(total))
        return df.crossJoin(F.broadcast(tot))
    tot = df.groupBy(*group).agg(F.sum(value).cast("bigint").alias(total))
    return df.join(tot, on=group, how="inner")


def calc_frequency(df: DataFrame, colname: str, group: list[str] | None = None) -> DataFrame:
    """A6 ``calc_frequency``: per (group, value) ``{col}_count``, the group's
    row total ``total_{col}`` and ``{col}_freq = count / total``."""
    group = group or []
    counts = count_by(df, [*group, colname], f"{colname}_count")
    total = f"total_{colname}"
    if group:
        # counted from the rows and written out first, so that its size is known before the join:
        # a few groups are broadcast, and no count moves to its group's task
        out = counts.join(group_totals(df, group, total), on=group, how="inner")
    else:
        out = attach_totals(counts, group, f"{colname}_count", total)
    return out.withColumn(f"{colname}_freq", F.col(f"{colname}_count") / F.col(total))


def group_totals(df: DataFrame, group: list[str], total: str) -> DataFrame:
    """Rows of each group (a row a group), written out."""
    return stored(count_by(df, group, total))


def tf_idf(freq: DataFrame, term: str, document: str, n: str, doc_totals: DataFrame | None = None) -> DataFrame:
    """A11 ``bind_tf_idf``: ``tf = n / sum(n)`` per document,
    ``idf = ln(#documents / #documents with the term)``, ``tf_idf = tf*idf``.

    ``doc_totals`` (document, ``_doc_total``; default: the sums of ``freq``) is joined by
    document; written out before, a few documents are broadcast.  A term's documents are
    counted where its rows lie: ``freq`` dealt out by the term is not moved.  The number of
    documents is counted from the totals and cross-joined as a one-row broadcast.
    Rows with a NULL term or document are dropped up front."""
    freq = freq.filter(F.col(term).isNotNull() & F.col(document).isNotNull())
    doc_tot = freq.groupBy(document).agg(F.sum(n).alias("_doc_total")) if doc_totals is None else doc_totals
    term_docs = F.count(F.when(F.col(n) > 0, F.lit(1))).over(Window.partitionBy(term))
    n_docs = doc_tot.agg(F.count("_doc_total").alias("_n_docs"))
    out = freq.withColumn("_term_docs", term_docs).join(doc_tot, document).crossJoin(F.broadcast(n_docs))
    tf = F.col(n) / F.col("_doc_total")
    idf = F.ln(F.col("_n_docs") / F.col("_term_docs"))
    return out.select(*freq.columns, tf.alias("tf"), idf.alias("idf"), (tf * idf).alias("tf_idf"))


def positional_counts(ngrams: DataFrame, colname: str, order: int) -> DataFrame:
    """A8 ``separate_and_count``: split an n-gram column into ``word1..n``
    and, for each position, the number of rows sharing that word.

    The rows are written out once; all positions are counted in one pass and joined back on
    their words, which are taken from the n-gram where they are needed and move with nobody.
    A table of bounded size holds the counts of the most frequent words: n-grams of
    such words alone do not move for the joins."""
    names = ["word"] if order == 1 else [f"word{i}" for i in range(1, order + 1)]
    rows = stored(ngrams)
    word = [F.element_at(F.split(F.col(colname), " "), i + 1) for i in range(order)]
    # written out, so that a hot word is split between two plain shuffles
    totals = stored(rows.select(F.posexplode(F.array(*word)).alias("_i", "_w")).groupBy("_i", "_w").agg(F.count(F.lit(1)).alias("_c")))
    # of each word its count at every position, and all its rows
    at = [F.sum(F.when(F.col("_i") == i, F.col("_c"))).alias(f"_c{i}") for i in range(order)]
    of_word = totals.dropna(subset=["_w"]).groupBy("_w").agg(*at, F.sum("_c").alias("times"))
    slots = relabel.frequent_labels(of_word.select(
        F.col("_w").alias("word"), F.struct(*[f"_c{i}" for i in range(order)]).alias("label"), "times"))
    held = [relabel.held_label(slots, w)[f"_c{i}"] for i, w in enumerate(word)]
    rows = rows.select("*", *[h.alias(f"{nm}_count") for h, nm in zip(held, names)])
    whole = reduce(lambda a, b: a & b, [F.col(f"{nm}_count").isNotNull() for nm in names])
    known, out, first = rows.filter(whole), rows.filter(~whole).select(*ngrams.columns), []
    for i, nm in enumerate(names):
        c = totals.filter(F.col("_i") == i).select(F.col("_w").alias(f"_w{i}"), F.col("_c").alias(f"{nm}_count"))
        out = out.join(c, word[i] == F.col(f"_w{i}"), "left").drop(f"_w{i}")
        first.insert(0, nm)
    columns = {nm: word[i].alias(nm) for i, nm in enumerate(names)}
    wanted = [*[columns[nm] for nm in first], *ngrams.columns, *[f"{nm}_count" for nm in names]]
    return known.select(*wanted).unionByName(out.select(*wanted))


def log_space_product(values: Column) -> tuple[Column, Column]:
    """(sum of logs, product via exp of that sum) of an aggregated column."""
    lp = F.sum(F.ln(values))
    return lp, F.exp(lp)


def source_against_others(tokens: DataFrame, source: str, term: str, base: str) -> DataFrame:
    """(term, base, origin, proportion): the proportion of each term in every
    source but ``base``, beside its proportion in ``base`` (NULL if not there)."""
    c = count_by(tokens, [source, term], "n")
    p = attach_totals(c, [source], "n", "_total").select(
        F.col(source).alias("origin"), term, (F.col("n") / F.col("_total")).alias("proportion"))
    b = p.filter(F.col("origin") == base).select(term, F.col("proportion").alias("base"))
    return p.filter(F.col("origin") != base).join(b, term, "left").select(term, "base", "origin", "proportion")


def frequency_histogram(counts: DataFrame, source: str, n: str, bins: int = 30, top: float | None = None) -> DataFrame:
    """A10: how many terms of each source have a frequency ``n / total`` in each
    of ``bins`` equal bins from 0 to ``top`` (default: the largest frequency;
    with ``top``, terms above it are left out as beyond the axis)."""
    f = attach_totals(counts, [source], n, "_total").withColumn("freq", F.col(n) / F.col("_total"))
    if top is None:
        f = f.crossJoin(F.broadcast(f.agg(F.max("freq").alias("_top"))))  # one row
    else:
        f = f.filter(F.col("freq") <= top).withColumn("_top", F.lit(float(top)))
    place = F.floor(F.col("freq") * bins / F.col("_top"))
    return f.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("bigint")).groupBy(source, "bin").agg(
        F.count(F.lit(1)).alias("n_words"))
