"""Line and token cleaning.

All filters are column expressions (``rlike``, ``isin``) evaluated inside the
scan stage; the stop-word list is a literal ``InSet``, so removing stop words
needs no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def clean_text(df: DataFrame, colname: str = "text", pattern: str = T.CLEAN_TEXT_PATTERN) -> DataFrame:
    """Drop rows whose text is junk (numbers/punctuation only, rt, lol,
    underscores, number runs, html ``class=``/``style=``).  NULL text is
    dropped too, as in a filter on NA."""
    return df.filter(~T.is_junk_line(F.col(colname), pattern))


def clean_text_v1(df: DataFrame, colname: str = "text") -> DataFrame:
    """Earlier variant; also removes the first ``ø`` of each kept line."""
    kept = clean_text(df, colname, T.CLEAN_TEXT_V1_PATTERN)
    return kept.withColumn(colname, T.strip_first(F.col(colname), "ø"))


def clean_files(df: DataFrame, colname: str = "text") -> DataFrame:
    """Whole-text cleaning of ``clean_files`` applied per row."""
    return df.withColumn(colname, T.clean_file_text(F.col(colname)))


def basic_clean(df: DataFrame, colname: str = "text") -> DataFrame:
    """C4 ``basic_clean_text``."""
    return df.withColumn(colname, T.basic_clean(F.col(colname)))


def strip_numeric_prefix(df: DataFrame, colname: str = "text") -> DataFrame:
    """Remove underscore-only lines and leading number runs, drop empty."""
    out = df.withColumn(colname, F.regexp_replace(F.col(colname), T.NUMERIC_PREFIX_PATTERN, ""))
    return out.filter(F.col(colname) != "")


def clean_tokens(tokens: DataFrame, colname: str = "word") -> DataFrame:
    """Drop number / contraction / rt / lol / underscore tokens, then keep
    the first ``[a-z']+`` run of each token (NULL when there is none)."""
    kept = tokens.filter(~F.col(colname).rlike(T.TOKEN_REJECT_PATTERN))
    return kept.withColumn(
        colname, F.nullif(F.regexp_extract(F.col(colname), T.TOKEN_KEEP_PATTERN, 0), F.lit(""))
    )


def drop_ngram_patterns(df: DataFrame, colname: str, pattern: str = T.NGRAM_STOP_PATTERN) -> DataFrame:
    """Drop n-grams matching a stop pattern."""
    return df.filter(~F.col(colname).rlike(pattern))


def remove_stop_words(tokens: DataFrame, colname: str = "word",
                      stop_words: list[str] = T.STOP_WORDS) -> DataFrame:
    """C9 ``anti_join(stop_words)`` as an ``InSet`` filter on a fixed list."""
    return tokens.filter(~F.col(colname).isin(stop_words))


def drop_stop_word_ngrams(ngrams: DataFrame, colname: str = "ngram",
                          stop_words: list[str] = T.STOP_WORDS) -> DataFrame:
    """Drop an n-gram when any of its words is a stop word."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    return ngrams.filter(~F.arrays_overlap(F.split(F.col(colname), " "), stops))


def grep_lines(lines: DataFrame, literal: str, colname: str = "text") -> DataFrame:
    """Lines containing a literal string."""
    return lines.filter(F.col(colname).contains(literal))


def lines_with_counts(lines: DataFrame, literals: list[str], by: list[str],
                      colname: str = "text") -> DataFrame:
    """Per group, the number of lines containing each literal
    (``n_<i>``), in one pass."""
    aggs = [
        F.sum(F.col(colname).contains(lit_).cast("bigint")).alias(f"n_{i}")
        for i, lit_ in enumerate(literals)
    ]
    return lines.groupBy(*by).agg(*aggs)
