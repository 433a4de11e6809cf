"""Registered queries: cleaning, file statistics, frequencies, tf-idf, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import clean as C
from ..operators import counts as A
from ..operators import ranking as W
from ..operators import tokenize as tk
from ..sources import corpus as src
from . import sqltext as S
from .registry import query

GREP_WORD = "hate"
RATIO_WORDS = ("that", "than")
HIST_BINS = 30
BASE_SOURCE = "src0"


def r10(c):
    return F.round(c, 10) + F.lit(0.0)


def R10(e: str) -> str:
    return f"round({e}, 10) + 0.0"


STOP_SQL = "(" + ", ".join(S.q(w) for w in T.STOP_WORDS) + ")"
STOP_LIST_SQL = "[" + ", ".join(S.q(w) for w in T.STOP_WORDS) + "]"
# DuckDB spelling of Java's Unicode-aware \W (letters, marks, letter numbers,
# decimal digits, connector punctuation and the two join controls are word
# characters).
CLEAN_TEXT_DUCK = T.CLEAN_TEXT_PATTERN.replace(
    r"^[0-9\W]+$", r"^(?:[0-9]|[^\p{L}\p{M}\p{Nl}\p{Nd}\p{Pc}\x{200C}\x{200D}])+$"
)


def lines(spark, sf):
    return src.corpus_lines(spark, sf)


# ---------------------------------------------------------------------------
# Shared token tables and their SQL twins
# ---------------------------------------------------------------------------
def lines_from(spark, sf):
    """Lines with ``from`` (computed once per line, before any explode)."""
    return lines(spark, sf).withColumn("from", T.source_name(F.col("file")))


def tok_corpora(spark, sf):
    """Words of every line without stop words, with ``from``."""
    w = tk.line_words(lines_from(spark, sf), keep=("doc_id", "line_no", "file", "from"))
    return C.remove_stop_words(w)


TOK_CTE = (
    f"{S.lines_cte()}, w_src AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS ws FROM doc_lines), "
    f"w_all AS (SELECT doc_id, line_no, file, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS word_no, "
    f"unnest(ws) AS word FROM w_src), "
    f"tok AS (SELECT *, file AS \"from\" FROM w_all WHERE word NOT IN {STOP_SQL})"
)


def line_grams_nostop(spark, sf, n):
    g = tk.line_ngrams(lines_from(spark, sf), n, keep=("doc_id", "line_no", "file", "from"))
    return C.drop_stop_word_ngrams(g, "ngram")


def grams_nostop_cte(n: int, name: str) -> str:
    return (
        f"{name}_w AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS tokens FROM doc_lines), "
        f"{S.grams_cte(name + '_w', name + '_g', n, n, keep='doc_id, line_no, file')}, "
        f"{name} AS (SELECT doc_id, line_no, file, pos, begins || ' ' || ends AS ngram, file AS \"from\" "
        f"FROM {name}_g WHERE NOT list_has_any(string_split(begins || ' ' || ends, ' '), {STOP_LIST_SQL}))"
    )


# ---------------------------------------------------------------------------
# C1-C13 cleaning
# ---------------------------------------------------------------------------
PAGE_LINES_CTE = (
    f"p_src AS (SELECT page_id AS doc_id, url AS file, string_split(html, {S.NL}) AS parts FROM pages), "
    f"p_lines AS (SELECT doc_id, file, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, "
    f"unnest(parts) AS text FROM p_src)"
)


@query(
    "clean_text",
    f"WITH {PAGE_LINES_CTE} SELECT doc_id, line_no, text FROM p_lines "
    f"WHERE NOT regexp_matches(text, {S.q(CLEAN_TEXT_DUCK)})",
)
def clean_text_q(spark, sf):
    pl = src.page_lines(src.table(spark, sf, "pages"))
    return C.clean_text(pl).select("doc_id", "line_no", "text")


@query(
    "clean_text_v1",
    f"WITH {S.lines_cte()} SELECT doc_id, line_no, regexp_replace(text, 'ø', '') AS text FROM doc_lines "
    f"WHERE NOT regexp_matches(text, {S.q(T.CLEAN_TEXT_V1_PATTERN)})",
)
def clean_text_v1_q(spark, sf):
    return C.clean_text_v1(lines(spark, sf)).select("doc_id", "line_no", "text")


_CLEAN_FILES_SQL = (
    "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
    "regexp_replace(replace(text, chr(0), ' '), '[^\\x00-\\x7F]|[\\x01\\x1A0-9]', '', 'g'), "
    "'__bos__ ', '', 'g'), ' __eos__', '', 'g'), '__unk__', '', 'g'), chr(127), '', 'g'), '', '', 'g')"
)


@query("clean_files", f"SELECT doc_id, {_CLEAN_FILES_SQL} AS text FROM documents")
def clean_files_q(spark, sf):
    docs = src.table(spark, sf, "documents").select("doc_id", "text")
    return C.clean_files(src.spread(docs, src.spread_setting(spark), "doc_id"))


@query(
    "basic_clean",
    f"WITH {S.lines_cte()} SELECT doc_id, line_no, {S.basic_clean_sql('text')} AS text FROM doc_lines",
)
def basic_clean_q(spark, sf):
    return C.basic_clean(lines(spark, sf)).select("doc_id", "line_no", "text")


@query(
    "strip_numeric_prefix",
    f"WITH {S.lines_cte()}, s AS (SELECT doc_id, line_no, "
    f"regexp_replace(text, {S.q(T.NUMERIC_PREFIX_PATTERN)}, '', 'g') AS text FROM doc_lines) "
    f"SELECT * FROM s WHERE text <> ''",
)
def strip_numeric_prefix_q(spark, sf):
    return C.strip_numeric_prefix(lines(spark, sf)).select("doc_id", "line_no", "text")


@query(
    "clean_tokens",
    f"WITH {TOK_CTE}, c AS (SELECT \"from\", nullif(regexp_extract(word, {S.q(T.TOKEN_KEEP_PATTERN)}, 0), '') AS word "
    f"FROM tok WHERE NOT regexp_matches(word, {S.q(T.TOKEN_REJECT_PATTERN)})) "
    f"SELECT \"from\", word, count(*) AS word_count FROM c GROUP BY ALL",
)
def clean_tokens_q(spark, sf):
    t = C.clean_tokens(tok_corpora(spark, sf))
    return A.count_by(t, ["from", "word"], "word_count")


@query("source_name", "SELECT DISTINCT source AS file, source AS \"from\" FROM documents")
def source_name_q(spark, sf):
    d = src.table(spark, sf, "documents").select(F.col("source").alias("file")).distinct()
    return d.withColumn("from", T.source_name(F.col("file")))


@query("tokens_no_stopwords", f"WITH {TOK_CTE} SELECT doc_id, line_no, word_no, word FROM tok")
def tokens_no_stopwords(spark, sf):
    return tok_corpora(spark, sf).select("doc_id", "line_no", "word_no", "word")


@query(
    "bigrams_no_stopwords",
    f"WITH {S.lines_cte()}, {grams_nostop_cte(2, 'bg')} SELECT doc_id, line_no, pos, ngram FROM bg",
)
def bigrams_no_stopwords(spark, sf):
    return line_grams_nostop(spark, sf, 2).select("doc_id", "line_no", "pos", "ngram")


@query(
    "trigrams_no_stopwords",
    f"WITH {S.lines_cte()}, {grams_nostop_cte(3, 'tg')} SELECT doc_id, line_no, pos, ngram FROM tg",
)
def trigrams_no_stopwords(spark, sf):
    return line_grams_nostop(spark, sf, 3).select("doc_id", "line_no", "pos", "ngram")


@query(
    "grep_lines",
    f"WITH {S.lines_cte()} SELECT doc_id, line_no, file, text FROM doc_lines WHERE contains(text, {S.q(GREP_WORD)})",
)
def grep_lines_q(spark, sf):
    return C.grep_lines(lines(spark, sf), GREP_WORD).select("doc_id", "line_no", "file", "text")


@query(
    "phrase_line_count",
    f"WITH {S.lines_cte()} SELECT file, CAST(sum(CAST(contains(text, {S.q(GREP_WORD)}) AS INTEGER)) AS BIGINT) AS n_0 "
    f"FROM doc_lines GROUP BY file",
)
def phrase_line_count(spark, sf):
    return C.lines_with_counts(lines(spark, sf), [GREP_WORD], ["file"])


@query(
    "love_hate_ratio",
    f"WITH {S.lines_cte()}, c AS (SELECT file, "
    f"CAST(sum(CAST(contains(text, {S.q(RATIO_WORDS[0])}) AS INTEGER)) AS BIGINT) AS n_0, "
    f"CAST(sum(CAST(contains(text, {S.q(RATIO_WORDS[1])}) AS INTEGER)) AS BIGINT) AS n_1 "
    f"FROM doc_lines GROUP BY file) "
    f"SELECT file, n_0, n_1, {R10('n_0 / nullif(n_1, 0)')} AS ratio FROM c",
)
def love_hate_ratio(spark, sf):
    c = C.lines_with_counts(lines(spark, sf), list(RATIO_WORDS), ["file"])
    return c.withColumn("ratio", r10(F.try_divide(F.col("n_0"), F.col("n_1"))))


# ---------------------------------------------------------------------------
# S11 / S12 file statistics
# ---------------------------------------------------------------------------
@query(
    "file_stats",
    f"WITH {S.lines_cte(lang='en')}, s AS (SELECT file AS file_name, count(*) AS nl_count, "
    f"CAST(sum(len(regexp_extract_all(text, {S.q(T.NON_BLANK_PATTERN + '+')}))) AS BIGINT) AS word_count, "
    f"CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS byte_count FROM doc_lines GROUP BY file) "
    f"SELECT *, format('{{:,}}', byte_count) AS byte_count_label FROM s",
)
def file_stats(spark, sf):
    ls = src.corpus_lines(spark, sf, lang="en")
    s = ls.groupBy(F.col("file").alias("file_name")).agg(
        F.count(F.lit(1)).alias("nl_count"),
        F.sum(F.regexp_count(F.col("text"), F.lit(T.NON_BLANK_PATTERN + "+"))).cast("bigint").alias("word_count"),
        F.sum(F.octet_length("text") + 1).cast("bigint").alias("byte_count"),
    )
    return s.withColumn("byte_count_label", F.format_number(F.col("byte_count"), 0))


@query(
    "longest_line",
    f"WITH {S.lines_cte()} SELECT file, CAST(max(length(text)) AS INTEGER) AS max_chars FROM doc_lines GROUP BY file",
)
def longest_line(spark, sf):
    return lines(spark, sf).groupBy("file").agg(F.max(F.length("text")).alias("max_chars"))


# ---------------------------------------------------------------------------
# A4-A12 frequencies
# ---------------------------------------------------------------------------
@query(
    "word_count_by_source",
    f"WITH {TOK_CTE} SELECT \"from\", word, count(*) AS n FROM tok GROUP BY ALL",
)
def word_count_by_source(spark, sf):
    return A.count_by(tok_corpora(spark, sf), ["from", "word"], "n")


@query(
    "word_totals",
    f"WITH {TOK_CTE}, c AS (SELECT \"from\", word, count(*) AS n FROM tok GROUP BY ALL) "
    f"SELECT \"from\", word, n, CAST(sum(n) OVER (PARTITION BY \"from\") AS BIGINT) AS total FROM c",
)
def word_totals(spark, sf):
    c = A.count_by(tok_corpora(spark, sf), ["from", "word"], "n")
    return A.attach_totals(c, ["from"], "n", "total")


def _freq_sql(table_cte: str, table: str, col: str, grouped: bool = True) -> str:
    g = "\"from\", " if grouped else ""
    part = "PARTITION BY \"from\"" if grouped else ""
    return (
        f"WITH {table_cte}, c AS (SELECT {g}{col}, count(*) AS {col}_count FROM {table} GROUP BY ALL) "
        f"SELECT {g}{col}, {col}_count, CAST(sum({col}_count) OVER ({part}) AS BIGINT) AS total_{col}, "
        f"{R10(f'{col}_count / sum({col}_count) OVER ({part})')} AS {col}_freq FROM c"
    )


def _freq(df, col, grouped=True):
    f = A.calc_frequency(df, col, ["from"] if grouped else [])
    return f.withColumn(f"{col}_freq", r10(F.col(f"{col}_freq")))


@query("word_freq", _freq_sql(TOK_CTE, "tok", "word"))
def word_freq(spark, sf):
    return _freq(tok_corpora(spark, sf), "word")


@query("word_freq_global", _freq_sql(TOK_CTE, "tok", "word", grouped=False))
def word_freq_global(spark, sf):
    return _freq(tok_corpora(spark, sf), "word", grouped=False)


def _bigram_tbl(spark, sf):
    return line_grams_nostop(spark, sf, 2).withColumnRenamed("ngram", "bigram")


def _trigram_tbl(spark, sf):
    return line_grams_nostop(spark, sf, 3).withColumnRenamed("ngram", "trigram")


BG_CTE = f"{S.lines_cte()}, {grams_nostop_cte(2, 'bg0')}, bg AS (SELECT *, ngram AS bigram FROM bg0)"
TG_CTE = f"{S.lines_cte()}, {grams_nostop_cte(3, 'tg0')}, tg AS (SELECT *, ngram AS trigram FROM tg0)"


@query("bigram_freq", _freq_sql(BG_CTE, "bg", "bigram"))
def bigram_freq(spark, sf):
    return _freq(_bigram_tbl(spark, sf), "bigram")


@query("trigram_freq", _freq_sql(TG_CTE, "tg", "trigram"))
def trigram_freq(spark, sf):
    return _freq(_trigram_tbl(spark, sf), "trigram")


@query(
    "bigram_log_freq",
    f"WITH {S.lines_cte()}, w AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS tokens FROM doc_lines), "
    f"{S.grams_cte('w', 'g', 2, 2)}, c AS (SELECT begins || ' ' || ends AS ngram, count(*) AS ngram_count FROM g GROUP BY ALL) "
    f"SELECT ngram, ngram_count, {R10('ngram_count / sum(ngram_count) OVER ()')} AS ngram_freq, "
    f"{R10('ln(ngram_count / sum(ngram_count) OVER ())')} AS ngram_log, "
    f"split_part(ngram, ' ', 1) AS word_1, split_part(ngram, ' ', 2) AS word_2 FROM c",
)
def bigram_log_freq(spark, sf):
    g = tk.line_ngrams(lines(spark, sf), 2)
    c = A.attach_totals(A.count_by(g, ["ngram"], "ngram_count"), [], "ngram_count", "_tot")
    parts = F.split("ngram", " ")
    return c.select(
        "ngram", "ngram_count",
        r10(F.col("ngram_count") / F.col("_tot")).alias("ngram_freq"),
        r10(F.ln(F.col("ngram_count") / F.col("_tot"))).alias("ngram_log"),
        F.element_at(parts, 1).alias("word_1"), F.element_at(parts, 2).alias("word_2"),
    )


@query(
    "positional_word_counts",
    f"WITH {S.lines_cte()}, w AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS tokens FROM doc_lines), "
    f"{S.grams_cte('w', 'g', 3, 3)}, c AS (SELECT begins || ' ' || ends AS ngram, count(*) AS ngram_count FROM g GROUP BY ALL), "
    f"s AS (SELECT ngram, ngram_count, split_part(ngram, ' ', 1) AS word1, split_part(ngram, ' ', 2) AS word2, "
    f"split_part(ngram, ' ', 3) AS word3 FROM c) "
    f"SELECT *, count(*) OVER (PARTITION BY word1) AS word1_count, count(*) OVER (PARTITION BY word2) AS word2_count, "
    f"count(*) OVER (PARTITION BY word3) AS word3_count FROM s",
)
def positional_word_counts(spark, sf):
    g = tk.line_ngrams(lines(spark, sf), 3)
    c = A.count_by(g, ["ngram"], "ngram_count")
    return A.positional_counts(c, "ngram", 3)


@query(
    "source_vs_others",
    f"WITH {TOK_CTE}, c AS (SELECT \"from\", word, count(*) AS n FROM tok GROUP BY ALL), "
    f"p AS (SELECT \"from\", word, n / sum(n) OVER (PARTITION BY \"from\") AS proportion FROM c), "
    f"b AS MATERIALIZED (SELECT word, proportion FROM p WHERE \"from\" = {S.q(BASE_SOURCE)}), "
    f"o AS MATERIALIZED (SELECT * FROM p WHERE \"from\" <> {S.q(BASE_SOURCE)}) "
    f"SELECT o.word, {R10('b.proportion')} AS base, o.\"from\" AS origin, {R10('o.proportion')} AS proportion "
    f"FROM o LEFT JOIN b USING (word)",
)
def source_vs_others(spark, sf):
    c = A.source_against_others(tok_corpora(spark, sf), "from", "word", BASE_SOURCE)
    return c.select("word", r10(F.col("base")).alias("base"), "origin", r10(F.col("proportion")).alias("proportion"))


@query(
    "freq_histogram",
    f"WITH {TOK_CTE}, c AS (SELECT \"from\", word, count(*) AS n FROM tok GROUP BY ALL), "
    f"f AS (SELECT \"from\", n / sum(n) OVER (PARTITION BY \"from\") AS freq FROM c), "
    f"b AS (SELECT \"from\", CAST(least(floor(freq * {HIST_BINS} / (SELECT max(freq) FROM f)), {HIST_BINS - 1}) AS BIGINT) AS bin FROM f) "
    f"SELECT \"from\", bin, count(*) AS n_words FROM b GROUP BY ALL",
)
def freq_histogram(spark, sf):
    c = A.count_by(tok_corpora(spark, sf), ["from", "word"], "n")
    return A.frequency_histogram(c, "from", "n", HIST_BINS)


def _tfidf_sql(table_cte: str, table: str, col: str) -> str:
    return (
        f"WITH {table_cte}, c AS (SELECT \"from\", {col}, count(*) AS {col}_count FROM {table} GROUP BY ALL), "
        f"d AS (SELECT *, sum({col}_count) OVER (PARTITION BY \"from\") AS dt, count(*) OVER (PARTITION BY {col}) AS td, "
        f"(SELECT count(DISTINCT \"from\") FROM c) AS nd FROM c) "
        f"SELECT \"from\", {col}, {col}_count, {R10(f'{col}_count / dt')} AS tf, {R10('ln(nd / td)')} AS idf, "
        f"{R10(f'({col}_count / dt) * ln(nd / td)')} AS tf_idf FROM d"
    )


def _tfidf(df, col):
    df = df.filter(F.col("from").isNotNull() & F.col(col).isNotNull())
    # dealt out by the term: its counts and its number of sources need no other exchange
    c = A.count_by(df.select("from", col).repartition(col), ["from", col], f"{col}_count")
    t = A.tf_idf(c, col, "from", f"{col}_count", A.group_totals(df, ["from"], "_doc_total"))
    return t.select("from", col, f"{col}_count", *[r10(F.col(x)).alias(x) for x in ("tf", "idf", "tf_idf")])


@query("tf_idf_word", _tfidf_sql(TOK_CTE, "tok", "word"))
def tf_idf_word(spark, sf):
    return _tfidf(tok_corpora(spark, sf), "word")


@query("tf_idf_bigram", _tfidf_sql(BG_CTE, "bg", "bigram"))
def tf_idf_bigram(spark, sf):
    return _tfidf(_bigram_tbl(spark, sf), "bigram")


@query("tf_idf_trigram", _tfidf_sql(TG_CTE, "tg", "trigram"))
def tf_idf_trigram(spark, sf):
    return _tfidf(_trigram_tbl(spark, sf), "trigram")


# ---------------------------------------------------------------------------
# W1 / W2 top-k per source
# ---------------------------------------------------------------------------
@query(
    "top10_words",
    f"WITH {TOK_CTE}, c AS (SELECT file, word, count(*) AS n FROM tok "
    f"WHERE NOT regexp_matches(word, {S.q(T.TOP_WORD_REJECT_PATTERN)}) GROUP BY ALL), "
    f"r AS (SELECT *, rank() OVER (PARTITION BY file ORDER BY n DESC) AS rk FROM c) "
    f"SELECT file, word, n FROM r WHERE rk <= 10",
)
def top10_words(spark, sf):
    t = tok_corpora(spark, sf).filter(~F.col("word").rlike(T.TOP_WORD_REJECT_PATTERN))
    c = A.count_by(t, ["file", "word"], "n")
    return W.top_k(c, ["file"], [F.col("n").desc()], 10, ties=True)


def _top_tfidf_sql(table_cte, table, col, pattern):
    inner = _tfidf_sql(table_cte, table, col)
    return (
        f"WITH t AS ({inner}), f AS (SELECT * FROM t WHERE NOT regexp_matches({col}, {S.q(pattern)})), "
        f"r AS (SELECT *, rank() OVER (PARTITION BY \"from\" ORDER BY tf_idf DESC) AS rk FROM f) "
        f"SELECT \"from\", {col}, {col}_count, tf, idf, tf_idf FROM r WHERE rk <= 20"
    )


def _top_tfidf(df, col, pattern):
    t = _tfidf(df, col).filter(~F.col(col).rlike(pattern))
    return W.top_k(t, ["from"], [F.col("tf_idf").desc()], 20, ties=True)


WORD_STOP = r"^amazon\..*$"


@query("top_tfidf_word", _top_tfidf_sql(TOK_CTE, "tok", "word", WORD_STOP))
def top_tfidf_word(spark, sf):
    return _top_tfidf(tok_corpora(spark, sf), "word", WORD_STOP)


@query("top_tfidf_bigram", _top_tfidf_sql(BG_CTE, "bg", "bigram", T.NGRAM_STOP_PATTERN))
def top_tfidf_bigram(spark, sf):
    return _top_tfidf(_bigram_tbl(spark, sf), "bigram", T.NGRAM_STOP_PATTERN)


@query("top_tfidf_trigram", _top_tfidf_sql(TG_CTE, "tg", "trigram", T.NGRAM_STOP_PATTERN))
def top_tfidf_trigram(spark, sf):
    return _top_tfidf(_trigram_tbl(spark, sf), "trigram", T.NGRAM_STOP_PATTERN)


def _top20_sql(table_cte, table, col, pattern=None):
    inner = _freq_sql(table_cte, table, col)
    where = f"WHERE NOT regexp_matches({col}, {S.q(pattern)})" if pattern else ""
    return (
        f"WITH t AS ({inner}), f AS (SELECT * FROM t {where}), "
        f"r AS (SELECT *, row_number() OVER (PARTITION BY \"from\" ORDER BY {col}_freq DESC, {col}) AS rk FROM f) "
        f"SELECT \"from\", {col}, {col}_count, total_{col}, {col}_freq FROM r WHERE rk <= 20"
    )


def _top20(df, col, pattern=None):
    f = _freq(df, col)
    if pattern:
        f = C.drop_ngram_patterns(f, col, pattern)
    return W.top_k(f, ["from"], [F.col(f"{col}_freq").desc(), F.col(col)], 20)


@query("top20_words", _top20_sql(TOK_CTE, "tok", "word"))
def top20_words(spark, sf):
    return _top20(tok_corpora(spark, sf), "word")


@query("top20_bigrams", _top20_sql(BG_CTE, "bg", "bigram"))
def top20_bigrams(spark, sf):
    return _top20(_bigram_tbl(spark, sf), "bigram")


@query("top20_trigrams", _top20_sql(TG_CTE, "tg", "trigram", T.TOP_TRIGRAM_STOP_PATTERN))
def top20_trigrams(spark, sf):
    return _top20(_trigram_tbl(spark, sf), "trigram", T.TOP_TRIGRAM_STOP_PATTERN)


# --- C7 the second notebook's filters before the twenty most frequent ---
@query("top20_words_no_digits", _top20_sql(TOK_CTE, "tok", "word", T.WORD_DIGIT_PATTERN))
def top20_words_no_digits(spark, sf):
    return _top20(tok_corpora(spark, sf), "word", T.WORD_DIGIT_PATTERN)


@query("top20_bigrams_filtered", _top20_sql(BG_CTE, "bg", "bigram", T.BIGRAM_STOP_PATTERN))
def top20_bigrams_filtered(spark, sf):
    return _top20(_bigram_tbl(spark, sf), "bigram", T.BIGRAM_STOP_PATTERN)


@query("top20_trigrams_filtered", _top20_sql(TG_CTE, "tg", "trigram", T.TRIGRAM_STOP_PATTERN))
def top20_trigrams_filtered(spark, sf):
    return _top20(_trigram_tbl(spark, sf), "trigram", T.TRIGRAM_STOP_PATTERN)
