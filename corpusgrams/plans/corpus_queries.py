"""Registered queries: corpus build (sources, sentences, tokens, n-gram counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ranking, tokenize as tk
from ..sources import corpus as src
from ..sources import textlines
from . import sqltext as S
from .registry import query

ORDER_NAMES = {1: "onegram", 2: "twogram", 3: "threegram", 4: "fourgram", 5: "fivegram"}
PRUNE_K = 5


def lines(spark, sf):
    return src.corpus_lines(spark, sf)


def model(spark, sf, min_order=1, max_order=5):
    return tk.ngram_counts(lines(spark, sf), min_order, max_order)


# --- S1 read_lines ----------------------------------------------------------
@query("read_lines", f"WITH {S.lines_cte()} SELECT doc_id, line_no, file, text FROM doc_lines")
def read_lines(spark, sf):
    return lines(spark, sf).select("doc_id", "line_no", "file", "text")


# --- S1 on text files: line numbers from splits --------------------------------
@query(
    "text_file_lines",
    f"WITH {S.lines_cte()} SELECT file, CAST(row_number() OVER (PARTITION BY file ORDER BY doc_id, line_no) - 1 AS BIGINT) "
    f"AS line_no, text FROM doc_lines WHERE file IS NOT NULL",
)
def text_file_lines(spark, sf):
    """``documents`` written as text files and read again, numbered."""
    import uuid

    from ..session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark)}/text-{uuid.uuid4().hex}"
    textlines.write_lines(lines(spark, sf).filter("file IS NOT NULL"), path, ["doc_id", "line_no"])
    folder = r"url_decode(regexp_extract(_path, '/file=([^/]*)/', 1))"
    return textlines.number_lines(spark, path, "*.txt", "\n", whole_file=folder)


# --- T1 / T2 sentences -------------------------------------------------------
@query(
    "sentences",
    f"WITH {S.lines_cte()}, {S.sentences_cte()} "
    f"SELECT doc_id, line_no, sent_no, '{T.TOKEN_BOS} ' || text || ' {T.TOKEN_EOS}' AS sentence FROM sents",
)
def sentences_q(spark, sf):
    s = tk.sentences(lines(spark, sf))
    return s.select("doc_id", "line_no", "sent_no", tk.annotated(F.col("text")).alias("sentence"))


@query(
    "sentences_by_source",
    f"WITH {S.lines_cte()}, {S.sentences_cte()} "
    f"SELECT file, count(*) AS n_sentences, CAST(sum(len(text)) AS BIGINT) AS n_chars FROM sents GROUP BY file",
)
def sentences_by_source(spark, sf):
    s = tk.sentences(lines(spark, sf))
    return s.groupBy("file").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.sum(F.length("text")).cast("bigint").alias("n_chars")
    )


# --- T4 tokens ----------------------------------------------------------------
@query(
    "tokens",
    f"WITH {S.lines_cte()}, "
    f"w AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS ws FROM doc_lines) "
    f"SELECT doc_id, line_no, file, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS word_no, unnest(ws) AS word FROM w",
)
def tokens_q(spark, sf):
    return tk.line_words(lines(spark, sf))


# --- T5 bigrams / trigrams per line (no markers) --------------------------------
def _line_ngram_oracle(n: int) -> str:
    return (
        f"WITH {S.lines_cte()}, w AS (SELECT doc_id, line_no, file, {S.words_sql('text')} AS tokens FROM doc_lines), "
        f"{S.grams_cte('w', 'g', n, n, keep='doc_id, line_no, file')} "
        f"SELECT doc_id, line_no, file, pos, begins || ' ' || ends AS ngram FROM g"
    )


@query("bigrams", _line_ngram_oracle(2))
def bigrams_q(spark, sf):
    return tk.line_ngrams(lines(spark, sf), 2)


@query("trigrams", _line_ngram_oracle(3))
def trigrams_q(spark, sf):
    return tk.line_ngrams(lines(spark, sf), 3)


# --- T6 n-grams of one order with markers ------------------------------------------
@query(
    "ngrams_order_n",
    f"WITH {S.corpus_ctes(with_grams=None)}, {S.grams_cte('toks', 'grams', 3, 3, keep='doc_id, line_no, sent_no')} "
    f"SELECT doc_id, line_no, sent_no, pos, begins || ' ' || ends AS ngram FROM grams",
)
def ngrams_order_n(spark, sf):
    toks = tk.corpus_tokens(lines(spark, sf), keep=("doc_id", "line_no"))
    g = tk.explode_ngrams(toks, "tokens", 3, 3, keep=("doc_id", "line_no", "sent_no"))
    return g.select("doc_id", "line_no", "sent_no", "pos",
                    tk.ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("ngram"))


# --- A1 / T7 model counts -------------------------------------------------------
@query("model_counts", f"WITH {S.model_ctes()} SELECT * FROM counts")
def model_counts(spark, sf):
    return model(spark, sf)


def _register_order(k: int):
    @query(
        ORDER_NAMES[k],
        f"WITH {S.corpus_ctes(with_grams=(k, k))}, {S.COUNTS_CTE} SELECT * FROM counts",
    )
    def _q(spark, sf):
        return model(spark, sf, k, k)

    return _q


for _k in range(1, 6):
    _register_order(_k)


# --- W3 pruned corpus -------------------------------------------------------------
@query(
    "pruned_corpus",
    f"WITH {S.model_ctes()}, r AS (SELECT *, row_number() OVER (PARTITION BY \"order\", begins "
    f"ORDER BY ngram_count DESC, ends) AS rk FROM counts) "
    f"SELECT \"order\", begins, ends, ngram_count FROM r WHERE rk <= {PRUNE_K}",
)
def pruned_corpus(spark, sf):
    return ranking.prune_by_order(tk.model_by_order(lines(spark, sf)), PRUNE_K)


# --- X1 / S5 incremental counts (Structured Streaming, batch-keyed partials) --
@query("append_counts", f"WITH {S.model_ctes()} SELECT * FROM counts")
def append_counts(spark, sf):
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming.incremental import run_incremental_counts

    # a query starts from nothing each time; a running service keeps its folders
    base = f"{ensure_checkpoint_dir(spark)}/incremental-{uuid.uuid4().hex}"
    return run_incremental_counts(spark, sf, f"{base}/partial", f"{base}/stream", "documents.parquet")


# --- S12 running maximum (Structured Streaming, state store) --
@query(
    "longest_line_running",
    f"WITH {S.lines_cte()} SELECT file, CAST(max(length(text)) AS INTEGER) AS max_chars FROM doc_lines GROUP BY file",
)
def longest_line_running(spark, sf):
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..streaming.incremental import run_longest_lines

    base = f"{ensure_checkpoint_dir(spark)}/longest-{uuid.uuid4().hex}"
    return run_longest_lines(spark, sf, f"{base}/raised", f"{base}/stream", "documents.parquet")
