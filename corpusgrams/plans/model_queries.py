"""Registered queries: model tables, phrase-side language-model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import model as M
from ..operators import prefilter as PF
from ..operators import relabel
from ..operators import tokenize as tk
from ..operators import trie
from ..session import cut_lineage, stored
from ..sources import corpus as src
from ..sources import keyed
from . import sqltext as S
from .registry import query

KEYP = ("conv_id", "turn")
KEYB = ("item_id",)
CAP_LINES = 1000
MAXOPTS = 40
TRIM_PROP = 0.4


def r10(c):
    return F.round(c, 10) + F.lit(0.0)


def R10(e: str) -> str:
    return f"round({e}, 10) + 0.0"


def counts(spark, sf, shared=True, max_order=5):
    """The model table.  ``shared=True`` writes it once, compressed, to the
    shared checkpoint folder for queries that read it from several branches (each
    branch filters different orders, which Spark pushes below the aggregate,
    so without it the corpus would be tokenised once per branch)."""
    c = tk.ngram_counts(src.corpus_lines(spark, sf), 1, max_order)
    return stored(c) if shared else c


def by_order(spark, sf, in_ranges=False):
    """The model as one table for each order, all from one shuffle of windows."""
    return tk.model_by_order(src.corpus_lines(spark, sf), in_ranges=in_ranges)


def id_windows(spark, sf):
    """The corpus as windows of word ids (see ``relabel``)."""
    words = M.counted_vocabulary(counts(spark, sf, shared=False, max_order=1))
    return relabel.id_windows(tk.corpus_tokens(src.corpus_lines(spark, sf), keep=()), vocab_of(words))


def vocab_of(words):
    """Every word's id and count under the names that ``relabel`` asks for."""
    return words.select(F.col("word").alias("ngram"), F.col("node").alias("wid"), "ngram_count")


def trie_of_corpus(spark, sf, words):
    """The trie of the model, from windows of word ids; ``words``: every word's id and count."""
    tokens = tk.corpus_tokens(src.corpus_lines(spark, sf), keep=())
    windows = relabel.led_id_windows(tokens, vocab_of(words))
    return trie.trie_of_windows(windows, words.withColumn("word", relabel.id_label(F.col("node"))))


def asked_counts(spark, sf, grams):
    """Counts of the grams and of their last words, written once (two branches read them)."""
    return cut_lineage(PF.counts_for_grams(src.corpus_lines(spark, sf), grams, [1, 2, 3, 4, 5]))


def phrases(spark, sf):
    return src.spread(src.user_phrases(src.table(spark, sf, "conversations")), src.spread_setting(spark), "conv_id", "turn")


def bench(spark, sf):
    return src.spread(src.evaluation_texts(src.table(spark, sf, "benchmark")), src.spread_setting(spark), "item_id")


def user_grams(spark, sf, order=5):
    return tk.user_input_grams(phrases(spark, sf), KEYP, order)


def eval_grams(spark, sf):
    return tk.evaluation_grams(bench(spark, sf), KEYB, 5)


# --- SQL twins ----------------------------------------------------------------
MODEL = S.model_ctes()

_BOS_SQ = S.squish_sql(f"'{T.TOKEN_BOS} ' || s")
_LAST3 = S.words_sql("array_to_string(parts[len(parts) - 2:len(parts)], ' ')")

PHRASE_CTE = (
    "ph AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'), "
    f"ph_s AS (SELECT conv_id, turn, {S.split_sentences_sql(S.basic_clean_sql('text'))} AS parts FROM ph), "
    "ph_u AS (SELECT conv_id, turn, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sentence_id, "
    "unnest(parts) AS s FROM ph_s), "
    f"ph_q AS (SELECT conv_id, turn, sentence_id, {_BOS_SQ} AS sq FROM ph_u), "
    "ph_w AS (SELECT conv_id, turn, sentence_id, CASE WHEN sq = '' THEN [] ELSE string_split(lower(sq), ' ') END AS ws FROM ph_q), "
    "ph_k AS (SELECT conv_id, turn, sentence_id, ws, CAST(unnest(range(1, least(5, len(ws)) + 1)) AS INTEGER) AS k FROM ph_w), "
    "ugrams AS (SELECT conv_id, turn, sentence_id, k AS \"order\", "
    "CASE WHEN k = 1 THEN ws[len(ws)] ELSE array_to_string(ws[len(ws) - k + 1:len(ws) - 1], ' ') END AS begins, "
    "ws[len(ws)] AS ends FROM ph_k)"
)

BENCH_CTE = (
    "bt AS (SELECT item_id, text FROM benchmark), "
    + S.sentences_cte("bt", "b_sents", "item_id") + ", "
    + S.tokens_cte("b_sents", "b_toks", "item_id, sent_no") + ", "
    + S.grams_cte("b_toks", "egrams", 1, 5, keep="item_id, sent_no")
)


def W(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


# ---------------------------------------------------------------------------
# Model tables
# ---------------------------------------------------------------------------
@query(
    "load_corpus",
    W(MODEL) + "SELECT \"order\", begins, CASE WHEN \"order\" = 1 THEN NULL ELSE ends END AS ends, ngram_count, "
    "row_number() OVER (ORDER BY \"order\", begins, CASE WHEN \"order\" = 1 THEN NULL ELSE ends END NULLS FIRST) AS ngram_id FROM counts",
)
def load_corpus(spark, sf):
    return M.load_corpus(M.numbered(by_order(spark, sf, in_ranges=True)))


@query("corpus_size", W(MODEL) + "SELECT \"order\", count(*) AS n_rows FROM counts GROUP BY ALL")
def corpus_size(spark, sf):
    return M.corpus_size(counts(spark, sf, shared=False))


@query(
    "load_corpus_capped",
    W(MODEL) + "SELECT \"order\", begins, ends, ngram_count FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY \"order\" ORDER BY begins, ends) AS rn FROM counts) WHERE rn <= {CAP_LINES}",
)
def load_corpus_capped(spark, sf):
    return M.capped_by_order(by_order(spark, sf), CAP_LINES)


SLICE_MAXIMUM = 2


@query(
    "load_corpus_sliced",
    W(MODEL, f"capped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY \"order\" ORDER BY begins, ends) AS rn "
      f"FROM counts) WHERE rn <= {CAP_LINES})",
      "sliced AS (SELECT *, row_number() OVER (PARTITION BY \"order\", begins ORDER BY ngram_count DESC, ends) AS rk FROM capped)")
    + "SELECT \"order\", begins, CASE WHEN \"order\" = 1 THEN NULL ELSE ends END AS ends, ngram_count "
    f"FROM sliced WHERE rk <= {SLICE_MAXIMUM}",
)
def load_corpus_sliced(spark, sf):
    c = M.capped_by_order(by_order(spark, sf), CAP_LINES)
    return M.load_corpus(c, with_ids=False, slice_maximum=SLICE_MAXIMUM).select(
        "order", "begins", "ends", "ngram_count")


@query("corpus_total", W(MODEL) + "SELECT \"order\", count(*) AS n_rows FROM counts GROUP BY ROLLUP (\"order\")")
def corpus_total(spark, sf):
    return M.corpus_total(counts(spark, sf, shared=False))


def _register_endcounted(k: int, name: str):
    @query(
        f"endcounted_{name}",
        W(S.corpus_ctes(with_grams=None), S.grams_cte(min_order=1, max_order=1, name="g1"),
          S.grams_cte(min_order=k, max_order=k, name="gk"),
          "u AS MATERIALIZED (SELECT ends, count(*) AS end_count FROM g1 GROUP BY ALL)",
          "c AS MATERIALIZED (SELECT \"order\", begins, ends, count(*) AS ngram_count FROM gk GROUP BY ALL)")
        + "SELECT c.ends, c.\"order\", c.begins, c.ngram_count, u.end_count, "
        + R10("c.ngram_count / u.end_count") + " AS MLE FROM c JOIN u USING (ends)",
    )
    def _q(spark, sf):
        # words are written out (a hot one is split between plain shuffles), n-grams go from their count to the join
        lines = src.corpus_lines(spark, sf)
        e = M.end_counted(tk.ngram_counts(lines, k, k, only=[k]), stored(tk.ngram_counts(lines, 1, 1)))
        return e.withColumn("MLE", r10(F.col("MLE")))


for _k, _n in [(2, "twogram"), (3, "threegram"), (4, "fourgram"), (5, "fivegram")]:
    _register_endcounted(_k, _n)


@query(
    "mle_next_word",
    W(MODEL) + "SELECT \"order\", begins, ends, ngram_count, CAST(prefix_total AS BIGINT) AS prefix_total, "
    + R10("ngram_count / prefix_total") + " AS mle FROM (SELECT *, CASE WHEN \"order\" = 1 THEN "
    "sum(ngram_count) OVER (PARTITION BY \"order\") ELSE sum(ngram_count) OVER (PARTITION BY \"order\", begins) END "
    "AS prefix_total FROM counts)",
)
def mle_next_word(spark, sf):
    return M.mle_by_order(by_order(spark, sf)).withColumn("mle", r10(F.col("mle")))


# ---------------------------------------------------------------------------
# Phrase parsing
# ---------------------------------------------------------------------------
@query(
    "suffix_grams",
    W("ph AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')",
      f"q AS (SELECT conv_id, turn, {S.squish_sql('text')} AS sq FROM ph)",
      "w AS (SELECT conv_id, turn, CASE WHEN sq = '' THEN [] ELSE string_split(lower(sq), ' ') END AS ws FROM q)",
      "k AS (SELECT conv_id, turn, ws, CAST(unnest(range(1, least(3, len(ws)) + 1)) AS INTEGER) AS k FROM w)")
    + "SELECT conv_id, turn, k AS \"order\", CASE WHEN k = 1 THEN ws[len(ws)] ELSE "
    "array_to_string(ws[len(ws) - k + 1:len(ws) - 1], ' ') END AS begins, ws[len(ws)] AS ends FROM k",
)
def suffix_grams_q(spark, sf):
    return tk.phrase_suffix_grams(phrases(spark, sf), KEYP, 3)


@query("user_input_grams", W(PHRASE_CTE) + "SELECT * FROM ugrams")
def user_input_grams_q(spark, sf):
    return user_grams(spark, sf)


@query("evaluation_grams", W(BENCH_CTE) + "SELECT * FROM egrams")
def evaluation_grams_q(spark, sf):
    return eval_grams(spark, sf)


@query(
    "trunc_phrase",
    "SELECT conv_id, turn, array_to_string(list_slice(string_split(text, ' '), "
    "greatest(len(string_split(text, ' ')) - 2, 1), len(string_split(text, ' '))), ' ') AS trunc "
    "FROM conversations WHERE role = 'user'",
)
def trunc_phrase_q(spark, sf):
    return phrases(spark, sf).select(*KEYP, tk.last_words(F.col("text"), 3).alias("trunc"))


@query(
    "last_word",
    "SELECT conv_id, turn, coalesce(CASE WHEN len(string_split(text, ' ')) >= 2 THEN "
    "string_split(text, ' ')[len(string_split(text, ' ')) - 1] END, '') AS word "
    "FROM conversations WHERE role = 'user'",
)
def last_word_q(spark, sf):
    p = phrases(spark, sf)
    return p.select(*KEYP, F.coalesce(tk.word_from_end(F.col("text"), 2), F.lit("")).alias("word"))


@query(
    "parse_gram",
    W("ph AS (SELECT conv_id, turn, string_split(text, ' ') AS parts FROM conversations WHERE role = 'user')",
      f"t AS (SELECT conv_id, turn, {_LAST3} AS tokens "
      "FROM ph WHERE len(parts) >= 3)",
      S.grams_cte("t", "g", 3, 3, keep="conv_id, turn"))
    + "SELECT conv_id, turn, begins || ' ' || ends AS ngram, split_part(begins, ' ', 1) AS word1, "
    "split_part(begins, ' ', 2) AS word2, ends AS word3, begins AS prefix FROM g",
)
def parse_gram_q(spark, sf):
    p = phrases(spark, sf).select(*KEYP, F.split("text", " ").alias("_p")).filter(F.size("_p") >= 3)
    t = p.select(*KEYP, T.words(F.array_join(F.slice("_p", -3, 3), " ")).alias("tokens"))
    g = tk.explode_ngrams(t, "tokens", 3, 3, KEYP)
    parts = F.split("begins", " ")
    return g.select(
        *KEYP, F.concat_ws(" ", "begins", "ends").alias("ngram"), F.element_at(parts, 1).alias("word1"),
        F.element_at(parts, 2).alias("word2"), F.col("ends").alias("word3"), F.col("begins").alias("prefix"),
    )


# ---------------------------------------------------------------------------
# Language-model queries
# ---------------------------------------------------------------------------
ODDS_SQL = (
    "SELECT e.item_id, e.sent_no, e.pos, e.\"order\", e.begins, e.ends, c.ngram_count, u.prefix_count, "
    + R10("ln(c.ngram_count / u.prefix_count)") + " AS odds FROM e JOIN c USING (\"order\", begins, ends) "
    "JOIN u USING (ends)"
)
# each side of the join by itself: the asked grams, their counts, the counts of their last words
ODDS_CTES = (
    "e AS MATERIALIZED (SELECT * FROM egrams), k AS MATERIALIZED (SELECT DISTINCT \"order\", begins, ends FROM egrams), "
    "c AS MATERIALIZED (SELECT g.\"order\", g.begins, g.ends, count(*) AS ngram_count FROM grams g "
    "SEMI JOIN k USING (\"order\", begins, ends) GROUP BY ALL), "
    "u AS MATERIALIZED (SELECT ends, count(*) AS prefix_count FROM grams WHERE \"order\" = 1 GROUP BY ALL)"
)
GRAMS = S.corpus_ctes()


@query("odds_of", W(GRAMS, BENCH_CTE, ODDS_CTES) + ODDS_SQL)
def odds_of_q(spark, sf):
    g = eval_grams(spark, sf)
    o = M.odds_of(g, asked_counts(spark, sf, g))
    return o.select("item_id", "sent_no", "pos", "order", "begins", "ends", "ngram_count", "prefix_count",
                    r10(F.col("odds")).alias("odds"))


@query(
    "perplexity",
    W(GRAMS, BENCH_CTE, ODDS_CTES) + "SELECT item_id, count(*) AS n, "
    + R10("exp(-avg(ln(c.ngram_count / u.prefix_count)))")
    + " AS perplexity FROM e JOIN c USING (\"order\", begins, ends) JOIN u USING (ends) GROUP BY item_id",
)
def perplexity_q(spark, sf):
    g = eval_grams(spark, sf)
    p = M.perplexity(M.odds_of(g, asked_counts(spark, sf, g)), list(KEYB))
    return p.withColumn("perplexity", r10(F.col("perplexity")))


@query(
    "next_options",
    W(MODEL, PHRASE_CTE,
      "ctx AS (SELECT DISTINCT conv_id, turn, \"order\", begins FROM ugrams WHERE \"order\" >= 2)",
      "j AS (SELECT ctx.conv_id, ctx.turn, c.\"order\", c.begins, c.ends, c.ngram_count FROM ctx JOIN counts c USING (\"order\", begins))",
      f"r AS (SELECT *, rank() OVER (PARTITION BY conv_id, turn, \"order\" ORDER BY ngram_count DESC) AS rk FROM j)")
    + f"SELECT conv_id, turn, \"order\", begins, ends, ngram_count FROM r WHERE rk <= {MAXOPTS}",
)
def next_options_q(spark, sf):
    g = user_grams(spark, sf)
    c = stored(PF.counts_of_contexts(src.corpus_lines(spark, sf), g.filter(F.col("order") >= 2), [2, 3, 4, 5]))
    return M.next_options(g, c, list(KEYP), MAXOPTS)


@query(
    "next_matches",
    W(MODEL, PHRASE_CTE)
    + "SELECT g.conv_id, g.turn, g.sentence_id, c.\"order\", c.begins, c.ends, c.ngram_count FROM ugrams g "
    "JOIN counts c ON c.\"order\" = g.\"order\" + 1 AND c.begins = g.begins || ' ' || g.ends",
)
def next_matches_q(spark, sf):
    g = user_grams(spark, sf)
    ctx = g.select((F.col("order") + 1).alias("order"), F.concat_ws(" ", "begins", "ends").alias("begins"))
    c = PF.counts_of_contexts(src.corpus_lines(spark, sf), ctx, [2, 3, 4, 5])
    return M.next_matches(g, c, [*KEYP, "sentence_id"])


@query(
    "next_word_backoff",
    W(MODEL, PHRASE_CTE,
      "m AS (SELECT g.conv_id, g.turn, g.sentence_id, c.\"order\", c.begins, c.ends, c.ngram_count FROM ugrams g "
      "JOIN counts c ON c.\"order\" = g.\"order\" + 1 AND c.begins = CASE WHEN g.\"order\" = 1 THEN g.ends ELSE g.begins || ' ' || g.ends END)")
    + "SELECT m.*, CAST(row_number() OVER (PARTITION BY conv_id, turn, sentence_id ORDER BY \"order\" DESC, ngram_count DESC, ends) AS INTEGER) AS rank FROM m",
)
def next_word_backoff_q(spark, sf):
    g = user_grams(spark, sf)
    ctx = g.select((F.col("order") + 1).alias("order"), PF.whole_gram().alias("begins"))
    c = stored(PF.counts_of_contexts(src.corpus_lines(spark, sf), ctx, [2, 3, 4, 5]))
    return M.next_word_backoff(g, c, [*KEYP, "sentence_id"])


NEXT_K = 5


@query(
    "stored_next_words",
    W(MODEL, PHRASE_CTE,
      "m AS (SELECT g.conv_id, g.turn, g.sentence_id, c.\"order\", c.begins, c.ends, c.ngram_count FROM ugrams g "
      "JOIN counts c ON c.\"order\" = g.\"order\" + 1 AND c.begins = CASE WHEN g.\"order\" = 1 THEN g.ends ELSE g.begins || ' ' || g.ends END)",
      "x AS (SELECT conv_id, turn, sentence_id, max(\"order\") AS \"order\" FROM m GROUP BY ALL)",
      "r AS (SELECT m.*, CAST(row_number() OVER (PARTITION BY conv_id, turn, sentence_id ORDER BY ngram_count DESC, ends) AS INTEGER) AS rank "
      "FROM m SEMI JOIN x USING (conv_id, turn, sentence_id, \"order\"))")
    + f"SELECT * FROM r WHERE rank <= {NEXT_K}",
)
def stored_next_words_q(spark, sf):
    model = keyed.store_in_shared_folder(by_order(spark, sf))
    return keyed.stored_next_words(user_grams(spark, sf), model, [*KEYP, "sentence_id"], NEXT_K)


@query(
    "eval_continuations",
    W(MODEL, BENCH_CTE,
      "j AS (SELECT e.item_id, e.\"order\", e.begins, c.ngram_count FROM egrams e JOIN counts c USING (\"order\", begins))",
      "pc AS (SELECT item_id, \"order\", begins, sum(ngram_count) AS prefix_count FROM j GROUP BY ALL)")
    + "SELECT pc.item_id, pc.\"order\", pc.begins, c.ends, c.ngram_count, CAST(pc.prefix_count AS BIGINT) AS prefix_count "
    "FROM pc JOIN counts c USING (\"order\", begins)",
)
def eval_continuations_q(spark, sf):
    g = eval_grams(spark, sf)
    c = cut_lineage(PF.counts_of_contexts(src.corpus_lines(spark, sf), g, [1, 2, 3, 4, 5]))
    e = M.eval_continuations(g, c, list(KEYB))
    return e.withColumn("prefix_count", F.col("prefix_count").cast("bigint"))


FULL_MATCH_SQL = (
    "fm AS (SELECT * FROM counts WHERE \"order\" > 1 AND ends IN (SELECT ends FROM egrams) AND begins IN (SELECT begins FROM egrams))"
)


@query("full_matches", W(MODEL, BENCH_CTE, FULL_MATCH_SQL) + "SELECT * FROM fm")
def full_matches_q(spark, sf):
    g = eval_grams(spark, sf)
    return M.full_matches(PF.counts_for_matches(src.corpus_lines(spark, sf), g, [2, 3, 4, 5]), g)


@query(
    "begin_counts",
    W(MODEL, BENCH_CTE, FULL_MATCH_SQL,
      "fp AS (SELECT *, regexp_replace(begins, ' [^ ]+$', '') AS prefix FROM fm)",
      "so AS (SELECT prefix AS begins, \"order\" - 1 AS o FROM fp WHERE \"order\" >= 2)",
      "bc AS (SELECT begins AS prefix, \"order\", CAST(sum(ngram_count) AS BIGINT) AS begins_count FROM counts "
      "WHERE begins IN (SELECT begins FROM so) AND \"order\" IN (SELECT o FROM so) GROUP BY ALL)")
    + "SELECT fp.*, bc.begins_count FROM fp JOIN bc USING (prefix, \"order\")",
)
def begin_counts_q(spark, sf):
    g = eval_grams(spark, sf)
    c = cut_lineage(PF.counts_for_begins(src.corpus_lines(spark, sf), g, M.drop_last_word(F.col("begins")), [1, 2, 3, 4, 5]))
    return M.begin_counts(c, g)


@query(
    "prefix_counts",
    W(GRAMS, BENCH_CTE,
      "eb AS MATERIALIZED (SELECT DISTINCT begins FROM egrams), ee AS MATERIALIZED (SELECT DISTINCT ends FROM egrams)",
      "fm AS MATERIALIZED (SELECT \"order\", g.begins, g.ends, count(*) AS ngram_count FROM grams g SEMI JOIN eb USING (begins) "
      "SEMI JOIN ee USING (ends) WHERE \"order\" > 1 GROUP BY ALL)",
      "lw AS (SELECT \"order\" + 1 AS \"order\", CASE WHEN \"order\" = 1 THEN ends ELSE begins || ' ' || ends END AS begins "
      "FROM grams WHERE \"order\" < 5)",
      "lo AS MATERIALIZED (SELECT \"order\", lw.begins, count(*) AS prefix_count FROM lw SEMI JOIN eb USING (begins) GROUP BY ALL)")
    + "SELECT fm.*, lo.prefix_count FROM fm JOIN lo USING (\"order\", begins)",
)
def prefix_counts_q(spark, sf):
    g = eval_grams(spark, sf)
    c = cut_lineage(PF.counts_for_matches(src.corpus_lines(spark, sf), g, [1, 2, 3, 4, 5], prefixes=True))
    return M.prefix_counts(c, g)


@query(
    "odds_of_phrases",
    W(MODEL,
      "ph AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')",
      f"pw AS (SELECT conv_id, turn, {S.words_sql('text')} AS ws FROM ph)",
      "pk AS (SELECT conv_id, turn, ws, CAST(unnest(range(1, least(4, len(ws)) + 1)) AS INTEGER) AS k FROM pw)",
      "g AS (SELECT conv_id, turn, k AS \"order\", array_to_string(ws[len(ws) - k + 1:len(ws)], ' ') AS ngram, "
      "CASE WHEN k > 1 THEN array_to_string(ws[len(ws) - k + 1:len(ws) - 1], ' ') END AS prefix FROM pk)",
      "m AS (SELECT CASE WHEN \"order\" = 1 THEN ends ELSE begins || ' ' || ends END AS ngram, ngram_count FROM counts)",
      "tot AS (SELECT sum(ngram_count) AS total FROM counts WHERE \"order\" = 1)")
    + "SELECT g.conv_id, g.turn, g.\"order\", g.ngram, g.prefix, coalesce(m1.ngram_count, 0) AS ngram_count, "
    "CAST(CASE WHEN g.prefix IS NULL THEN tot.total ELSE m2.ngram_count END AS BIGINT) AS prefix_count, "
    + R10("coalesce(coalesce(m1.ngram_count, 0) / nullif(CASE WHEN g.prefix IS NULL THEN tot.total ELSE m2.ngram_count END, 0), 0.0)")
    + " AS odds FROM g LEFT JOIN m m1 ON m1.ngram = g.ngram LEFT JOIN m m2 ON m2.ngram = g.prefix CROSS JOIN tot",
)
def odds_of_phrases_q(spark, sf):
    p = phrases(spark, sf)
    w = p.select(*KEYP, T.words(F.col("text")).alias("ws"))
    g = w.select(*KEYP, F.inline(tk.suffix_grams(F.col("ws"), 4)))
    strings = g.select(F.explode(F.array(PF.whole_gram(), "begins")).alias("s"))
    lines = src.corpus_lines(spark, sf)
    c = stored(PF.counts_of_strings(lines, strings, [1, 2, 3, 4]))  # grows with the phrases
    total = tk.corpus_tokens(lines, keep=()).agg(F.sum(F.size("tokens")).alias("_total"))  # all occurrences of words
    o = M.odds_of_phrases(g, c, list(KEYP), total)
    return o.select(*KEYP, "order", "ngram", "prefix", "ngram_count",
                    F.col("prefix_count").cast("bigint").alias("prefix_count"), r10(F.col("odds")).alias("odds"))


@query(
    "phrase_lookup",
    W(S.corpus_ctes(with_grams=(1, 2)),
      f"p AS (SELECT conv_id, turn, {S.words_sql('text')} AS ws FROM conversations WHERE role = 'user')",
      "q AS (SELECT conv_id, turn, ws[len(ws) - 1] AS prefix, ws[len(ws)] AS e FROM p WHERE len(ws) >= 2)",
      "b AS MATERIALIZED (SELECT begins AS prefix, ends AS e, count(*) AS ngram_count FROM grams WHERE \"order\" = 2 GROUP BY ALL)",
      "u AS MATERIALIZED (SELECT ends AS prefix, count(*) AS ngram_count FROM grams WHERE \"order\" = 1 GROUP BY ALL)")
    + "SELECT q.conv_id, q.turn, q.prefix || ' ' || q.e AS ngram, q.prefix, b.ngram_count, u.ngram_count AS prefix_count "
    "FROM q LEFT JOIN b ON b.prefix = q.prefix AND b.e = q.e LEFT JOIN u ON u.prefix = q.prefix",
)
def phrase_lookup_q(spark, sf):
    p = phrases(spark, sf)
    last = F.slice(T.words(F.col("text")), -2, 2)
    wanted = p.select(last.alias("w")).filter(F.size("w") == 2).select(
        F.explode(F.array(F.array_join("w", " "), F.element_at("w", 1))).alias("s"))
    c = cut_lineage(PF.counts_of_strings(src.corpus_lines(spark, sf), wanted, [1, 2]))
    return M.phrase_lookup(p, c, list(KEYP))


# ---------------------------------------------------------------------------
# Vocabulary, ids, encoding, trimming, coverage
# ---------------------------------------------------------------------------
VOCAB_SQL = "vocab AS (SELECT ends AS ngram, row_number() OVER (ORDER BY ends) AS wid FROM counts WHERE \"order\" = 1)"


@query("vocabulary", W(MODEL, VOCAB_SQL) + "SELECT ngram, wid FROM vocab")
def vocabulary_q(spark, sf):
    return M.vocabulary(counts(spark, sf, shared=False, max_order=1))


@query(
    "stable_word_ids",
    W(MODEL) + "SELECT ends AS word, CAST('0x' || substr(md5(ends), 1, 15) AS BIGINT) AS word_id FROM counts WHERE \"order\" = 1",
)
def stable_word_ids_q(spark, sf):
    from ..operators import wordids as I

    words = counts(spark, sf, shared=False, max_order=1).select(F.col("ends").alias("word"))
    return I.stable_word_ids(words)


@query(
    "ngram_ids",
    W(MODEL) + "SELECT \"order\", begins, ends, ngram_count, row_number() OVER (ORDER BY \"order\", begins, ends) AS ngram_id "
    "FROM counts",
)
def ngram_ids(spark, sf):
    return M.numbered(by_order(spark, sf, in_ranges=True))


@query(
    "recode_ngrams",
    W(MODEL, VOCAB_SQL,
      "ids AS (SELECT *, row_number() OVER (ORDER BY \"order\", begins, ends) AS ngram_id FROM counts)")
    + "SELECT ids.ngram_id, v.wid AS begins_wid, ids.\"order\", ids.ends, ids.ngram_count FROM ids LEFT JOIN vocab v ON v.ngram = ids.begins",
)
def recode_ngrams_q(spark, sf):
    ids = M.numbered(by_order(spark, sf, in_ranges=True))
    return M.recode_begins(ids, M.vocabulary(ids))


@query(
    "recode_single",
    W(MODEL, VOCAB_SQL,
      "ids AS (SELECT *, row_number() OVER (ORDER BY \"order\", begins, ends) AS ngram_id FROM counts)")
    + "SELECT ids.ngram_id, v.wid AS ngram FROM ids JOIN vocab v ON v.ngram = ids.ends",
)
def recode_single_q(spark, sf):
    ids = M.numbered(by_order(spark, sf, in_ranges=True))
    return M.recode_single(ids, "ngram_id", "ends", M.vocabulary(ids))


def _words_sql(src_: str) -> str:
    return (f"ex AS (SELECT \"order\", begins, ends, ngram_count, "
            f"unnest(CASE WHEN \"order\" = 1 THEN [ends] ELSE string_split(begins, ' ') || [ends] END) AS word, "
            f"generate_subscripts(CASE WHEN \"order\" = 1 THEN [ends] ELSE string_split(begins, ' ') || [ends] END, 1) AS wpos "
            f"FROM {src_})")


@query(
    "encoded_model",
    W(MODEL, VOCAB_SQL, _words_sql("counts"),
      "e AS (SELECT \"order\", begins, ends, ngram_count, list(CAST(v.wid AS VARCHAR) ORDER BY wpos) AS ws "
      "FROM ex LEFT JOIN vocab v ON v.ngram = ex.word GROUP BY ALL)")
    + "SELECT \"order\", CASE WHEN len(ws) = 1 THEN ws[1] ELSE array_to_string(ws[1:len(ws) - 1], ' ') END AS begins_ids, "
    "CAST(ws[len(ws)] AS INTEGER) AS ends_id, ngram_count FROM e",
)
def encoded_model_q(spark, sf):
    return relabel.encoded(id_windows(spark, sf))


TRIE_SQL = (
    _words_sql("counts") + ", "
    "e AS (SELECT \"order\", begins, ends, ngram_count, list(v.wid ORDER BY wpos) AS ws FROM ex JOIN vocab v ON v.ngram = ex.word GROUP BY ALL), "
    "t AS MATERIALIZED (SELECT \"order\", begins, ends, ngram_count, ws, row_number() OVER (ORDER BY \"order\", ws) AS node FROM e)"
)


@query(
    "trie_model",
    W(MODEL, VOCAB_SQL, TRIE_SQL)
    + "SELECT t.\"order\", t.node, coalesce(p.node, 0) AS parent, t.ws[len(t.ws)] AS word, coalesce(s.node, 0) AS suffix, t.ngram_count "
    "FROM t LEFT JOIN t p ON p.ws = t.ws[1:len(t.ws) - 1] LEFT JOIN t s ON s.ws = t.ws[2:len(t.ws)]",
)
def trie_model_q(spark, sf):
    return trie_of_corpus(spark, sf, M.counted_vocabulary(counts(spark, sf, shared=False, max_order=1)))


@query(
    "longest_context",
    W(MODEL, VOCAB_SQL, PHRASE_CTE, TRIE_SQL,
      "k AS (SELECT u.conv_id, u.turn, u.sentence_id, u.\"order\", t.node FROM ugrams u LEFT JOIN t USING (\"order\", begins, ends))")
    + "SELECT conv_id, turn, sentence_id, coalesce(max(\"order\") FILTER (node IS NOT NULL), 0) AS \"order\", "
    "coalesce(arg_max(node, \"order\") FILTER (node IS NOT NULL), 0) AS node FROM k GROUP BY conv_id, turn, sentence_id",
)
def longest_context_q(spark, sf):
    words_of = M.counted_vocabulary(counts(spark, sf, shared=False, max_order=1))
    vocab = words_of.select(F.col("word").alias("ngram"), F.col("node").alias("wid"))
    key = [*KEYP, "sentence_id"]
    # the last words of each sentence (5 at most), and their ids
    g = user_grams(spark, sf)
    words = F.when(F.col("order") == 1, F.array("ends")).otherwise(F.concat(F.split("begins", " "), F.array("ends")))
    last = g.groupBy(*key).agg(F.max_by(words, "order").alias("ws"))
    each = last.select(*key, F.posexplode("ws").alias("at", "ngram")).join(vocab, "ngram", "left")
    ids = each.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("at", F.col("wid").cast("bigint").alias("wid")))).alias("w"))
    return trie.longest_nodes(stored(trie_of_corpus(spark, sf, words_of)), ids.select(*key, F.transform("w", lambda x: x["wid"]).alias("ids")), key)


@query(
    "trim_unk",
    W(MODEL,
      "u AS (SELECT ends AS word, ngram_count AS wc, row_number() OVER (ORDER BY ngram_count, ends) AS rk, "
      "count(*) OVER () AS v FROM counts WHERE \"order\" = 1)",
      f"low AS (SELECT word FROM u WHERE rk <= floor(v * CAST({TRIM_PROP} AS DOUBLE)))",
      _words_sql("counts"),
      f"x AS (SELECT ex.*, CASE WHEN low.word IS NOT NULL THEN '{T.TOKEN_UNK}' ELSE ex.word END AS nw FROM ex LEFT JOIN low USING (word))",
      "e AS (SELECT \"order\", begins, ends, ngram_count, list(nw ORDER BY wpos) AS ws FROM x GROUP BY ALL)")
    + "SELECT \"order\", CASE WHEN len(ws) = 1 THEN ws[1] ELSE array_to_string(ws[1:len(ws) - 1], ' ') END AS begins, "
    "ws[len(ws)] AS ends, CAST(sum(ngram_count) AS BIGINT) AS ngram_count FROM e GROUP BY ALL",
)
def trim_unk_q(spark, sf):
    rare, _ = M.rare_words(stored(counts(spark, sf, shared=False, max_order=1)), TRIM_PROP)
    tokens = relabel.trimmed(tk.corpus_tokens(src.corpus_lines(spark, sf), keep=()), rare)
    return tk.count_windows(tk.token_windows(tokens, 1, 5), [1, 2, 3, 4, 5])


@query(
    "coverage",
    W(MODEL,
      "u AS (SELECT ends AS word, ngram_count AS n FROM counts WHERE \"order\" = 1)",
      "c AS (SELECT row_number() OVER (ORDER BY n DESC, word) AS rank, sum(n) OVER (ORDER BY n DESC, word ROWS "
      "BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, sum(n) OVER () AS tot FROM u)",
      "f AS (SELECT unnest([0.5, 0.9]) AS fraction)")
    + "SELECT CAST(f.fraction AS DOUBLE) AS fraction, min(rank) AS n_words FROM c, f WHERE cum >= f.fraction * tot GROUP BY ALL",
)
def coverage_q(spark, sf):
    return M.coverage(counts(spark, sf, shared=False, max_order=1))
