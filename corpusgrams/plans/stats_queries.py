"""Registered queries: smoothing, sampling and splits, remaining token tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import clean as C
from ..operators import counts as A
from ..operators import ordinals as O
from ..operators import smoothing as K
from ..operators import splits as P
from ..operators import tokenize as tk
from ..sources import corpus as src
from . import sqltext as S
from .registry import query

SAMPLE_SEED, SAMPLE_PROP = 1212, 0.33
SPLIT_SEED, SPLIT_PROP = 42, 0.75
SAMPLE_N, SAMPLE_N_SEED = 1000, 7
KATZ_K = 5
TWEET_SOURCES = ["src1"]


def r10(c):
    return F.round(c, 10) + F.lit(0.0)


def R10(e: str) -> str:
    return f"round({e}, 10) + 0.0"


def W(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def lines(spark, sf):
    return src.corpus_lines(spark, sf)


def counts(spark, sf, shared=True):
    """The model table; its windows are written once (compressed, shared folder) when
    the query reads it twice."""
    return tk.stored_counts(lines(spark, sf)) if shared else tk.ngram_counts(lines(spark, sf))


MODEL = S.model_ctes()


def DIV(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


# ---------------------------------------------------------------------------
# K1-K7 smoothing
# ---------------------------------------------------------------------------
CC = "cc AS (SELECT \"order\", ngram_count AS r, count(*) AS n_r FROM counts GROUP BY ALL)"
LEAD = (
    "gt AS (SELECT \"order\", r, n_r, coalesce(lead(n_r) OVER (PARTITION BY \"order\" ORDER BY r), 0) AS n_r_plus_one "
    "FROM cc), gtl AS (SELECT *, (r + 1) * " + DIV("n_r_plus_one", "n_r") + " AS r_star FROM gt)"
)
NRT = (
    "nrt AS (SELECT a.\"order\", a.r, a.n_r AS Nr, coalesce(b.n_r, 0) AS Nrp1 FROM cc a "
    "LEFT JOIN cc b ON b.\"order\" = a.\"order\" AND b.r = a.r + 1)"
)
NRP1 = (
    "np AS (SELECT c.\"order\", CASE WHEN c.\"order\" = 1 THEN c.ends ELSE c.begins || ' ' || c.ends END AS ngram, "
    "c.begins AS prefix, c.ngram_count AS r, t.Nr, t.Nrp1 FROM counts c JOIN nrt t ON t.\"order\" = c.\"order\" AND t.r = c.ngram_count)"
)


@query("good_turing_lead", W(MODEL, CC, LEAD) + f"SELECT \"order\", r, n_r, n_r_plus_one, {R10('r_star')} AS r_star FROM gtl")
def good_turing_lead(spark, sf):
    return K.good_turing_lead(counts(spark, sf, shared=False)).withColumn("r_star", r10(F.col("r_star")))


@query("nr_plus_one", W(MODEL, CC, NRT, NRP1) + "SELECT * FROM np")
def nr_plus_one(spark, sf):
    return K.nr_plus_one(counts(spark, sf))


@query(
    "good_turing",
    W(MODEL, CC, NRT, NRP1,
      "n1 AS (SELECT \"order\", Nr AS N1 FROM nrt WHERE r = 1)",
      "g AS (SELECT np.*, (r + 1) * " + DIV("Nrp1", "Nr") + " AS r_star, sum(r) OVER (PARTITION BY np.\"order\") AS sr, n1.N1 "
      "FROM np LEFT JOIN n1 USING (\"order\"))",
      "g2 AS (SELECT *, " + DIV("r", "sr") + " AS mle, CASE WHEN r = 0 THEN " + DIV("N1", "sr") + " ELSE "
      + DIV("r_star", "sr") + " END AS Pgt FROM g)",
      f"g3 AS (SELECT *, CASE WHEN r <= {KATZ_K} THEN Pgt ELSE mle END AS Pgt_1 FROM g2)")
    + "SELECT \"order\", ngram, prefix, r, Nr, Nrp1, " + ", ".join(
        f"{R10(x)} AS {x}" for x in ("r_star", "mle", "Pgt", "Pgt_1")
    ) + ", " + R10(DIV("Pgt_1", "sum(Pgt_1) OVER (PARTITION BY \"order\")")) + " AS Pgt_2 FROM g3",
)
def good_turing(spark, sf):
    g = K.good_turing(counts(spark, sf), KATZ_K)
    return g.select("order", "ngram", "prefix", "r", "Nr", "Nrp1",
                    *[r10(F.col(x)).alias(x) for x in ("r_star", "mle", "Pgt", "Pgt_1", "Pgt_2")])


@query(
    "c_star",
    W(MODEL, CC, NRT, NRP1,
      "n1 AS (SELECT \"order\", Nr AS N1 FROM nrt WHERE r = 1)",
      f"nk AS (SELECT \"order\", Nr AS Nk FROM nrt WHERE r = {KATZ_K + 1})",
      "g AS (SELECT np.*, n1.N1, coalesce(nk.Nk, 0) AS Nkp1 FROM np LEFT JOIN n1 USING (\"order\") LEFT JOIN nk USING (\"order\"))",
      f"g2 AS (SELECT *, (r + 1) * {DIV('Nrp1', 'Nr')} AS c1, {DIV(f'{KATZ_K + 1} * Nkp1', 'N1')} AS t FROM g)")
    + f"SELECT \"order\", ngram, prefix, r, Nr, Nrp1, {R10(f'CASE WHEN r > {KATZ_K} THEN CAST(r AS DOUBLE) ELSE ' + DIV('c1 - r * t', '1 - t') + ' END')} AS c_star FROM g2",
)
def c_star(spark, sf):
    return K.c_star(counts(spark, sf), KATZ_K).withColumn("c_star", r10(F.col("c_star")))


KATZ_SQL = (
    f"nk AS (SELECT \"order\", n_r_plus_one AS nk1 FROM gtl WHERE r = {KATZ_K}), "
    "n1 AS (SELECT \"order\", n_r AS n1 FROM gtl WHERE r = 1), "
    "kd AS (SELECT gtl.*, " + DIV(DIV("r_star", "r") + f" - {DIV(f'{KATZ_K + 1} * nk1', 'n1')}", f"1 - {DIV(f'{KATZ_K + 1} * nk1', 'n1')}")
    + " AS d_r FROM gtl LEFT JOIN nk USING (\"order\") LEFT JOIN n1 USING (\"order\")), "
    "kc AS (SELECT *, d_r * r AS C_katz FROM kd)"
)


@query(
    "katz_dr",
    W(MODEL, CC, LEAD, KATZ_SQL)
    + f"SELECT \"order\", r, n_r, n_r_plus_one, {R10('r_star')} AS r_star, {R10('d_r')} AS d_r, {R10('C_katz')} AS C_katz, "
    + R10(DIV("C_katz", "sum(C_katz) OVER (PARTITION BY \"order\")")) + " AS P_katz FROM kc",
)
def katz_dr(spark, sf):
    k = K.katz_dr(K.good_turing_lead(counts(spark, sf, shared=False)), KATZ_K)
    return k.select("order", "r", "n_r", "n_r_plus_one", *[r10(F.col(x)).alias(x) for x in ("r_star", "d_r", "C_katz", "P_katz")])


TRAIN_KATZ_SQL = (
    "hi AS (SELECT * FROM counts WHERE \"order\" > 1), "
    "cc AS (SELECT \"order\", ngram_count AS r, count(*) AS n_r FROM hi GROUP BY ALL), "
    + LEAD + ", " + KATZ_SQL + ", "
    "tk AS (SELECT \"order\", begins, ends, ngram_count, CAST(ngram_count AS DOUBLE) AS C_katz, "
    + DIV("ngram_count", "sum(ngram_count) OVER ()") + " AS P_katz FROM counts WHERE \"order\" = 1 "
    "UNION ALL SELECT h.\"order\", h.begins, h.ends, h.ngram_count, kc.C_katz, CAST(NULL AS DOUBLE) AS P_katz "
    "FROM hi h LEFT JOIN kc ON kc.\"order\" = h.\"order\" AND kc.r = h.ngram_count)"
)


@query(
    "train_katz",
    W(MODEL, TRAIN_KATZ_SQL)
    + f"SELECT \"order\", begins, ends, ngram_count, {R10('C_katz')} AS C_katz, {R10('P_katz')} AS P_katz FROM tk",
)
def train_katz(spark, sf):
    t = K.train_katz(counts(spark, sf), KATZ_K)
    return t.select("order", "begins", "ends", "ngram_count", r10(F.col("C_katz")).alias("C_katz"),
                    r10(F.col("P_katz")).alias("P_katz"))


ALPHA_SQL = (
    W(MODEL, TRAIN_KATZ_SQL,
      "t2 AS (SELECT * FROM tk WHERE \"order\" > 1)",
      "p AS (SELECT t2.*, " + DIV("C_katz", "sum(ngram_count) OVER (PARTITION BY \"order\", begins)") + " AS p_star FROM t2)",
      "un AS (SELECT ends, " + DIV("ngram_count", "sum(ngram_count) OVER ()") + " AS p_low FROM counts WHERE \"order\" = 1)",
      "p2 AS (SELECT p.\"order\", p.begins, p.p_star, un.p_low FROM p LEFT JOIN un USING (ends) WHERE p.\"order\" = 2)",
      "p3 AS (SELECT p.\"order\", p.begins, p.p_star, l.p_star AS p_low FROM p LEFT JOIN p l ON l.\"order\" = p.\"order\" - 1 "
      "AND l.begins = regexp_replace(p.begins, '^[^ ]+ ', '') AND l.ends = p.ends WHERE p.\"order\" > 2)",
      "s AS (SELECT \"order\", begins, sum(p_star) AS num, sum(p_low) AS den FROM (SELECT * FROM p2 UNION ALL SELECT * FROM p3) GROUP BY ALL)")
    + f"SELECT \"order\", begins, {R10(DIV('1 - num', '1 - den'))} AS alpha FROM s"
)


@query("katz_alpha", ALPHA_SQL)
def katz_alpha(spark, sf):
    tokens = tk.corpus_tokens(lines(spark, sf), keep=())
    return K.katz_alpha_of_tokens(tokens, KATZ_K).withColumn("alpha", r10(F.col("alpha")))


@query("katz_alpha_links", ALPHA_SQL)
def katz_alpha_links(spark, sf):
    from ..operators import model as M

    tokens = tk.corpus_tokens(lines(spark, sf), keep=())
    words = M.counted_vocabulary(tk.ngram_counts(lines(spark, sf), 1, 1))
    a = K.katz_alpha_by_links_of_tokens(tokens, words, 5, KATZ_K)
    return a.withColumn("alpha", r10(F.col("alpha")))


# ---------------------------------------------------------------------------
# P1-P7 sampling / splits, S9 chunk counts, T9
# ---------------------------------------------------------------------------
def _hash_sql(seed, *cols):
    return "md5('" + str(seed) + "' || " + " || ".join(f"':' || {c}" for c in cols) + ")"


SAMPLE_CTE = (
    f"{S.lines_cte()}, "
    "sx AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id, line_no) AS ordinal FROM doc_lines), "
    "sy AS (SELECT *, CAST(floor((ordinal - 1) / 20000) AS BIGINT) AS chunk FROM sx), "
    f"sz AS (SELECT *, count(*) OVER (PARTITION BY file, chunk) AS n, row_number() OVER (PARTITION BY file, chunk "
    f"ORDER BY {_hash_sql(SAMPLE_SEED, 'doc_id', 'line_no')}, doc_id, line_no) AS rk FROM sy), "
    f"sk AS (SELECT * FROM sz WHERE rk <= floor(n * CAST({SAMPLE_PROP} AS DOUBLE))), "
    "samp AS (SELECT doc_id, line_no, file, text, chunk, row_number() OVER (PARTITION BY file ORDER BY chunk, rk) AS rnum, "
    "file AS \"from\" FROM sk WHERE text <> '')"
)


def sampled(spark, sf):
    return P.sample_lines(lines(spark, sf), SAMPLE_SEED, SAMPLE_PROP)


@query("sample_lines", W(SAMPLE_CTE) + "SELECT * FROM samp")
def sample_lines(spark, sf):
    return sampled(spark, sf).select("doc_id", "line_no", "file", "text", "chunk", "rnum", "from")


BY_FRACTIONS = {"src0": 0.1, "src1": 0.5}


@query(
    "sample_lines_by",
    W(S.lines_cte(), f"x AS (SELECT *, substr({_hash_sql(SAMPLE_SEED, 'doc_id', 'line_no')}, 1, 8) AS h FROM doc_lines)")
    + "SELECT doc_id, line_no, file, text FROM x WHERE CAST('0x' || h AS BIGINT) < CASE file "
    + " ".join(f"WHEN '{f}' THEN round({p} * 4294967296)" for f, p in BY_FRACTIONS.items())
    + f" ELSE round({SAMPLE_PROP} * 4294967296) END",
)
def sample_lines_by(spark, sf):
    s = P.sample_by(lines(spark, sf), "file", BY_FRACTIONS, ["doc_id", "line_no"], SAMPLE_SEED, SAMPLE_PROP)
    return s.select("doc_id", "line_no", "file", "text")


@query(
    "sample_n",
    W(S.lines_cte()) + f"SELECT doc_id, line_no, text FROM doc_lines ORDER BY {_hash_sql(SAMPLE_N_SEED, 'doc_id', 'line_no')}, "
    f"doc_id, line_no LIMIT {SAMPLE_N}",
)
def sample_n(spark, sf):
    return P.sample_n(lines(spark, sf), SAMPLE_N, SAMPLE_N_SEED, ["doc_id", "line_no"]).select("doc_id", "line_no", "text")


SPLIT_CTE = (
    f"{S.lines_cte()}, {S.sentences_cte()}, "
    f"sp0 AS (SELECT doc_id, line_no, sent_no, file, {_hash_sql(SPLIT_SEED, 'doc_id', 'line_no', 'sent_no')} AS h FROM sents), "
    "sp1 AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY h, doc_id, line_no, sent_no) AS rk, "
    "count(*) OVER (PARTITION BY file) AS n FROM sp0), "
    f"split AS (SELECT doc_id, line_no, sent_no, file, CASE WHEN rk <= floor(n * CAST({SPLIT_PROP} AS DOUBLE)) "
    "THEN 'training' ELSE 'testing' END AS split FROM sp1)"
)


def split(spark, sf):
    s = tk.sentences(lines(spark, sf))
    return P.stratified_split(s, "file", ["doc_id", "line_no", "sent_no"], SPLIT_SEED, SPLIT_PROP)


@query("train_test_split", W(SPLIT_CTE) + "SELECT * FROM split")
def train_test_split(spark, sf):
    return split(spark, sf).select("doc_id", "line_no", "sent_no", "file", "split")


@query("test_split_counts", W(SPLIT_CTE) + "SELECT file, split, count(*) AS n FROM split GROUP BY ALL")
def test_split_counts(spark, sf):
    return A.count_by(split(spark, sf), ["file", "split"], "n")


def _line_grams_sql(src_: str, n: int, name: str, keep: str) -> str:
    return (
        f"{name}_w AS (SELECT {keep}, {S.words_sql('text')} AS tokens FROM {src_}), "
        + S.grams_cte(f"{name}_w", name, n, n, keep=keep)
    )


@query(
    "bootstrap_ngrams",
    W(SAMPLE_CTE, _line_grams_sql("samp", 1, "g1", "doc_id"), _line_grams_sql("samp", 2, "g2", "doc_id"),
      _line_grams_sql("samp", 3, "g3", "doc_id"),
      "u AS (SELECT 1 AS n, ends AS ngram FROM g1 UNION ALL SELECT 2, begins || ' ' || ends FROM g2 "
      "UNION ALL SELECT 3, begins || ' ' || ends FROM g3)")
    + "SELECT n, ngram, count(*) AS ngram_count, regexp_replace(ngram, ' [^ ]+$', '') AS prefix FROM u GROUP BY n, ngram",
)
def bootstrap_ngrams(spark, sf):
    words = sampled(spark, sf).select(T.words(F.col("text")).alias("tokens"))
    g = tk.explode_ngrams(words, "tokens", 1, 3)
    c = A.count_by(g, ["order", "begins", "ends"], "ngram_count")
    whole = tk.ngram_string(F.col("begins"), F.col("ends"), F.col("order"))
    return c.select(F.col("order").cast("int").alias("n"), whole.alias("ngram"), "ngram_count", F.col("begins").alias("prefix"))


@query(
    "ngram_set",
    W(S.lines_cte(), _line_grams_sql("doc_lines", 3, "g3", "doc_id"))
    + "SELECT begins || ' ' || ends AS ngram, count(*) AS ngram_count, begins AS prefix FROM g3 GROUP BY ALL",
)
def ngram_set(spark, sf):
    g = tk.line_ngrams(lines(spark, sf), 3, keep=("doc_id",))
    c = A.count_by(g, ["ngram"], "ngram_count")
    return c.withColumn("prefix", tk.split_last_word(F.col("ngram"))[0])


def _clean_duck():
    from .explore_queries import CLEAN_TEXT_DUCK

    return CLEAN_TEXT_DUCK


@query(
    "sampled_chunk_counts",
    W(S.lines_cte(),
      "sx AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY doc_id, line_no) AS ordinal FROM doc_lines)",
      "sy AS (SELECT *, CAST(floor((ordinal - 1) / 20000) AS BIGINT) AS chunk FROM sx)",
      f"sz AS (SELECT *, count(*) OVER (PARTITION BY file, chunk) AS n, row_number() OVER (PARTITION BY file, chunk "
      f"ORDER BY {_hash_sql(SAMPLE_SEED, 'doc_id', 'line_no')}, doc_id, line_no) AS rk FROM sy)",
      f"sk AS (SELECT * FROM sz WHERE rk <= floor(n * CAST({SAMPLE_PROP} AS DOUBLE)) AND NOT regexp_matches(text, {S.q(_clean_duck())}))",
      _line_grams_sql("sk", 2, "g2", "file, chunk"))
    + "SELECT file, chunk, begins || ' ' || ends AS ngram, count(*) AS ngram_count FROM g2 GROUP BY ALL",
)
def sampled_chunk_counts(spark, sf):
    def post(d):
        return C.clean_text(d)

    s = P.sample_lines(lines(spark, sf), SAMPLE_SEED, SAMPLE_PROP, postprocess=post)
    g = tk.line_ngrams(s, 2, keep=("file", "chunk"))
    return A.count_by(g, ["file", "chunk", "ngram"], "ngram_count")


@query(
    "chunk_fivegram_counts",
    W(S.lines_cte(),
      "x AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) % 1000 AS bucket FROM doc_lines)",
      f"y AS (SELECT * FROM x WHERE NOT regexp_matches(text, {S.q(_clean_duck())}))",
      _line_grams_sql("y", 5, "g5", "bucket"))
    + "SELECT bucket, begins || ' ' || ends AS ngram, count(*) AS ngram_count FROM g5 GROUP BY ALL",
)
def chunk_fivegram_counts(spark, sf):
    ls = lines(spark, sf)
    x = O.global_row_number(ls, ["doc_id", "line_no"], "_rn")
    x = C.clean_text(x.withColumn("bucket", F.col("_rn") % 1000))
    # nearly every one is the only one of its chunk: dealt out as they are, not combined before
    g = tk.line_ngrams(x, 5, keep=("bucket",)).select("bucket", "ngram").repartition("bucket", "ngram")
    return A.count_by(g, ["bucket", "ngram"], "ngram_count")


_PTB_WORD = "w"
for _p in tk.PTB_SPLITS:
    _PTB_WORD = f"regexp_replace({_PTB_WORD}, {S.q(_p)}, '\\1 \\2')"
PTB_SQL = "string_split(array_to_string(list_transform({x}, lambda w: " + _PTB_WORD + "), ' '), ' ')"


@query(
    "ptb_tokens",
    W(S.lines_cte(), S.sentences_cte(),
      f"p AS (SELECT doc_id, line_no, sent_no, {PTB_SQL.format(x=S.marked_sql(S.words_sql('text')))} AS toks FROM sents)")
    + "SELECT doc_id, line_no, sent_no, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token FROM p",
)
def ptb_tokens(spark, sf):
    s = tk.sentences(lines(spark, sf))
    t = s.select("doc_id", "line_no", "sent_no", tk.ptb_split(T.with_markers(T.words(F.col("text")))).alias("toks"))
    return t.select("doc_id", "line_no", "sent_no", F.posexplode("toks").alias("pos", "token"))


@query(
    "ngrams_upto",
    W(S.lines_cte(), S.sentences_cte(),
      "rn AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no, sent_no) AS rn, count(*) OVER () AS nn FROM sents)",
      f"ch AS (SELECT CAST(floor(rn / (nn / 10.0)) AS BIGINT) AS chunk, {PTB_SQL.format(x=S.marked_sql(S.words_sql('text')))} AS tokens FROM rn)",
      S.grams_cte("ch", "g", 1, 3, keep="chunk"),
      "d AS (SELECT DISTINCT chunk, \"order\", begins, ends FROM g)")
    + "SELECT \"order\", begins, ends, count(*) AS ngram_count FROM d GROUP BY ALL",
)
def ngrams_upto(spark, sf):
    s = tk.sentences(lines(spark, sf))
    c = P.global_chunks(s, ["doc_id", "line_no", "sent_no"], 10)
    t = c.select("chunk", tk.ptb_split(T.with_markers(T.words(F.col("text")))).alias("tokens"))
    g = tk.explode_ngrams(t, "tokens", 1, 3, keep=("chunk",))
    # the chunks 0 to 10 of an n-gram as bits of one number
    chunks = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("chunk").cast("int")))
    return g.groupBy("order", "begins", "ends").agg(F.bit_count(chunks).cast("bigint").alias("ngram_count"))


@query(
    "tweet_tokens",
    W(S.lines_cte(), S.sentences_cte())
    + f"SELECT doc_id, line_no, sent_no, file, CASE WHEN file IN ({', '.join(S.q(x) for x in TWEET_SOURCES)}) THEN "
    f"array_to_string(regexp_extract_all(regexp_replace('{T.TOKEN_BOS} ' || text || ' {T.TOKEN_EOS}', {S.q(T.URL_PATTERN)}, '', 'g'), "
    f"{S.q(T.TWEET_TOKEN_PATTERN)}), ' ') ELSE '{T.TOKEN_BOS} ' || text || ' {T.TOKEN_EOS}' END AS text FROM sents",
)
def tweet_tokens(spark, sf):
    s = tk.sentences(lines(spark, sf))
    a = tk.annotated(F.col("text"))
    return s.select("doc_id", "line_no", "sent_no", "file",
                    F.when(F.col("file").isin(TWEET_SOURCES), tk.tweet_text(a)).otherwise(a).alias("text"))


# ---------------------------------------------------------------------------
# A2/A3, T17-T19, A12
# ---------------------------------------------------------------------------
@query(
    "followed_by",
    W(S.lines_cte(), _line_grams_sql("doc_lines", 2, "g2", "doc_id"))
    + "SELECT begins || ' ' || ends AS ngram, count(*) AS ngram_count, begins AS prefix FROM g2 GROUP BY ALL",
)
def followed_by(spark, sf):
    c = A.count_by(tk.line_ngrams(lines(spark, sf), 2), ["ngram"], "ngram_count")
    return c.withColumn("prefix", tk.split_last_word(F.col("ngram"))[0])


@query(
    "get_model",
    W(MODEL, "t AS (SELECT count(*) AS total_ngrams FROM grams WHERE \"order\" = 1)")
    + "SELECT CASE WHEN \"order\" = 1 THEN ends ELSE begins || ' ' || ends END AS ngram, "
    "count(*) AS ngram_count, any_value(t.total_ngrams) AS total_ngrams FROM grams, t GROUP BY 1",
)
def get_model(spark, sf):
    m = counts(spark, sf, shared=False)  # no word holds a blank: a string belongs to one order
    c = m.select(tk.ngram_string(F.col("begins"), F.col("ends"), F.col("order")).alias("ngram"), "ngram_count")
    total = m.filter(F.col("order") == 1).agg(F.sum("ngram_count").alias("total_ngrams"))
    return c.crossJoin(F.broadcast(total))


@query(
    "ngram_order",
    W(MODEL) + "SELECT \"order\", CAST(length(CASE WHEN \"order\" = 1 THEN ends ELSE begins || ' ' || ends END) - "
    "length(replace(CASE WHEN \"order\" = 1 THEN ends ELSE begins || ' ' || ends END, ' ', '')) + 1 AS INTEGER) AS ngram_order, "
    "count(*) AS n FROM counts GROUP BY ALL",
)
def ngram_order(spark, sf):
    c = counts(spark, sf, shared=False)
    o = tk.ngram_order(tk.ngram_string(F.col("begins"), F.col("ends"), F.col("order")))
    return A.count_by(c.withColumn("ngram_order", o), ["order", "ngram_order"], "n")


@query(
    "clean_ngrams",
    W(S.lines_cte(), f"y AS (SELECT * FROM doc_lines WHERE NOT regexp_matches(text, {S.q(_clean_duck())}))",
      _line_grams_sql("y", 2, "g2", "doc_id, line_no"))
    + "SELECT doc_id, line_no, pos, begins || ' ' || ends AS ngram FROM g2",
)
def clean_ngrams(spark, sf):
    g = tk.line_ngrams(C.clean_text(lines(spark, sf)), 2, keep=("doc_id", "line_no"))
    return g.select("doc_id", "line_no", "pos", "ngram")


@query(
    "phrase_unigram_prob",
    W(S.lines_cte(),
      f"w AS (SELECT unnest({S.words_sql('text')}) AS word FROM doc_lines)",
      "f AS (SELECT word, count(*) / sum(count(*)) OVER () AS freq FROM w WHERE word NOT IN "
      "(" + ", ".join(S.q(x) for x in T.STOP_WORDS) + ") GROUP BY word)",
      "ph AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user')",
      "pw AS (SELECT DISTINCT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM ph)",
      "m AS (SELECT conv_id, turn, count(*) AS n_words, sum(ln(freq)) AS lp FROM pw JOIN f USING (word) GROUP BY ALL)")
    + "SELECT ph.conv_id, ph.turn, coalesce(m.n_words, 0) AS n_words, " + R10("coalesce(m.lp, 0.0)") + " AS lprob, "
    + R10("exp(coalesce(m.lp, 0.0))") + " AS prob FROM ph LEFT JOIN m USING (conv_id, turn)",
)
def phrase_unigram_prob(spark, sf):
    t = C.remove_stop_words(tk.line_words(lines(spark, sf)))
    f = A.calc_frequency(t, "word").select("word", F.col("word_freq").alias("freq"))
    p = src.spread(src.user_phrases(src.table(spark, sf, "conversations")), src.spread_setting(spark), "conv_id", "turn")
    pw = p.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word")).distinct()
    lp, _ = A.log_space_product(F.col("freq"))
    m = pw.join(f, "word").groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_words"), lp.alias("lp"))
    out = p.select("conv_id", "turn").join(m, ["conv_id", "turn"], "left")
    lpc = F.coalesce(F.col("lp"), F.lit(0.0))
    return out.select("conv_id", "turn", F.coalesce("n_words", F.lit(0)).alias("n_words"),
                      r10(lpc).alias("lprob"), r10(F.exp(lpc)).alias("prob"))
