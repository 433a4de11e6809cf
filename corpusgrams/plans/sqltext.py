"""DuckDB SQL fragments that repeat the Spark pipeline for the oracles.

Same regular expressions as ``functions/text.py`` (imported, not copied), so a
pattern change moves both engines together.
"""

from __future__ import annotations

from ..functions import text as T


def q(s: str) -> str:
    """SQL string literal (DuckDB: backslashes are literal, ``'`` doubled)."""
    return "'" + s.replace("'", "''") + "'"


NL = "chr(10)"


def split_sentences_sql(expr: str) -> str:
    """List of non-blank sentences of a line (same steps as Spark)."""
    t = f"regexp_replace({expr}, {q(r'\.,')}, '. ', 'g')"
    t = f"regexp_replace({t}, {q(T.SENT_BANG_PATTERN)}, '\\1' || {NL}, 'g')"
    t = f"regexp_replace({t}, {q(T.SENT_DOT_PATTERN)}, '\\1' || {NL} || '\\2', 'g')"
    return f"list_filter(string_split({t}, {NL}), lambda x: regexp_matches(x, {q(T.NON_BLANK_PATTERN)}))"


def words_sql(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {q(T.WORD_PATTERN)})"


def marked_sql(tokens: str, with_eos: bool = True) -> str:
    s = f"['{T.TOKEN_BOS}'] || {tokens}"
    return s + (f" || ['{T.TOKEN_EOS}']" if with_eos else "")


def basic_clean_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, {q(T.BASIC_CLEAN_PATTERN)}, '', 'g'), chr(127), '', 'g')"


def squish_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, {q(T.WS + '+')}, ' ', 'g'), '^ | $', '', 'g')"


def lines_cte(name: str = "doc_lines", lang: str | None = None) -> str:
    """documents -> one row per line (doc_id, line_no, file, lang, text)."""
    where = f" WHERE lang = {q(lang)}" if lang else ""
    return (
        f"{name}_src AS (SELECT doc_id, source AS file, lang, string_split(text, {NL}) AS parts "
        f"FROM documents{where}),\n"
        f"{name} AS (SELECT doc_id, file, lang, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, "
        f"unnest(parts) AS text FROM {name}_src)"
    )


def sentences_cte(src: str = "doc_lines", name: str = "sents",
                  keep: str = "doc_id, line_no, file") -> str:
    return (
        f"{name}_src AS (SELECT {keep}, {split_sentences_sql('text')} AS parts FROM {src}),\n"
        f"{name} AS (SELECT {keep}, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS sent_no, "
        f"unnest(parts) AS text FROM {name}_src)"
    )


def tokens_cte(src: str = "sents", name: str = "toks",
               keep: str = "doc_id, line_no, file, sent_no", with_eos: bool = True) -> str:
    return f"{name} AS (SELECT {keep}, {marked_sql(words_sql('text'), with_eos)} AS tokens FROM {src})"


def grams_cte(src: str = "toks", name: str = "grams", min_order: int = 1,
              max_order: int = 5, keep: str = "", tokens: str = "tokens") -> str:
    """Every n-gram of order min..max of a token list: keep + pos, order, begins, ends."""
    k = f"{keep}, " if keep else ""
    return (
        f"{name}_o AS (SELECT {k}{tokens} AS _a, CAST(unnest(range({min_order}, {max_order + 1})) AS INTEGER) AS o "
        f"FROM {src}),\n"
        f"{name}_p AS (SELECT {k}_a, o, CAST(unnest(range(1, len(_a) - o + 2)) AS INTEGER) AS pos FROM {name}_o),\n"
        f"{name} AS (SELECT {k}pos, o AS \"order\", "
        f"CASE WHEN o = 1 THEN _a[pos] ELSE array_to_string(_a[pos:pos + o - 2], ' ') END AS begins, "
        f"_a[pos + o - 1] AS ends FROM {name}_p)"
    )


def corpus_ctes(lang: str | None = None, with_grams: tuple[int, int] | None = (1, 5)) -> str:
    """lines -> sents -> toks [-> grams] as one WITH list (no leading WITH)."""
    parts = [lines_cte(lang=lang), sentences_cte(), tokens_cte()]
    if with_grams:
        parts.append(grams_cte(min_order=with_grams[0], max_order=with_grams[1]))
    return ",\n".join(parts)


COUNTS_CTE = (
    "counts AS (SELECT \"order\", begins, ends, count(*) AS ngram_count "
    "FROM grams GROUP BY ALL)"
)


def model_ctes(max_order: int = 5) -> str:
    """corpus + counts CTE: the n-gram model table as ``counts``."""
    return corpus_ctes(with_grams=(1, max_order)) + ",\n" + COUNTS_CTE
