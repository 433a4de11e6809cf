"""Column expressions for cleaning, sentence splitting and tokenising text.

Every pattern here is written once and used by both the Spark expressions and
the DuckDB oracle strings (``plans/sqltext.py``), so both engines run the same
regular expressions.  Java regex (Spark) and RE2 (DuckDB) agree on all of them;
where they differ (``\\s``, ``\\W``) the classes are spelled out explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for the same results)
# ---------------------------------------------------------------------------

# Reserved tokens: begin of sentence, end of sentence, unknown word.
TOKEN_BOS = "__bos__"
TOKEN_EOS = "__eos__"
TOKEN_UNK = "__unk__"

# Line filter of ``clean_text``: a line is dropped when it matches.
CLEAN_TEXT_PATTERN = (
    r"^[0-9\W]+$|^rt$|^lol$|^_+$|^[0-9\._]{2,}$|class=\.*|style=\.*"
)
# Earlier notebook variant of the same filter (first class is digits only).
CLEAN_TEXT_V1_PATTERN = (
    r"^[0-9]+$|^rt$|^lol$|^_+$|^[0-9\._]{2,}$|class=\.*|style=\.*"
)
# Characters removed by ``basic_clean_text``.  ``\)-=`` is a range: it also
# removes * + , - . / 0-9 : ; < (kept literally, as in the reference).
BASIC_CLEAN_PATTERN = r"""([@#$%^&\*\(\)-=_\+,<>`\[\]\{\}"'\\])"""
# Leading numeric runs / underscore-only lines removed before tokenising.
NUMERIC_PREFIX_PATTERN = r"^_+$|^[0-9._]{2,}"
# Tokens rejected by the exploration notebooks before taking the first
# ``[a-z']+`` run of a token.
TOKEN_REJECT_PATTERN = (
    r"^[0-9]+$|^it’s$|^don’t$|^i’m$|^rt$|^lol$|^_+$|^[0-9\._]{2,}$"
)
TOKEN_KEEP_PATTERN = r"[a-z']+"
# Words left out of the first notebook's ten most frequent (fixed value).
TOP_WORD_REJECT_PATTERN = r"^[0-9]+$|^it’s$|^don’t$|^i’m$|^rt$|^lol$"
# Trigram / n-gram stop patterns of the exploration notebooks.
NGRAM_STOP_PATTERN = (
    r"^amazon[\. ].*$|omg omg omg|cake cake cake|rt rt rt|ass ass ass|"
    r"follow follow follow"
)
# Further n-gram filters of the notebooks (fixed values).
TOP_TRIGRAM_STOP_PATTERN = r"^NA NA NA$|^amazon[\. ]"
WORD_DIGIT_PATTERN = "[0-9 ]"
BIGRAM_STOP_PATTERN = "NA NA|([0-9]+) ([0-9]+)|rt rt|lol rt"
TRIGRAM_STOP_PATTERN = (
    r"^amazon[\. ].*$|omg omg omg|cake cake cake|rt rt rt|ass ass ass|follow follow follow|"
    r"^NA NA NA$|^amazon[\. ]|([0-9]+) ([0-9]+) ([0-9]+)"
)

# Spark's public default English stop-word list
# (``StopWordsRemover.loadDefaultStopWords("english")``), inlined so that the
# DuckDB oracle can use the same 181 words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he "
    "him his himself she her hers herself it its itself they them their theirs "
    "themselves what which who whom this that these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t can "
    "will just don should now i'll you'll he'll she'll we'll they'll i'd you'd "
    "he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't "
    "doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot "
    "could here's how's let's ought that's there's what's when's where's who's "
    "why's would"
).split(" ")

# ---------------------------------------------------------------------------
# Tokeniser definition (replaces ICU word/sentence boundaries; same in both
# engines).  A word is a run of letters, marks, digits or underscores, which
# may contain single inner dots or apostrophes: keeps don't, 3.5, u.s.a and
# the reserved tokens; splits e-mail and a:b; drops # and @.
# ---------------------------------------------------------------------------
WORD_PATTERN = r"[\p{L}\p{M}\p{N}_]+(?:[.'’][\p{L}\p{M}\p{N}_]+)*"
# Whitespace, spelled out (Java's and RE2's \s differ on \x0B).
WS = r"[\t\n\x0B\f\r ]"
# Sentence ends: ?/! runs (with closing quotes/brackets) before blanks, and a
# dot run before blanks that are followed by anything but a lower-case letter.
SENT_BANG_PATTERN = r"([!?]+[)\"'”’]*)" + WS + "+"
SENT_DOT_PATTERN = r"(\.[.)\"'”’]*)" + WS + r"+([^\p{Ll}\t\n\x0B\f\r ])"
# A line holds a sentence when it has a non-blank character.
NON_BLANK_PATTERN = r"[^\t\n\x0B\f\r ]"
# URLs stripped by the tweet tokeniser branch.
URL_PATTERN = r"(?:https?|ftp)://[^\t\n\x0B\f\r ]+|www\.[^\t\n\x0B\f\r ]+"
# Tweet tokens: words with an optional leading # or @.
TWEET_TOKEN_PATTERN = r"[#@]?" + WORD_PATTERN


# ---------------------------------------------------------------------------
# Cleaning expressions
# ---------------------------------------------------------------------------
def is_junk_line(text: Column, pattern: str = CLEAN_TEXT_PATTERN) -> Column:
    """TRUE when ``clean_text`` drops the line (Unicode-aware ``\\W``)."""
    return text.rlike("(?U)" + pattern)


def basic_clean(text: Column) -> Column:
    """``basic_clean_text``: remove the punctuation class and DEL (0x7F)."""
    return F.regexp_replace(
        F.regexp_replace(text, BASIC_CLEAN_PATTERN, ""), "\u007f", ""
    )


def clean_file_text(text: Column) -> Column:
    """``clean_files`` on one string: NUL->blank, drop non-ASCII, SUB, digits,
    \\x01, then the reserved tokens (in that order), then DEL."""
    t = F.regexp_replace(text, "\u0000", " ")
    t = F.regexp_replace(t, r"[^\x00-\x7F]|[\x01\x1A0-9]", "")
    t = F.regexp_replace(t, "__bos__ ", "")
    t = F.regexp_replace(t, " __eos__", "")
    t = F.regexp_replace(t, "__unk__", "")
    return F.regexp_replace(t, "\u007f", "")


def strip_first(text: Column, literal_char: str) -> Column:
    """Remove only the first occurrence of a character (``str_remove``)."""
    return F.regexp_replace(text, "(?s)^(.*?)" + literal_char, "$1")


# ---------------------------------------------------------------------------
# Sentences and tokens
# ---------------------------------------------------------------------------
def mark_sentence_breaks(text: Column) -> Column:
    """``".,"`` -> ``". "`` then a newline at every sentence end."""
    t = F.regexp_replace(text, r"\.,", ". ")
    t = F.regexp_replace(t, SENT_BANG_PATTERN, "$1\n")
    return F.regexp_replace(t, SENT_DOT_PATTERN, "$1\n$2")


def split_sentences(text: Column) -> Column:
    """Array of the non-blank sentences of one line (order kept)."""
    parts = F.split(mark_sentence_breaks(text), "\n")
    return F.filter(parts, lambda s: s.rlike(NON_BLANK_PATTERN))


def words(text: Column) -> Column:
    """Lower-cased word tokens of a string as ``array<string>``."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)


def with_markers(tokens: Column, with_eos: bool = True) -> Column:
    """Wrap a token array in ``__bos__`` / ``__eos__``."""
    head = F.array(F.lit(TOKEN_BOS))
    if with_eos:
        return F.concat(head, tokens, F.array(F.lit(TOKEN_EOS)))
    return F.concat(head, tokens)


def squish(text: Column) -> Column:
    """``str_squish``: collapse whitespace runs, trim the ends."""
    return F.regexp_replace(
        F.regexp_replace(text, WS + "+", " "), "^ | $", ""
    )


def source_name(file: Column) -> Column:
    """``from`` = file name without the ``en_US.`` prefix and ``.txt``."""
    return strip_first(strip_first(file, r"en_US\."), r"\.txt")
