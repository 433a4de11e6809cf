"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans; validators confirm them (octets of an IP
address, Luhn for cards, digit counts of phones, mod 97 for IBANs, number ranges
of social security numbers); words near a span move its score.  Base kinds stay
whatever their score; the method's own kinds (iban, ssn) need ``ACCEPT_AT``.

The patterns are the contract's, written so that no text makes them slow or
deep: possessive runs, and a run is entered at its beginning or where the last
match ended (``\\G``), which finds the same leftmost matches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, fresh, id_and_text
from .spans import spans_where

BEFORE, AFTER = 40, 24  # characters around a span that count as near
ACCEPT_AT = 0.5
BASE_KINDS = ("email", "ip", "card", "phone")


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the check digit fits: every second digit from the right doubled."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        v = F.substring(digits, i, F.lit(1)).cast("int")
        twice = 2 * v - F.when(v > 4, 9).otherwise(0)
        return total + F.when((n - i) % 2 == 0, v).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod_97(found: Column) -> Column:
    """True if an IBAN, its first four characters put last and letters read as
    10 to 35, leaves 1."""
    turned = F.concat(F.substring(found, F.lit(5), F.length(found)), F.substring(found, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        return F.when(c.rlike("[0-9]"), rest * 10 + c.try_cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """A kind of span: pattern, cheap test of the text, validator of a match,
    score without context, and context words that raise or lower it."""

    name: str
    pattern: str
    gate: str  # SQL over the column `text`
    valid: str  # name of the rule below
    prior: float
    near: str
    against: str


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "contains(text, '@')", "any", 0.8, "mail|contact|write|reach|address", "example|noreply|version"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
         r"text RLIKE '[0-9]\\.[0-9]+\\.[0-9]'", "octets", 0.6, r"\bip\b|host|server|address|login|client", "version|section|chapter"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"text RLIKE '[0-9](?:[ -]?[0-9]){15}'", "luhn", 0.8,
         "card|visa|credit|debit|payment|amex", "order|invoice|isbn|tracking"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')", "phone", 0.6,
         "phone|call|tel|mobile|fax|contact", "sum|total|score"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
         "text RLIKE '[A-Z]{2}[0-9]{2}[A-Z0-9]{11}'", "mod_97", 0.8, "iban|bank|account|transfer|swift", "key|token|hash"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "text RLIKE '[0-9]{3}-[0-9]{2}-[0-9]{4}'",
         "ssn", 0.3, r"ssn|social security|social insurance|tax id", "part|serial|order"),
)


def _valid(rule: str, found: Column) -> Column:
    if rule == "octets":
        return found.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if rule == "luhn":
        d = digits_of(found)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))
    if rule == "phone":
        return F.length(digits_of(found)).between(8, 15)
    if rule == "mod_97":
        return mod_97(found)
    if rule == "ssn":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _scored(kind: Kind, order: int, text: Column, span: Column) -> Column:
    begin = F.greatest(span["start"] - BEFORE, F.lit(0))
    near = F.lower(F.concat_ws(" ", F.substring(text, begin + 1, span["start"] - begin),
                               F.substring(text, span["end"] + 1, F.lit(AFTER))))
    score = (F.lit(kind.prior) + F.when(near.rlike(kind.near), 0.3).otherwise(0.0)
             - F.when(near.rlike(kind.against), 0.2).otherwise(0.0))
    return F.struct(F.lit(order).alias("kind_no"), F.lit(kind.name).alias("kind"), span["start"].alias("start"),
                    span["end"].alias("end"), F.greatest(F.least(F.round(score, 2), F.lit(1.0)), F.lit(0.0)).alias("score"))


def personal_spans(text: Column) -> Column:
    """``array<struct<kind_no, kind, start, end, score>>`` by kind, then start.

    ``text`` must be the column of that name: the gates are SQL over it."""
    return F.concat(*(_spans_of(kind, i, text) for i, kind in enumerate(KINDS)))


def _spans_of(kind: Kind, order: int, text: Column) -> Column:
    raw = spans_where(F.expr(kind.gate), text, F.lit(kind.pattern))
    good = F.filter(raw, lambda s: _valid(kind.valid, s["found"]))
    scored = F.transform(good, lambda s: _scored(kind, order, text, s))
    return scored if kind.name in BASE_KINDS else F.filter(scored, lambda s: s["score"] >= ACCEPT_AT)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and its spans; one row per document, also without spans.

    Null and empty texts have none.  Repeated rows get equal results, null ids
    are passed through, other columns are ignored, an empty table gives no
    rows.  One pass over the rows, no shuffle."""
    return id_and_text(docs).select("doc_id", personal_spans(F.col("text")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones as one) replaced by its kind in
    angle brackets, such as ``<EMAIL>``."""
    in_order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("to"), s["kind"].alias("kind"))))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        new = F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                      F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.struct(F.greatest(acc["at"], -s["to"]).alias("at"),
                        F.when(apart, F.concat(acc["out"], new)).otherwise(acc["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    return F.aggregate(in_order, first, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in ``text``; a text
    without any, or null, is left as it is.  ``n_chars``, if there is one, is
    counted again where the text changed."""
    spans = fresh(docs, "personal_spans")
    found = docs.select(
        "*", personal_spans(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(spans))
    some = F.size(spans) > 0
    text = F.when(some, redacted(F.col("text"), F.col(spans))).otherwise(F.col("text"))
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    for c in docs.columns:
        if c.lower() == "text":
            out[c] = text
        elif c.lower() == "n_chars":
            out[c] = F.when(some, F.length(text)).otherwise(F.col(f"`{c}`")).cast(docs.schema[c].dataType)
    return found.select(*[v.alias(c) for c, v in out.items()])


# --- registered query --------------------------------------------------------


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"))
