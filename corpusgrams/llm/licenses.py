"""License scans by ordered signature rules, with DataFrame functions only.

A text's words are lower-cased and joined by single spaces; a few hundred
regular expressions over that form say which licences it names.  They are built
from a list of licences (``LICENSES``: label, keyword, written name, short code)
times a list of sentence forms (``FORMS``), plus passages of licence texts
(``PASSAGES``).  A text is looked at only if it holds one of a few stems, and a
rule runs only if the text holds the rule's keyword.

Detections are intervals.  Where one lies inside another of equal or higher
priority it is suppressed, so "cc by nc" within "licensed under cc by nc sa 4 0"
does not count on its own.  The base phrases are kept beside this, always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, id_and_text
from .spans import find_spans

#: The contract's phrases and labels (fixed values).
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# label, keyword (in every form of the name), name as words, short code as words
LICENSES = (
    ("mit", "mit", "mit", "mit"),
    ("mit-0", "mit", "mit no attribution", "mit 0"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", "apache 1 1"),
    ("gpl-2", "2", "(?:gnu )?(?:gpl|general public license) ?(?:version |v)?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "3", "(?:gnu )?(?:gpl|general public license) ?(?:version |v)?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "2 1", "(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "3", "(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "3", "(?:gnu )?(?:agpl|affero general public license) ?(?:version |v)?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "free documentation", "gnu free documentation license", "gfdl 1 [123]"),
    ("bsd-2", "bsd", "(?:simplified bsd|2 clause bsd|bsd 2 clause|freebsd)", "bsd 2 clause"),
    ("bsd-3", "bsd", "(?:new bsd|modified bsd|revised bsd|3 clause bsd|bsd 3 clause)", "bsd 3 clause"),
    ("bsd-4", "bsd", "(?:original bsd|4 clause bsd|bsd 4 clause)", "bsd 4 clause"),
    ("mpl-2", "2", "(?:mozilla public license|mpl) ?(?:version |v)?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "1 1", "(?:mozilla public license|mpl) ?(?:version |v)?1 1", "mpl 1 1"),
    ("epl-1", "1", "(?:eclipse public license|epl) ?(?:version |v)?1(?: 0)?", "epl 1 0"),
    ("epl-2", "2", "(?:eclipse public license|epl) ?(?:version |v)?2(?: 0)?", "epl 2 0"),
    ("cddl-1", "1", "(?:common development and distribution license|cddl) ?(?:version |v)?1 [01]", "cddl 1 [01]"),
    ("eupl-1.2", "1 2", "(?:european union public licen[cs]e|eupl) ?(?:version |v)?1 2", "eupl 1 2"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib", "zlib"),
    ("boost-1", "1", "(?:boost software license|bsl) ?(?:version |v)?1 0", "bsl 1 0"),
    ("artistic-2", "2", "artistic license ?(?:version |v)?2(?: 0)?", "artistic 2 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("python-2", "python", "python software foundation(?: license)?(?: version 2)?", "psf 2 0"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("ofl-1.1", "1 1", "(?:sil )?(?:open font license|ofl) ?(?:version |v)?1 1", "ofl 1 1"),
    ("odbl-1", "odbl", "(?:open database license )?odbl", "odbl 1 0"),
    ("upl-1", "universal permissive", "universal permissive license(?: version 1 0)?", "upl 1 0"),
    ("ms-pl", "microsoft public", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license", "ms rl"),
    ("cc0", "cc0", "(?:creative commons )?cc0(?: 1 0)?", "cc0 1 0"),
    ("cc-by", "by", "cc by(?: [1234] 0)?", "cc by [1234] 0"),
    ("cc-by", "attribution", "creative commons attribution(?: [1234] 0)?", "cc by [1234] 0"),
    ("cc-by-sa", "sa", "cc by sa(?: [1234] 0)?", "cc by sa [1234] 0"),
    ("cc-by-sa", "share", "creative commons attribution share ?alike(?: [1234] 0)?", "cc by share alike"),
    ("cc-by-nd", "nd", "cc by nd(?: [1234] 0)?", "cc by nd [1234] 0"),
    ("cc-by-nd", "noderiv", "creative commons attribution noderiv(?:s|atives)(?: [1234] 0)?", "cc by noderivs"),
    ("cc-by-nc", "nc", "cc by nc(?: [1234] 0)?", "cc by nc [1234] 0"),
    ("cc-by-nc", "commercial", "creative commons attribution non ?commercial(?: [1234] 0)?", "cc by noncommercial"),
    ("cc-by-nc-sa", "nc sa", "cc by nc sa(?: [1234] 0)?", "cc by nc sa [1234] 0"),
    ("cc-by-nc-nd", "nc nd", "cc by nc nd(?: [1234] 0)?", "cc by nc nd [1234] 0"),
    ("public-domain", "public domain", "public domain", "public domain"),
)

# form, priority (1 to 8, higher wins), confidence; {n}: name, {c}: short code
FORMS = (
    (r" spdx license identifier {c}(?= )", 8, 1.0),
    (r" (?:licensed|released|distributed|published|provided|offered) under (?:the )?(?:terms of the )?{n}"
     r"(?: public)?(?: licen[cs]e)?(?= )", 7, 0.95),
    (r" (?:available|covered|governed) (?:under|by) (?:the )?(?:terms of the )?{n}(?: licen[cs]e)?(?= )", 6, 0.9),
    (r" under (?:the |an? )?(?:terms of the )?{n} licen[cs]e(?= )", 5, 0.9),
    (r" under (?:the )?{n}(?= )", 4, 0.8),
    (r" licen[cs]ed? (?:is )?(?:the )?{n}(?= )", 4, 0.8),
    (r" {n} licen[cs]e(?= )", 3, 0.7),
    (r" {n} licen[cs]ed(?= )", 2, 0.7),
)

# passages that belong to licence texts: label, keyword, pattern
PASSAGES = (
    ("mit", "hereby granted", r" permission is hereby granted free of charge to any person obtaining a copy(?= )"),
    ("isc", "with or without fee", r" permission to use copy modify and or distribute this software for any purpose with or without fee(?= )"),
    ("bsd", "redistribution", r" redistribution and use in source and binary forms with or without modification(?= )"),
    ("apache-2", "in compliance", r" you may not use this file except in compliance with the license(?= )"),
    ("gpl", "redistribute it", r" free software you can redistribute it and or modify it under the terms of the gnu general public license(?= )"),
    ("lgpl", "redistribute it", r" redistribute it and or modify it under the terms of the gnu lesser general public license(?= )"),
    ("mpl-2", "mozilla public", r" subject to the terms of the mozilla public license v ?2 0(?= )"),
    ("zlib", "as is", r" this software is provided as is without any express or implied warranty(?= )"),
    ("unlicense", "unencumbered", r" free and unencumbered software released into the public domain(?= )"),
    ("boost-1", "boost software", r" distributed under the boost software license(?= )"),
    ("gpl", "gnu general public", r" gnu general public license(?= )"),
    ("lgpl", "lesser general public", r" gnu lesser general public license(?= )"),
    ("agpl-3", "affero general public", r" gnu affero general public license(?= )"),
    ("mpl", "mozilla public", r" mozilla public license(?= )"),
    ("bsd", "bsd license", r" bsd license(?= )"),
    ("public-domain", "public domain", r" (?:released|placed|dedicated) (?:in|into|to) the public domain(?= )"),
    ("cc", "creative commons", r" creative commons licen[cs]e(?= )"),
    ("proprietary", "rights reserved", r" all rights reserved(?= )"),
)

#: A text without any of these stems cannot match a rule.
STEMS = ("licen", " under ", " available by ", " covered by ", " governed by ", "spdx", "hereby", "redistribut",
         "compliance", "with or without", "as is without", "unencumbered", "public domain", "rights reserved", "cc by")

WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # runs between words (the text's case is still there)


def rules() -> list[tuple[str, int, float, str, str]]:
    """(label, priority, confidence, keyword, pattern) of every rule."""
    out = [(label, priority, sure, keyword if "{n}" in form else "identifier " + code.split()[0], form.format(n=name, c=code))
           for label, keyword, name, code in LICENSES for form, priority, sure in FORMS]
    return list(dict.fromkeys(out)) + [(label, 1 if pattern.count(" ") < 6 else 6, 0.6 if pattern.count(" ") < 6 else 0.95, keyword, pattern)
                  for label, keyword, pattern in PASSAGES]


def spaced_words(text: Column) -> Column:
    """The words, lower-cased, each between single spaces; a single space if none."""
    return F.concat(F.lit(" "), F.ltrim(F.concat(F.trim(F.lower(F.regexp_replace(text, WORDS, " "))), F.lit(" "))))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(words: Column, phrase: str) -> Column:
    """struct<n, first, last>: places of one phrase; the word number of a place
    is the number of spaces before it."""
    pieces = F.split(words, f" {phrase}(?= )", -1)
    last = spaces(words) - spaces(F.element_at(pieces, -1)) - (phrase.count(" ") + 1)
    none = F.lit(None).cast("long")
    return F.when(F.contains(words, F.lit(f" {phrase} ")), F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"), spaces(pieces[0]).cast("long").alias("first"),
        last.cast("long").alias("last"),
    )).otherwise(F.struct(F.lit(0).cast("long").alias("n"), none.alias("first"), none.alias("last")))


_FOUND = "array<struct<start:int,back:int,low:int,label:string,confidence:double>>"


def _proposed(words: Column) -> Column:
    """Every match of every rule whose keyword occurs, ordered by start, longest
    and highest priority first (``back``: -end, ``low``: -priority)."""
    table = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(p).alias("priority"), F.lit(s).alias("confidence"),
                               F.lit(k).alias("keyword"), F.lit(x).alias("pattern")) for a, p, s, k, x in rules()])
    able = F.filter(table, lambda r: F.contains(words, r["keyword"]))
    found = F.transform(able, lambda r: F.transform(find_spans(words, r["pattern"]), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), (-r["priority"]).alias("low"),
        r["label"].alias("label"), r["confidence"].alias("confidence"))))
    return F.array_sort(F.flatten(found))


def _unsuppressed(found: Column) -> Column:
    """One pass over the ordered matches: ``ends`` holds, by priority, the
    furthest end so far; a match that ends before that of an equal or higher
    priority lies inside it."""
    def step(acc: Column, d: Column) -> Column:
        inside = F.exists(F.slice(acc["ends"], -d["low"], F.lit(8)), lambda e: e >= -d["back"])
        ends = F.transform(acc["ends"], lambda e, i: F.when(i == -d["low"] - 1, F.greatest(e, -d["back"])).otherwise(e))
        return F.struct(ends.alias("ends"),
                        F.when(inside, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"))

    first = F.struct(F.array(*[F.lit(-1)] * 8).alias("ends"), F.expr(f"cast(array() as {_FOUND})").alias("kept"))
    return F.aggregate(found, first, step, lambda acc: acc["kept"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, base (n, first, last by label) and
    detections (label, confidence, first and last word).

    Null and empty texts have no words and no detections.  Repeated rows get
    equal results, null ids are passed through, other columns are ignored, an
    empty table gives no rows.  One pass, no shuffle."""
    texts = id_and_text(docs).select("doc_id", spaced_words(F.col("text")).alias("words"))
    words = F.col("words")
    worth = F.contains(words, F.lit(STEMS[0]))
    for stem in STEMS[1:]:
        worth = worth | F.contains(words, F.lit(stem))
    base = F.array(*[_base(words, p) for p in BASE])
    found = texts.select(
        "doc_id", "words", (spaces(words) - 1).cast("long").alias("n_words"), base.alias("base"),
        F.when(worth, _proposed(words)).otherwise(F.expr(f"cast(array() as {_FOUND})")).alias("proposed"),
    )
    kept = found.select("doc_id", "n_words", "base", "words", _unsuppressed(F.col("proposed")).alias("kept"))
    return kept.select("doc_id", "n_words", "base", F.transform("kept", lambda d: F.struct(
        d["label"].alias("label"), d["confidence"].alias("confidence"),
        spaces(F.substring(words, F.lit(1), d["start"])).alias("first_word"),
        (spaces(F.substring(words, F.lit(1), -d["back"])) - 1).alias("last_word"))).alias("detections"))


# --- registered query --------------------------------------------------------


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    names = F.array(*[F.lit(v) for v in BASE.values()])
    base_labels = F.filter(F.zip_with(names, "base", lambda n, b: F.when(b["n"] > 0, n)), lambda n: n.isNotNull())
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return found.select(
        "doc_id", "n_words",
        F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.greatest(
            F.when(F.size(base_labels) > 0, 1.0).otherwise(0.0),
            F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)),
        ).alias("score"),
    )
