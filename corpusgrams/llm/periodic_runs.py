"""Runs of periodically repeated words, from suffixes united by descending common prefixes.

A run of period q that covers start..end makes the suffixes at start and
start + q agree in exactly end - start - q words.  So the suffixes of a text are
united like Kruskal's edges: neighbours in the suffix order, the longest common
prefix (LCP) first, by union-find over classes that are kept as ordered lists of
positions.  When two classes are united at LCP L, two positions that become
neighbours and lie at most L apart seed a run: its period is their distance (no
position lies between, so no smaller period fits), its length is distance + L.
A seed whose run could be extended to the left is a later position of a run
that is seeded elsewhere, and is dropped.

A run of at least ``min_length`` words and ``min_exponent`` periods needs a
common prefix of some words at least, so only suffixes whose first words repeat
in their text are united.  Suffix orders and prefixes come from prefix doubling
in numpy, over all texts of an Arrow slice at once; texts without such a repeat
leave after the first steps.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_arrow_batches, text_slices
from .words import Words

MIN_LENGTH, MIN_EXPONENT = 6, 4
RUNS = "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_prefix(min_length: int, min_exponent: int) -> int:
    """The smallest LCP that seeds a wanted run: its length less its period."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


# --- suffix order (numpy, many texts) --------------------------------------------


def repeating(ids: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Positions whose ``width`` words occur again in the same text."""
    at, now = np.arange(len(ids)), ids
    done = 1
    key = text * (int(ids.max(initial=0)) + 1) + ids
    while True:
        number = pd.factorize(key)[0]
        twice = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
        at, number = at[twice], number[twice].astype(np.int64)
        if done >= width or not len(at):
            return at
        step = min(done, width - done)  # two windows of ``done`` words, overlapping in the last step
        now = np.full(len(ids) + width, -1, np.int64)
        now[at] = number
        follows = now[at + step]
        same = follows >= 0
        same &= text[np.minimum(at + step, len(text) - 1)] == text[at]
        at, number, follows = at[same], number[same], follows[same]
        key = number * (int(follows.max(initial=0)) + 1) + follows
        done += step


def suffix_order(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in suffix order (text by text), and the LCP of each with the
    one before (0 at a text's first)."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = np.searchsorted(text, text, side="right")  # end of each position's text
    rank = np.unique(text * (int(ids.max()) + 1) + ids, return_inverse=True)[1]
    levels, width, live = [rank], 1, np.arange(n)
    while True:
        # texts all of whose ranks differ are in order; their positions rank as they are from now on
        repeats = np.bincount(rank)[rank] > 1
        open_text = np.zeros(int(text[-1]) + 1, bool)
        open_text[text[live[repeats]]] = True
        keep = open_text[text[live]]
        if not keep.any():
            break
        live, rank = live[keep], rank[keep]
        here = np.full(n, -1, np.int64)
        here[live] = rank
        beyond = live + width >= after[live]
        second = np.where(beyond, -1, here[np.minimum(live + width, n - 1)]) + 1
        rank = np.unique(rank * (int(second.max()) + 1) + second, return_inverse=True)[1]
        level = -1 - np.arange(n)  # no two equal
        level[live] = rank
        levels.append(level)
        width *= 2
    # a text's order is that of its ranks at the last level it took part in; equal first ranks never part texts
    final = np.empty(n, np.int64)
    for level in levels:
        final[level >= 0] = level[level >= 0]
    order = np.lexsort((final, text))
    one, two = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        inside = (one < after[order[:-1]]) & (two < after[order[1:]])
        same = inside & (level[np.minimum(one, n - 1)] == level[np.minimum(two, n - 1)])
        step = np.where(same, 1 << k, 0)
        lcp[1:] += step
        one, two = one + step, two + step
    lcp[1:][text[order[:-1]] != text[order[1:]]] = 0
    return order, lcp


# --- Kruskal over suffix classes -------------------------------------------------


def seeds(order: np.ndarray, lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(p, q, L) for positions p < q that become neighbours in a class united at LCP L >= q - p."""
    edge = np.flatnonzero(lcp >= least)
    edge = edge[np.argsort(-lcp[edge], kind="stable")]
    nodes = np.unique(np.concatenate([edge - 1, edge]))
    parent = list(range(len(nodes)))
    members = [[p] for p in order[nodes].tolist()]
    left, right = np.searchsorted(nodes, edge - 1).tolist(), np.searchsorted(nodes, edge).tolist()

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b, common in zip(left, right, lcp[edge].tolist()):
        a, b = root(a), root(b)
        big, small = members[a], members[b]
        if len(big) < len(small):
            a, b, big, small = b, a, small, big
        parent[b], members[b] = a, []
        places = [bisect_left(big, x) for x in small]
        for k, (x, i) in enumerate(zip(small, places)):
            if i:
                p = big[i - 1]
                if x - p <= common and not (k and small[k - 1] > p):
                    yield p, x, common
            if i < len(big):
                q = big[i]
                if q - x <= common and not (k + 1 < len(small) and small[k + 1] < q):
                    yield x, q, common
        if 8 * len(small) > len(big):
            big += small
            big.sort()
        else:
            for x, i in zip(reversed(small), reversed(places)):
                big.insert(i, x)


def find_runs(ids: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, sorted; ``ids`` are the words of many
    texts end to end, ``text`` the (ascending) text of each; starts count over all."""
    least = least_prefix(min_length, min_exponent)
    at = repeating(ids, text, least)
    if not len(at):
        return []
    some = np.zeros(int(text[-1]) + 1, bool)
    some[text[at]] = True
    place = np.flatnonzero(some[text])  # the words of texts with a repeat
    order, lcp = suffix_order(ids[place], text[place])
    words, owner = ids[place].tolist(), text[place].tolist()
    out = []
    for p, q, common in seeds(order, lcp, least):
        length = q - p + common
        if length >= max(min_length, min_exponent * (q - p)) and not (
                p and owner[p - 1] == owner[p] and words[p - 1] == words[q - 1]):
            out.append((int(place[p]), length, q - p))
    return sorted(out)


# --- the operator ----------------------------------------------------------------


def _runs(min_length: int, min_exponent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in text_slices(batch):
            w = Words(s.column("text"))
            first = w.first.tolist()
            runs: list[list[dict]] = [[] for _ in first]
            kept = np.ones(len(w.start), bool)
            found = find_runs(w.ids, w.text, min_length, min_exponent)
            for start, length, period in found:
                kept[start + period:start + length] = False
                i = int(w.text[start])
                runs[i].append({"start": start - first[i], "length": length, "period": period})
            strings, end = w.strings, (w.first + w.per_text).tolist()
            collapsed = [b" ".join(strings[a:b] if not r else
                                   [x for x, k in zip(strings[a:b], kept[a:b].tolist()) if k])
                         for a, b, r in zip(first, end, runs)]
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(w.per_text, pa.int64()), pa.array(runs, pa.list_(_RUN)),
                 pa.array([c.decode() for c in collapsed], pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; sorted by start, then period), collapsed.

    A run is a stretch of words (separated by ASCII white space) with smallest
    period q and at least max(``min_length``, ``min_exponent`` * q) words that
    no neighbouring word extends; ``min_exponent`` is at least 2.  ``collapsed``
    holds the words, joined by single spaces, that no run contains after its
    first q words.  Null, empty and blank texts have no words, no runs and an
    empty ``collapsed``.  Repeated rows and null ids are passed through, other
    columns ignored; an empty table gives no rows.  A text is worked on whole,
    in memory proportional to its length.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least once: min_exponent >= 2")
    small_arrow_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return rows.mapInArrow(functools.partial(_runs, min_length, min_exponent), RUNS)


# --- registered query ------------------------------------------------------------


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The contract's texts: in a tenth of the documents (by a hash of the id) the
    words from some place on repeat the words at that place."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                       F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    head = F.slice("words", 1, a)
    unit = F.slice("words", a + 1, p)
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(unit, times)), 1, n - a)
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " "))
                       .otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(documents(spark, sf_dir)))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("shorter"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.shorter")).alias("period"),
        F.expr("1000 * best.length div -best.shorter").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
