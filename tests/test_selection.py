"""Selection from counts of counts and from hash histograms, against plain Python."""

import hashlib
import math
from collections import Counter

import pytest

from corpusgrams.functions import text as T
from corpusgrams.operators import model as M
from corpusgrams.operators import splits as P

COUNTS = "order int, begins string, ends string, ngram_count bigint"


def gram(words, n):
    return (len(words), " ".join(words[:-1]) or words[0], words[-1], n)


def trimmed(rows, prop):
    """The rule, word by word."""
    words = sorted((n, e) for o, b, e, n in rows if o == 1)
    low = {w for _, w in words[: math.floor(len(words) * prop)]}
    out = Counter()
    for o, b, e, n in rows:
        ws = [T.TOKEN_UNK if w in low else w for w in ([e] if o == 1 else [*b.split(" "), e])]
        o2, b2, e2, _ = gram(ws, 0)
        out[(o2, b2, e2)] += n
    return sorted((*k, n) for k, n in out.items())


WORDS = {"the": 9, "cat": 3, "sat": 1, "mat": 1, "on": 1, "dog": 3, T.TOKEN_UNK: 5}
ROWS = [gram([w], n) for w, n in WORDS.items()] + [
    gram(["the", "cat"], 3), gram(["the", "dog"], 2), gram(["cat", "sat", "on"], 1), gram(["mat", "mat"], 1),
    gram(["sat", "on", "the", "mat"], 1), gram(["on", "sat", "the", "mat"], 1), gram([T.TOKEN_UNK, "the"], 4),
    gram(["mat", "the"], 1), gram(["the", "the", "the", "cat", "dog"], 1)]


@pytest.mark.parametrize("prop", [0.0, 0.2, 0.3, 0.5, 0.6, 1.0])
def test_trim_by_classes(spark, prop):
    got = M.trim_unknown(spark.createDataFrame(ROWS, COUNTS), prop).select("order", "begins", "ends", "ngram_count")
    assert sorted(map(tuple, got.collect())) == trimmed(ROWS, prop)


def test_trim_of_nothing(spark):
    assert M.trim_unknown(spark.createDataFrame([], COUNTS), 0.4).count() == 0


@pytest.mark.parametrize("fractions", [(0.5, 0.9), (0.0, 1.0), (0.39, 0.4, 0.41)])
def test_coverage_by_classes(spark, fractions):
    ns = sorted(WORDS.values(), reverse=True)
    want = [(f, next(i for i in range(1, len(ns) + 1) if sum(ns[:i]) >= f * sum(ns))) for f in fractions]
    got = M.coverage(spark.createDataFrame(ROWS, COUNTS), fractions).collect()
    assert [(r.fraction, r.n_words) for r in got] == want


def test_coverage_of_nothing(spark):
    got = M.coverage(spark.createDataFrame([], COUNTS)).collect()
    assert [r.n_words for r in got] == [None, None]


def h(seed, *key):
    return hashlib.md5(":".join(map(str, (seed, *key))).encode()).hexdigest()


def test_split_takes_the_smallest_hashes_of_null_strata_too(spark):
    rows = [(i, ["a", "b", None, "single"][i % 3 if i else 3]) for i in range(400)]
    got = P.stratified_split(spark.createDataFrame(rows, "id int, s string"), "s", ["id"], 7, 0.75)
    train = {r.id for r in got.filter("split = 'training'").collect()}
    want = set()
    for s in {s for _, s in rows}:
        ids = sorted((h(7, i), i) for i, t in rows if t == s)
        want |= {i for _, i in ids[: math.floor(len(ids) * 0.75)]}
    assert train == want and got.count() == 400


@pytest.fixture()
def many_groups(monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_GROUPS", 0)


def test_split_without_broadcast(spark, many_groups):
    test_split_takes_the_smallest_hashes_of_null_strata_too(spark)


def corpus(spark, n=900):
    rows = [(i, 0, f"f{i % 2}", "" if i % 7 == 0 else f"line {i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, line_no int, file string, text string")


@pytest.mark.parametrize("prop", [0.33, 1, 0.001])
def test_sample_of_chunks(spark, monkeypatch, prop):
    monkeypatch.setattr(P, "CHUNK_LINES", 100)
    rows, lines = corpus(spark)
    want = []
    for f in ("f0", "f1"):
        own, taken = [r for r in rows if r[2] == f], []
        for c in range(0, len(own), 100):
            chunk = own[c:c + 100]
            if prop != 1:
                chunk = sorted(chunk, key=lambda r: h(1212, r[0], r[1]))[: math.floor(len(chunk) * prop)]
            taken += [(*r, c // 100) for r in chunk if r[3]]
        want += [(*r, i + 1) for i, r in enumerate(taken)]
    cols = ["doc_id", "line_no", "file", "text", "chunk", "rnum"]
    plain = P.sample_lines(lines, prop=prop).select(*cols)
    hooked = P.sample_lines(lines, prop=prop, postprocess=lambda d: d.filter("text <> ''")).select(*cols)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, hooked.collect())) == sorted(want)


def test_texts_meet_one_exchange(spark):
    """Below the last join only keys, hashes and flags are exchanged."""
    _, lines = corpus(spark)
    plan = P.sample_lines(lines)._jdf.queryExecution().executedPlan().toString()
    top = [x for x in plan.splitlines() if "Exchange" in x]
    assert top and len([x for x in plan.splitlines() if "text#" in x and "Window" in x]) == 0


def test_sample_by_is_a_filter(spark):
    rows, lines = corpus(spark)
    got = P.sample_by(lines, "file", {"f0": 1.0, "f1": 0.25}, ["doc_id", "line_no"], 3)
    want = {r[0] for r in rows if r[2] == "f0" or int(h(3, r[0], r[1])[:8], 16) < 0.25 * 16 ** 8}
    assert {r.doc_id for r in got.collect()} == want
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
