"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from corpusgrams.llm import periodic_runs as R
from corpusgrams.llm.queries import QUERIES


def brute(words, min_length=6, min_exponent=4):
    n, out = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(min_length, min_exponent * q) and not any(
                    all(words[k] == words[k + d] for k in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def split(text):
    return (text or "").encode().split()  # bytes: exactly ASCII white space


def planted(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def kept(words, runs):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + size for s, size, q in runs)]


def row(doc_id, words):
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(kept(words, runs))))


def key(r):
    return tuple((v is None, 0 if v is None else v) for v in r)


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (6, 3), (1, 2), (10, 2)])
def test_runs_match_brute_force(least, times):
    r = random.Random(least * 10 + times)
    for _ in range(25):
        texts = []
        for _ in range(30):
            k = r.choice([1, 2, 3, 5])
            w = [r.randrange(k) for _ in range(r.randrange(40))]
            if r.random() < 0.6 and w:
                w = w[:r.randrange(len(w))] + w[:r.randrange(1, 6)] * r.randrange(1, 9) + w[:3]
            texts.append(w)
        ids = np.array([x for t in texts for x in t], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        want, at = [], 0
        for t in texts:
            want += [(s + at, n, q) for s, n, q in brute(t, least, times)]
            at += len(t)
        assert R.find_runs(ids, text, least, times) == sorted(want)


def test_suffix_order_and_prefixes():
    r = random.Random(4)
    for _ in range(100):
        texts = [[r.randrange(3) for _ in range(r.randrange(1, 30))] for _ in range(5)]
        ids = np.array([x for t in texts for x in t])
        text = np.repeat(np.arange(5), [len(t) for t in texts])
        order, lcp = R.suffix_order(ids, text)
        end = np.cumsum([len(t) for t in texts])
        suffix = [(int(text[i]), ids[i:end[text[i]]].tolist()) for i in order]
        assert suffix == sorted(suffix)
        for k in range(1, len(order)):
            (t, x), (u, y) = suffix[k - 1], suffix[k]
            common = next((i for i, (v, w) in enumerate(zip(x, y)) if v != w), min(len(x), len(y)))
            assert lcp[k] == (common if t == u else 0)


def test_seeds_need_few_words_of_prefix():
    assert R.least_prefix(6, 4) == 5
    assert R.least_prefix(1, 2) == 1


def test_query_matches_brute_force(spark, sf, docs):
    want = [row(r.doc_id, planted(r.doc_id, r.text)) for r in docs.collect()]
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in got) >= 5


def test_edge_rows(spark, edge, nothing):
    words = "a b a b a b a b c " * 3
    more = spark.createDataFrame(
        [(50, words), (51, "z " * 6), (52, "z " * 5), (53, "p q r " * 4 + "p"), (54, "x y z w " * 3), (55, "é\u0085é " * 9)],
        "doc_id long, text string")
    df = edge.filter("length(text) < 10000 OR text IS NULL").unionByName(more, allowMissingColumns=True)
    rows = df.select("doc_id", "text").collect()
    got = {}
    for r in R.periodic_runs(df.repartition(3)).collect():
        got.setdefault((r.doc_id, r.n_words), []).append(([tuple(x) for x in r.runs], r.collapsed))
    for r in rows:
        w = split(r.text)
        runs = brute(w)
        assert (runs, b" ".join(kept(w, runs)).decode()) in got[r.doc_id, len(w)]
    assert sum(len(v) for v in got.values()) == len(rows)
    assert R.periodic_runs(nothing).count() == 0


def test_very_long_texts(spark):
    df = spark.createDataFrame([(1, "1 " * 200_000), (2, " ".join(f"w{i % 700}" for i in range(70_000)))],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in R.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 200_000, 1)] and got[1].collapsed == "1"
    assert [tuple(x) for x in got[2].runs] == [(0, 70_000, 700)] and got[2].collapsed.count(" ") == 699


def test_too_small_an_exponent_is_refused(spark, nothing):
    with pytest.raises(ValueError):
        R.periodic_runs(nothing, 6, 1)


def test_planted_texts(spark, edge, docs):
    for df in (edge, docs):
        rows = {(r.doc_id, r.text) for r in R.with_planted_runs(df).collect()}
        for r in df.select("doc_id", "text").collect():
            assert any(i == r.doc_id and split(t) == planted(r.doc_id, r.text) for i, t in rows)
