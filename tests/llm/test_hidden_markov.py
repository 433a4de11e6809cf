"""The hidden Markov model against enumeration of paths and a plain one-text-at-a-time version."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusgrams.llm import hidden_markov as H
from corpusgrams.llm.queries import QUERIES


def some_model(classes, states, seed):
    r = np.random.default_rng(seed)
    m = H.Model(r.random(states), r.random((states, states)), r.random((classes, states)))
    return H.Model(m.start / m.start.sum(), m.move / m.move.sum(1, keepdims=True), m.emit / m.emit.sum(0))


def paths(m, text):
    """(path, probability of path and text) for every path."""
    for path in itertools.product(range(len(m.start)), repeat=len(text)):
        p = m.start[path[0]] * m.emit[text[0], path[0]]
        for a, b, c in zip(path, path[1:], text[1:]):
            p *= m.move[a, b] * m.emit[c, b]
        yield path, p


TEXTS = [[0, 2, 1], [3], [1, 1, 2, 0, 3], [2, 0], [3, 3, 3, 3]]


def flat(texts):
    return np.array([x for t in texts for x in t], np.int64), np.array([len(t) for t in texts])


def test_forward_is_the_sum_over_all_paths():
    m = some_model(4, 3, 1)
    got = H.log_likelihood(m, *flat(TEXTS))
    assert np.allclose(got, [math.log10(sum(p for _, p in paths(m, t))) for t in TEXTS])


def test_expected_counts_are_those_over_all_paths():
    m = some_model(4, 3, 2)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for t in TEXTS:
        total = sum(p for _, p in paths(m, t))
        for path, p in paths(m, t):
            start[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                move[a, b] += p / total
            for c, s in zip(t, path):
                emit[c, s] += p / total
    got = H.baum_welch(m, *flat(TEXTS))
    assert all(np.allclose(x, y) for x, y in zip(got, (start, move, emit)))


def test_probabilities_of_all_texts_sum_to_one():
    """Class 0 ends a text: the texts of up to n classes and what goes on after n share 1."""
    m = some_model(3, 2, 3)
    total, alive = 0.0, m.start.copy()
    texts = [[*mid, 0] for n in range(7) for mid in itertools.product((1, 2), repeat=n)]
    total = (10 ** H.log_likelihood(m, *flat(texts))).sum()
    for k in range(7):
        alive = (alive if k == 0 else alive @ m.move) * (m.emit[1] + m.emit[2])
    assert abs(total + alive.sum() - 1) < 1e-9


def test_steps_never_lose_likelihood(monkeypatch):
    monkeypatch.setattr(H, "PRIOR", 1e-9)
    r = np.random.default_rng(5)
    texts = [r.integers(0, 6, r.integers(1, 30)).tolist() for _ in range(40)]
    classes, size = flat(texts)
    m, before = some_model(6, 3, 4), -math.inf
    for _ in range(15):
        now = H.log_likelihood(m, classes, size).sum()
        assert now >= before - 1e-9
        before, m = now, H.next_model(*H.baum_welch(m, classes, size), np.full(6, 1 / 6))


def test_shares_of_a_class_sum_to_one():
    for count in ([3, 1, 1], [7], [2, 2]):
        n, v = sum(count), len(count)
        share = lambda c: H.log_share(np.array([c]), np.array([n]), np.array([v]), np.array([False]))[0]
        assert abs(sum(10 ** share(c) for c in [*count, 0]) - 1) < 1e-12
    one = H.log_share(np.array([0, 5]), np.array([0, 5]), np.array([0, 1]), np.array([False, True]))
    assert one.tolist() == [0.0, 0.0]  # an unseen class holds unknown words only; a word alone in its class


def test_batches_take_every_text_once():
    size = np.array([5, 1, 900, 2, 2, 7])
    parts = list(H.batches_of_texts(size, 10, 2))
    assert sorted(np.concatenate(parts).tolist()) == list(range(6))
    classes = np.repeat(np.arange(6), size)
    for p in parts:
        assert H.take_texts(classes, size, p).tolist() == [i for i in p for _ in range(size[i])]


def split(text):
    return (text or "").encode().lower().split() + [b""]


def trains(i, by=7, but=2):
    return i is not None and zlib.crc32(str(i).encode()) % by != but


def test_tokens_split_at_ascii_white_space_only():
    texts = ["", " ", "A b\tB\n", "x\x1cy\x0bz\x0c\r w", "É\u00a0é\u0085Ab \u2028 İ", "a\x00b", " lead  two"]
    size, tokens, words = H.tokens_of(pa.array(texts))
    end = np.cumsum(size)
    words = [w.as_py().encode() for w in words]
    assert len(set(words)) == len(words)
    for t, a, b in zip(texts, end - size, end):
        assert [words[k] for k in tokens[a:b]] == split(t)


def test_base_columns_match_brute_force(spark, sf, docs):
    rows = docs.select("doc_id", "text").collect()
    count = Counter(w for r in rows if trains(r.doc_id) for w in split(r.text))
    n, v = sum(count.values()), len(count)
    got = {r.doc_id: r for r in QUERIES["op13_hidden_markov"](spark, sf).collect()}
    assert len(got) == len(rows)
    base = better = 0
    for r in rows:
        w, g = split(r.text), got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            not trains(r.doc_id), len(w), sum(x in count for x in w), n)
        assert math.isclose(g.base_score, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert g.score < 0 and math.isfinite(g.score)
        if g.held_out:
            base, better = base + 1, better + (g.score > g.base_score)
    assert base and better >= 0.9 * base


def plain_scores(spark, docs, states, frequent, tail, steps):
    """One text at a time, with Spark's word classes."""
    rows = docs.select("doc_id", "text").collect()
    count = Counter(w for r in rows if trains(r.doc_id) for w in split(r.text))
    words = sorted({w for r in rows for w in split(r.text)})
    table = spark.createDataFrame([(w.decode(), count[w]) for w in words], "word string, count long")
    of = {r.word.encode(): r["class"] for r in H.with_classes(table, frequent, tail).collect()}
    top = [w for w in count if w and sum(c >= count[w] for x, c in count.items() if x) <= frequent]
    assert sorted(of[w] for w in top) == list(range(1, len(top) + 1)) and of[b""] == 0
    assert all(frequent < of[w] <= frequent + tail for w in words if w and w not in top)
    n, v = np.zeros(1 + frequent + tail), np.zeros(1 + frequent + tail)
    for w, c in count.items():
        n[of[w]] += c
        v[of[w]] += 1
    m = H.first_model(n, states)
    texts = [[of[w] for w in split(r.text)] for r in rows]
    for _ in range(steps):
        start, move, emit = np.zeros(states), np.zeros((states, states)), np.zeros((len(n), states))
        for r, t in zip(rows, texts):
            if not trains(r.doc_id):
                continue
            alpha, beta = [m.start * m.emit[t[0]]], [np.ones(states)]
            alpha[0] /= alpha[0].sum()
            for c in t[1:]:
                alpha.append(alpha[-1] @ m.move * m.emit[c])
                alpha[-1] /= alpha[-1].sum()
            for c in reversed(t[1:]):
                beta.append(m.move @ (m.emit[c] * beta[-1]))
                beta[-1] /= beta[-1].sum()
            beta.reverse()
            for k, c in enumerate(t):
                both = alpha[k] * beta[k] / (alpha[k] * beta[k]).sum()
                emit[c] += both
                if not k:
                    start += both
                else:
                    pair = alpha[k - 1][:, None] * m.move * m.emit[c] * beta[k]
                    move += pair / pair.sum()
        m = H.next_model(start, move, emit, H.class_shares(n))
    out = {}
    for r, t in zip(rows, texts):
        score, now = 0.0, m.start
        for k, (w, c) in enumerate(zip(split(r.text), t)):
            now = (now @ m.move if k else now) * m.emit[c]
            score += math.log10(now.sum())
            now = now / now.sum()
            score += math.log10(1 if c <= frequent else count[w] / (n[c] + v[c]) if count[w] else max(v[c], 1) / max(n[c] + v[c], 1))
        out[r.doc_id] = score
    return out


def test_scores_match_a_plain_version_in_any_partitioning(spark, docs):
    part = docs.orderBy("doc_id").limit(40)
    want = plain_scores(spark, part, 3, 50, 40, 2)
    learns = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    for n in (1, 4):
        got = H.score_documents(part.repartition(n), learns, 3, 50, 40, (1, 1)).collect()
        assert len(got) == 40
        assert all(math.isclose(r.score, want[r.doc_id], rel_tol=1e-7) for r in got)


def test_edge_rows(spark, edge, nothing):
    learns = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    got = H.score_documents(edge, learns, 3, 20, 20, (1,)).collect()
    rows = edge.select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == sorted((r.doc_id or 0, len(split(r.text))) for r in rows)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id == 2}) == 1  # repeated rows
    assert H.score_documents(nothing, learns, 3, 20, 20, (1,)).count() == 0


def test_without_training_rows(spark, docs):
    got = H.score_documents(docs.limit(3), F.lit(False), 2, 5, 5, (1,)).collect()
    assert all((r.held_out, r.n_known, r.train_tokens, r.base_score) == (True, 0, 0, 0.0) for r in got)
    assert all(math.isfinite(r.score) for r in got)


def test_every_step_reads_all_training_texts(spark, monkeypatch):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    seen, expected = [], H.expected_counts

    def counting(texts, model):
        seen.append(texts.select(F.sum(F.size("n_tokens"))).first()[0])
        return expected(texts, model)

    monkeypatch.setattr(H, "expected_counts", counting)
    H.score_documents(docs, F.col("doc_id") % 4 != 0, 2, 5, 5).collect()
    assert seen == [30] * len(H.SHARES) and len(seen) == 10


def test_batches_share_their_arrays():
    """One workspace for batches of any size gives what fresh arrays give, and is no larger than its bound."""
    rng = np.random.default_rng(3)
    m, room = H.first_model(rng.integers(1, 9, 6), 3), H.Workspace(60)
    for _ in range(5):
        size = rng.integers(1, 40, 4)
        classes = rng.integers(0, 6, size.sum())
        for one, other in zip(H.baum_welch(m, classes, size, room), H.baum_welch(m, classes, size)):
            np.testing.assert_allclose(one, other, rtol=1e-12)
    assert room.held and all(len(x) <= 60 * 3 for x in room.held.values())
