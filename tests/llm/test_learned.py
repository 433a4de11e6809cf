"""The trained operators: held-out accuracy, gradients, exact counts, edge cases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from corpusgrams.llm import byte_gru as G
from corpusgrams.llm import nbsvm as N
from corpusgrams.llm import rules_forest as R

SF = "/root/testdata/sf0.01"


def test_quality_separates_held_out_labels(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = N.quality_scores(docs, N.fit(docs, marks)).join(marks, "doc_id").filter("held_out").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    assert len(bad) > 5 and np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted for r in got if r.quality == 1]) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_quality_edge_cases(edge, nothing, marks, no_marks, docs):
    model = N.fit(docs, marks)
    got = N.quality_scores(edge, model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert N.keep_good(edge, model).columns == edge.columns
    assert N.keep_good(edge, model).count() == sum(r.predicted for r in rows)
    assert N.quality_scores(nothing, model).count() == 0
    blank = N.fit(nothing, no_marks)
    assert {r.score for r in N.quality_scores(edge, blank).collect()} == {0.5}


def test_quality_learns_from_training_rows_only(spark, docs, marks):
    flipped = marks.withColumn("quality", (1 - marks.quality)).filter(N.held_out())
    rest = marks.filter(~N.held_out())
    a, b = N.fit(docs, marks), N.fit(docs, rest.unionByName(flipped.select(*rest.columns)))
    assert np.array_equal(a["weight"], b["weight"]) and a["bias"] == b["bias"]


def test_coordinate_descent_meets_the_optimum():
    """Primal and dual objective agree on a small problem."""
    rng = np.random.default_rng(0)
    docs = [rng.choice(30, 6, replace=False) for _ in range(60)]
    y = np.array([int(x.min() < 4) for x in docs])
    values = [np.full(6, 0.4) for _ in docs]
    w, b = N.dual_coordinate_descent(docs, values, y, epochs=2000)
    sign = np.where(y == 1, 1, -1)
    margin = sign * np.array([w[x] @ v + b for x, v in zip(docs, values)])
    primal = 0.5 * (w @ w + b * b) + np.maximum(0, 1 - margin).sum()
    for _ in range(200):
        d = rng.normal(0, 0.05, N.N_FEATURES) * (np.arange(N.N_FEATURES) < 30)
        w2, b2 = w + d, b + rng.normal(0, 0.05)
        m2 = sign * np.array([w2[x] @ v + b2 for x, v in zip(docs, values)])
        assert 0.5 * (w2 @ w2 + b2 * b2) + np.maximum(0, 1 - m2).sum() >= primal - 1e-2


# --- rules --------------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_rule_counts_match_brute_force(edge, docs):
    for df in (edge, docs):
        texts = [r.text for r in df.collect()]
        counts, _ = R.count_rules(pa.array(texts))
        got = list(zip(*(counts[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
        assert got == [brute_counts(t) for t in texts]


def test_rules_keep_good_and_reject_bad(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = R.quality_rules(docs, marks).join(marks, "doc_id").filter(R.held_out()).filter("NOT base_failed").collect()
    assert np.mean([r.kept for r in got if r.quality == 1]) > 0.98
    assert np.mean([not r.kept for r in got if r.quality == 0]) > 0.7


def test_rules_edge_cases(edge, nothing, marks, no_marks):
    rows = R.quality_rules(edge, marks).collect()
    assert len(rows) == edge.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert all(r.kept == (not r.base_failed) for r in R.quality_rules(edge, no_marks).collect())
    assert R.quality_rules(nothing, marks).count() == 0


def test_forest_paths():
    """Leaves partition the rows: path lengths follow the definition."""
    x = np.random.default_rng(1).normal(size=(64, 3))
    forest = R.grow_forest(x, trees=1, rows=64)
    f, v, p = (forest[k][0] for k in ("feature", "value", "path"))
    for row in x[:10]:
        node, depth = 0, 0
        while f[node] >= 0:
            node, depth = 2 * node + 1 + int(row[f[node]] > v[node]), depth + 1
        n = sum(_leaf(f, v, z) == node for z in x)
        assert abs(p[node] - depth - float(R.usual_path(n))) < 1e-9
    far = R.grow_forest(np.vstack([x, [[50, 50, 50]]]))
    assert R.anomaly(far, np.array([[50.0, 50, 50]]))[0] > R.anomaly(far, x).max()


def test_the_forest_and_threshold_come_from_all_rows(spark):
    """More rows than any sample held: each grows a tree, each label counts for the threshold."""
    n = 30_000
    rng = "(hash(id, {0}) % 1000) / 1000D"
    stats = "array(" + ", ".join(rng.format(i) for i in range(4)) + ")"
    rows = spark.range(n).selectExpr("id AS doc_id", f"IF(id = {n - 1}, array(9D, 9D, 9D, 9D), {stats}) AS stats", "false AS base_failed")
    forest = R.grow_on_all(rows)
    x = np.array([r.stats for r in rows.collect()])
    same = R.grow_forest(x)
    assert all(np.array_equal(forest[k], same[k]) for k in forest)
    assert sorted(set(R.own_trees(np.arange(n), 1, R.TREES).ravel())) == list(range(R.TREES))
    odd = int(R.own_trees(np.array([n - 1]), 1, R.TREES)[0, 0])  # the odd row is in a tree, whichever it is
    assert R.node_ranges(forest, x, np.arange(n), 1, 0)[3][odd].tolist() == [9.0] * 4
    marks = spark.range(n).selectExpr("id AS doc_id", f"CAST(id < {n - 400} AS int) AS quality")
    got = R.fit_forest(rows, marks)["threshold"]
    score = R.anomaly(forest, x)
    known = [r.doc_id for r in marks.filter(~R.held_out()).collect()]
    good = [score[i] for i in known if i < n - 400]
    assert np.mean([s > got for s in good]) <= R.GOOD_LOST


def _leaf(f, v, z):
    node = 0
    while f[node] >= 0:
        node = 2 * node + 1 + int(z[f[node]] > v[node])
    return node


# --- language -----------------------------------------------------------------


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in G.start_network(3, rng).items()}
    x, size, _ = G.segments([b"abc", b"de", b"x" * 5])
    y, weight = np.array([0, 1, 2]), np.array([1.0, 2.0, 0.5])
    _, g = G.gradients(p, x, size, y, weight)
    for k in p:
        for _ in range(5):
            i = tuple(int(rng.integers(0, s)) for s in p[k].shape)
            i = (i[0], int(x[0, 0])) if k.startswith("in_") else i
            ends = []
            for e in (1e-4, -1e-4):
                q = {a: b.copy() for a, b in p.items()}
                q[k][i] += e
                ends.append(G.gradients(q, x, size, y, weight)[0])
            assert abs((ends[0] - ends[1]) / 2e-4 - g[k][i]) < 1e-4


def test_language_held_out_accuracy_and_edges(spark, edge, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = G.fit(docs, per_language=100, steps=200)
    got = G.identify(docs, model).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100 and np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    rows = {(r.doc_id, r.lang_pred, r.score) for r in G.identify(edge, model).collect()}
    no_letter = {5, 6, 7, 11, 14}
    assert {i for i, lang, _ in rows if lang == "und" and i is not None} == no_letter
    assert all(s == 0 for _, lang, s in rows if lang == "und") and all(0 <= s <= 1 for *_, s in rows)
    assert G.identify(nothing, model).count() == 0
    blank = G.fit(nothing)
    assert {r.lang_pred for r in G.identify(edge, blank).collect()} == {"und"}


def test_a_long_word_is_read_in_segments():
    x, size, word = G.segments([b"a" * 70, b"", b"bc"])
    assert size.tolist() == [32, 32, 6, 0, 2] and word.tolist() == [0, 0, 0, 1, 2]
