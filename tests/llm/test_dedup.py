"""Exact and near dedup against brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusgrams.llm import exact_dedup as E
from corpusgrams.llm import probminhash as P
from corpusgrams.llm.common import freed_tables, saved_table, without
from corpusgrams.llm.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

BARE = re.compile(r"[\x20\x09-\x0D]+")


def exact_brute(rows):
    """(doc_id, keep_id, size, sha) of every row, in order, and the number kept."""
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        t = t or ""
        groups[hashlib.sha256(BARE.sub("", t).encode()).hexdigest()].append((-len(t), i is None, i or 0, n, i))
    out = []
    for sha, members in groups.items():
        keep = min(members)[4]
        out += [(m[4], keep, len(members), sha) for m in members]
    return out, len(groups)


@pytest.mark.parametrize("history", [None, "true", "false", "doc_id < 5"])
def test_exact_matches_brute_force(edge, history):
    got = E.exact_dedup(edge, history).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want, groups = exact_brute(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(want)
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_stage_keeps_whole_rows(edge):
    kept = E.keep_first_copies(edge)
    assert kept.columns == edge.columns
    assert kept.count() == exact_brute([(r.doc_id, r.text) for r in edge.collect()])[1]


def test_exact_empty(nothing):
    assert E.exact_dedup(nothing).count() == 0
    assert E.keep_first_copies(nothing).count() == 0


def test_op1_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = QUERIES["op1_exact_dedup"](spark, sf)
    cur = con.execute(ORACLES["op1_exact_dedup"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_minimal_perfect_hash_is_a_bijection_and_bytes_decide():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**64, (5000, 4), dtype=np.uint64)
    levels, slot = E.build_levels(keys)
    assert sorted(slot) == list(range(5000))
    assert (E.find_slots(levels, keys) == slot).all()
    other = rng.integers(0, 2**64, (5000, 4), dtype=np.uint64)
    at = E.find_slots(levels, other)  # strangers may hit a slot, whose digest differs
    stored = keys[np.argsort(slot)]
    assert not (stored[np.maximum(at, 0)] == other).all(1).any()


# --- near duplicates -----------------------------------------------------------


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_brute(rows):
    """Smallest id of each row's class: equal texts and links of similarity 0.8."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [shingle_set(t) for _, t in rows]
    where = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            where[x].append(n)
    text = {}
    for n, (_, t) in enumerate(rows):
        m = text.setdefault(t or "", n)
        parent[find(n)] = find(m)
        for k, c in Counter(k for x in sets[n] for k in where[x] if k < n).items():
            if c >= 0.8 * (len(sets[n]) + len(sets[k]) - c):
                parent[find(n)] = find(k)
    groups = defaultdict(list)
    for n in range(len(rows)):
        groups[find(n)].append(n)
    best = {g: min((rows[n][0] is None, rows[n][0] or 0, rows[n][0]) for n in m)[2] for g, m in groups.items()}
    return Counter((rows[n][0], best[g], len(m)) for g, m in groups.items() for n in m), len(groups)


def check_near(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want, groups = near_brute(rows)
    got = P.near_duplicates(df).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    assert sum(r.kept for r in got) == groups
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_near_matches_brute_force_on_documents(docs):
    check_near(docs)


def test_near_edge_cases(edge, nothing):
    check_near(edge)
    assert P.near_duplicates(nothing).count() == 0
    kept = P.keep_one_of_each(edge)
    assert kept.columns == edge.columns
    assert kept.count() == near_brute([(r.doc_id, r.text) for r in edge.collect()])[1]


def test_near_star_and_chain(spark):
    """Copies of one text that are near it but not near each other, and a chain."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for n in range(40):  # each about 0.83 from the base, below 0.8 from each other
        w = list(base)
        for p in rng.choice(40, 4, replace=False) * 5:
            w[p] = f"v{n}x{p}"
        rows.append((n, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for n in range(12):
        rows.append((2000 + n, " ".join(chain[n * 4:] + [f"d{i}" for i in range(n * 4)])))
    check_near(spark.createDataFrame(rows, "doc_id long, text string"))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    a = {int(k): float(v) for k, v in zip(rng.integers(1, 2**60, 80), rng.uniform(0.5, 3, 80))}
    b = dict(list(a.items())[:60]) | {int(k): 1.5 for k in rng.integers(1, 2**60, 15)}
    for k in list(b)[:20]:
        b[k] *= 1.7
    of = np.array([0] * len(a) + [1] * len(b))
    s = P.signatures(of, np.array([*a, *b], np.uint64), np.array([*a.values(), *b.values()]), 3, 4000)
    exact = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a | b) for i in a if i in b)
    assert abs((s[0] == s[1]).mean() - exact) < 0.03
    assert (s[2] == 0).all()


def test_shingles_match_brute_force(edge):
    texts = [r.text for r in edge.collect()]
    of, h, count = P.shingles(pa.array(texts))
    for n, t in enumerate(texts):
        w = words(t)
        want = Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()
        assert sorted(count[of == n]) == sorted(want.values())
        assert len(set(h[of == n])) == len(want)


def repeating_pairs(n_pairs, line_words, rest_words, times, edits):
    """Pairs of texts; the second has a line more often, and some words of the rest changed."""
    rows = []
    for p in range(n_pairs):
        line = [f"l{p}x{i}" for i in range(line_words)]
        rest = [f"r{p}x{i}" for i in range(rest_words)]
        other = [f"e{p}x{i}" if i in range(20, 20 + 10 * edits, 10) else w for i, w in enumerate(rest)]
        rows += [(2 * p, " ".join(line + rest)), (2 * p + 1, " ".join(line * times + other))]
    return rows


def test_near_copies_that_repeat_a_line_are_verified(spark):
    check_near(spark.createDataFrame(repeating_pairs(10, 89, 196, 5, 4), "doc_id long, text string"))


def test_near_copies_that_repeat_a_line_share_buckets(spark):
    check_near(spark.createDataFrame(repeating_pairs(30, 60, 240, 201, 0), "doc_id long, text string"))


def test_no_link_exceeds_its_bound():
    """Unequal parities never tell of more shingles of one text alone than there are."""
    rng = np.random.default_rng(8)
    for n in (1, 9, 90, 900, 9000):
        pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        for _ in range(50):
            a, b = pool[rng.random(2 * n) < rng.random()], pool[rng.random(2 * n) < rng.random()]
            s = P.sketches(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 3).view(np.uint64)
            assert s.shape == (3, P.GROUPS // 64) and not s[2].any()
            assert np.bitwise_count(s[0] ^ s[1]).sum() <= len(np.setxor1d(a, b))


def test_column_names_with_dots_and_repeated_rows_pass(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i % 2, text + (" more" if i % 2 else ""), i) for i in range(600)]  # 300 repeated rows of each of two ids
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` long")
    assert E.keep_first_copies(df).columns == P.keep_one_of_each(df).columns == df.columns
    assert E.keep_first_copies(df).count() == 2
    assert P.keep_one_of_each(df).count() == 1
    check_near(df)


def test_without_equals_an_anti_join(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    gone = spark.range(0, 5000, 7)
    assert sorted(r.id for r in without(df, gone, "id").collect()) == [i for i in range(5000) if i % 7]
    assert without(df, gone.limit(0), "id").count() == 5000


def test_private_tables_go_with_their_block(spark):
    with freed_tables(spark):
        inside = saved_table(spark.range(3))
        path = inside.inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    after = saved_table(spark.range(3))
    assert os.path.exists(after.inputFiles()[0].removeprefix("file:"))
