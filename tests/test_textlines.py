"""Line numbers of text files that are read in many small splits."""

import os

import pytest
from pyspark.sql import functions as F

from corpusgrams.operators import splits as P
from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src
from corpusgrams.sources import textlines as X

FILES = {
    "a.txt": "".join(f"line {i} {'x' * (i % 90)}\n" for i in range(400)),
    "b.txt": "\n\none\n\n" + "y" * 5000 + "\nlast without end",
    "c.txt": "",
    "d.txt": "only\n",
    "e.txt": "café — 日本\nb\n" * 50,
    "skip.csv": "no\n",
}


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(folder, files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
            f.write(text)


def numbered(text, sep="\n"):
    lines = text.split(sep)
    return list(enumerate(lines[:-1] if lines[-1] == "" else lines))


def test_numbers_are_the_files_own(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/t", FILES)
    got = X.number_lines(spark, f"{tmp_dir}/t", "*.txt", "\n")
    assert got.rdd.getNumPartitions() > 20
    want = sorted((name, i, line) for name, text in FILES.items() if name.endswith(".txt") for i, line in numbered(text))
    assert sorted(tuple(r) for r in got.collect()) == want


def test_any_line_end_by_default(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/t", {"w.txt": "".join(f"row {i}\r\n" for i in range(300))})
    got = X.number_lines(spark, f"{tmp_dir}/t").orderBy("line_no").collect()
    assert [(r.line_no, r.text) for r in got] == [(i, f"row {i}") for i in range(300)]


def test_parts_of_one_file_follow_each_other(spark, sf, tmp_dir, small_splits):
    lines = src.corpus_lines(spark, sf).limit(300)
    X.write_lines(lines, f"{tmp_dir}/parts", ["doc_id", "line_no"])
    folder = "regexp_extract(_path, '/file=([^/]*)/', 1)"
    got = {(r.file, r.line_no): r.text
           for r in X.number_lines(spark, f"{tmp_dir}/parts", "*.txt", "\n", whole_file=folder).collect()}
    want, at = {}, {}
    for r in lines.orderBy("file", "doc_id", "line_no").collect():
        want[r.file, at.setdefault(r.file, 0)] = r.text
        at[r.file] += 1
    assert got == want


def test_texts_are_not_shuffled(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/t", FILES)
    plan = X.number_lines(spark, f"{tmp_dir}/t")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("Scan text")[0].split("BroadcastExchange")[0]
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_ordered_operators_run_on_text_files(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/t", {"a.txt": FILES["a.txt"], "e.txt": FILES["e.txt"]})
    lines = X.corpus_of_files(spark, f"{tmp_dir}/t", "*.txt", "\n")
    sample = P.sample_lines(lines, prop=0.5)
    n = {r.file: r["count"] for r in sample.groupBy("file").count().collect()}
    assert n == {"a.txt": 200, "e.txt": 50}
    assert tk.ngram_counts(lines, 1, 2).count() > 0


def test_header_goes_by_number(spark, tmp_dir, small_splits):
    write(f"{tmp_dir}/h", {"x.csv": "text\n" + "".join(f"v{i}, \"q\"\n" for i in range(200))})
    got = X.single_column(spark, f"{tmp_dir}/h", "*.csv", "\n").orderBy("row_no").collect()
    assert [(r.row_no, r.text) for r in got] == [(i, f'v{i}, "q"') for i in range(200)]


def test_an_empty_folder_gives_no_lines(spark, tmp_dir):
    write(f"{tmp_dir}/t", {"c.txt": ""})
    assert X.number_lines(spark, f"{tmp_dir}/t").count() == 0
