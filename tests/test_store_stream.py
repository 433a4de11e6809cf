"""Store round trips, replay-safe partial counts, streaming increments."""

import os

import pytest
from pyspark.sql import functions as F

from corpusgrams.operators import tokenize as tk
from corpusgrams.sources import corpus as src
from corpusgrams.sources import store
from corpusgrams.streaming.incremental import run_incremental_counts, run_longest_lines


def test_model_round_trip(spark, sf, tmp_dir):
    counts = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 2)
    store.write_model(counts, f"{tmp_dir}/model")
    back = store.read_model(spark, f"{tmp_dir}/model", [2])
    assert back.exceptAll(counts.filter(F.col("order") == 2)).count() == 0
    assert back.count() == counts.filter(F.col("order") == 2).count()


def test_versioned_splits(spark, sf, tmp_dir):
    df = spark.createDataFrame([(1, "training"), (2, "testing"), (3, "training")], "id int, split string")
    store.commit_splits(df, tmp_dir, "initial", note="first")
    df2 = spark.createDataFrame([(4, "training")], "id int, split string")
    store.commit_splits(df2, tmp_dir, "initial", note="second")
    assert [r.id for r in store.get_split(spark, tmp_dir, "initial", "training").collect()] == [4]
    assert store.list_datasets(spark, tmp_dir, "initial").count() == 4


def test_partial_counts_replay_counts_once(spark, sf, tmp_dir):
    counts = tk.ngram_counts(src.corpus_lines(spark, sf), 1, 2)
    store.write_partial_counts(counts, tmp_dir, 0)
    store.write_partial_counts(counts, tmp_dir, 0)  # replay of the same batch
    summed = store.sum_partial_counts(spark, tmp_dir)
    assert summed.exceptAll(counts).count() == 0 and counts.exceptAll(summed).count() == 0


def test_a_retried_commit_is_listed_once(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "id int")
    for _ in range(2):
        store.commit_dataset(df, tmp_dir, "x", "note", version="v1")
    assert [tuple(r) for r in store.list_datasets(spark, tmp_dir).collect()] == [("x", "v1", "note")]


def test_csv_model(spark, tmp_dir):
    rows = [(2, "a", "b", 3), (3, "a b", 'c "x"', 1)]
    df = spark.createDataFrame(rows, store.MODEL_SCHEMA)
    df.write.option("header", True).csv(f"{tmp_dir}/m")
    assert sorted(tuple(r) for r in store.read_csv_model(spark, f"{tmp_dir}/m").collect()) == rows
    assert [r.order for r in store.read_csv_model(spark, f"{tmp_dir}/m", [3]).collect()] == [3]


def test_chunk_writer_takes_a_format_or_a_callable(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a", 2)], "bucket int, ngram string, n long")
    store.write_chunk_counts(df, f"{tmp_dir}/c", to="json")
    assert spark.read.json(f"{tmp_dir}/c").count() == 1
    seen = []
    store.write_chunk_counts(df, f"{tmp_dir}/d", to=lambda d, path: seen.append((d.columns, path)))
    assert seen == [(["bucket", "ngram", "n"], f"{tmp_dir}/d")]


def test_streaming_counts_equal_batch_and_resume(spark, sf, tmp_dir):
    batch = tk.ngram_counts(src.corpus_lines(spark, sf))
    for _ in range(2):  # the second call finds no new file
        inc = run_incremental_counts(spark, sf, f"{tmp_dir}/counts", f"{tmp_dir}/seen", "documents.parquet")
    assert inc.exceptAll(batch).count() == 0 and batch.exceptAll(inc).count() == 0


# --- versions become visible with their manifest -------------------------------


def split_of(spark, training, testing):
    rows = [(i, "training") for i in training] + [(i, "testing") for i in testing]
    return spark.createDataFrame(rows, "id int, split string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_split_that_dies_before_its_manifest_is_not_read(spark, tmp_dir, monkeypatch):
    first = store.commit_splits(split_of(spark, [1, 3], [2]), tmp_dir, "x")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", dies)
        with pytest.raises(RuntimeError):
            store.commit_splits(split_of(spark, [4], [5]), tmp_dir, "x")
    assert len(os.listdir(f"{tmp_dir}/clean_split_x")) == 2  # the data of both versions is there
    assert ids(store.get_split(spark, tmp_dir, "x")) == [1, 3]
    assert ids(store.get_split(spark, tmp_dir, "x", "testing")) == [2]
    second = store.commit_splits(split_of(spark, [6], []), tmp_dir, "x")
    assert ids(store.get_split(spark, tmp_dir, "x")) == [6]
    assert store.get_split(spark, tmp_dir, "x", "testing").columns == ["id"]
    assert ids(store.get_split(spark, tmp_dir, "x", "testing")) == []
    assert ids(store.get_split(spark, tmp_dir, "x", version=first)) == [1, 3]
    assert first < second
    with pytest.raises(KeyError):
        store.get_split(spark, tmp_dir, "x", version="never")


def test_an_empty_store(spark, tmp_dir):
    assert store.list_datasets(spark, f"{tmp_dir}/none").count() == 0
    assert store.sum_partial_counts(spark, f"{tmp_dir}/none").count() == 0
    assert store.vacuum_partials(spark, f"{tmp_dir}/none") == []
    with pytest.raises(KeyError):
        store.read_dataset(spark, f"{tmp_dir}/none", "x")


# --- partial counts by levels ------------------------------------------------------


def partial(spark, batch):
    rows = [(1, "", f"w{batch % 3}", 1), (2, "a", "b", batch + 1)]
    return spark.createDataFrame(rows, store.PARTIAL_SCHEMA)


def sums(df):
    return sorted(tuple(r) for r in df.select("order", "begins", "ends", "ngram_count").collect())


def expected(n):
    words = [(1, "", f"w{k}", len(range(k, n, 3))) for k in range(min(3, n))]
    return sorted([*words, (2, "a", "b", n * (n + 1) // 2)])


def test_full_levels_are_merged_and_replays_counted_once(spark, tmp_dir):
    for b in range(10):
        store.write_partial_counts(partial(spark, b), tmp_dir, b, merge=3)
        store.write_partial_counts(partial(spark, b), tmp_dir, b, merge=3)  # a replay
    live = store.live_partials(spark, tmp_dir)[1]
    assert [(r["level"], r["first"], r["last"]) for r in live] == [(2, 0, 8), (0, 9, 9)]
    assert sums(store.sum_partial_counts(spark, tmp_dir)) == expected(10)
    gone = store.vacuum_partials(spark, tmp_dir)
    assert "level=0/batch=0" in gone and "level=1/batch=0-2" in gone
    assert sums(store.sum_partial_counts(spark, tmp_dir)) == expected(10)
    store.write_partial_counts(partial(spark, 10), tmp_dir, 10, merge=3)
    assert sums(store.sum_partial_counts(spark, tmp_dir)) == expected(11)


def test_a_crash_between_folder_and_manifest(spark, tmp_dir, monkeypatch):
    publish, calls = store._publish, []

    def dies(*args):
        calls.append(args)
        if len(calls) in (1, 5):  # the first batch's manifest, later the merge's
            raise RuntimeError("lost")
        publish(*args)

    monkeypatch.setattr(store, "_publish", dies)
    b = 0
    while b < 4:  # a stream replays the batch that failed
        try:
            store.write_partial_counts(partial(spark, b), tmp_dir, b, merge=3)
            b += 1
        except RuntimeError:
            pass
        assert sums(store.sum_partial_counts(spark, tmp_dir)) in ([], *(expected(n) for n in (b, b + 1) if n))
    assert len(calls) > 5
    store.merge_partials(spark, tmp_dir, merge=3)
    assert sums(store.sum_partial_counts(spark, tmp_dir)) == expected(4)


# --- the running maximum ------------------------------------------------------------


def test_running_maximum_goes_on_from_its_state(spark, sf, tmp_dir):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    os.mkdir(f"{tmp_dir}/in")
    want = lambda d: sorted(
        tuple(r) for r in src.document_lines(d).groupBy("file").agg(F.max(F.length("text"))).collect())
    seen = None
    for part in range(3):  # a new file each time, the query begun anew
        some = docs.filter(F.col("doc_id") % 3 == part)
        some.coalesce(1).write.parquet(f"{tmp_dir}/out{part}")
        file = next(f for f in os.listdir(f"{tmp_dir}/out{part}") if f.endswith(".parquet"))
        os.link(f"{tmp_dir}/out{part}/{file}", f"{tmp_dir}/in/documents{part}.parquet")
        seen = some if seen is None else seen.unionByName(some)
        got = run_longest_lines(spark, f"{tmp_dir}/in", f"{tmp_dir}/raised", f"{tmp_dir}/state")
        assert sorted(tuple(r) for r in got.collect()) == want(seen)
    # the state, not the inputs, says what was raised: a later batch holds only files whose maximum rose
    assert spark.read.parquet(f"{tmp_dir}/raised").filter("batch > 0").count() <= 2 * len(want(docs))
