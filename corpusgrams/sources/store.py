"""Persistence: model tables per order, versioned datasets, partial counts.

Everything is parquet under a base folder (a shared file system or object
store on a cluster).  Writes are idempotent for a given name/version/batch:
a retried job overwrites its own output instead of appending twice.

Versioned datasets and partial counts are visible through manifests only: data
folders are written first, then one small file that names them.  Whoever dies
before that file leaves folders that no reader looks at.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
COMMIT_SCHEMA = "name string, version string, note string, path string"


def write_model(counts: DataFrame, path: str) -> None:
    """One parquet folder per order, rows sorted by (begins, ends) inside
    each file so that lookups by prefix skip row groups by min/max.

    Range partitioning on the full (unique) key spreads every order over many
    writer tasks — a hot prefix such as ``__bos__`` is split too — and gives
    each file a narrow ``begins`` range."""
    (
        counts.repartitionByRange("order", "begins", "ends")
        .sortWithinPartitions("order", "begins", "ends")
        .write.mode("overwrite")
        .partitionBy("order")
        .parquet(path)
    )


def read_model(spark: SparkSession, path: str, orders: list[int] | None = None) -> DataFrame:
    """Read a model written by ``write_model``; ``orders`` prunes partitions."""
    df = spark.read.parquet(path)
    if orders:
        df = df.filter(F.col("order").isin(orders))
    return df.select("order", "begins", "ends", "ngram_count")


MODEL_SCHEMA = "order int, begins string, ends string, ngram_count long"


def read_csv_model(spark: SparkSession, path: str, orders: list[int] | None = None) -> DataFrame:
    """N-gram CSV files with a header, read with the model's schema (no inference)."""
    df = spark.read.option("header", True).option("escape", "\\").schema(MODEL_SCHEMA).csv(path)
    return df.filter(F.col("order").isin(orders)) if orders else df


# --- versioned datasets ------------------------------------------------------


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder; no rows where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _version() -> str:
    """Later ones sort higher; no two are equal."""
    return f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"


def _commit(spark: SparkSession, base: str, version: str, names: dict[str, str], note: str) -> None:
    """Make the datasets ``names`` (name: folder under ``base``) visible, all at
    once: one file, which a retry overwrites."""
    rows = [(name, version, note, path) for name, path in names.items()]
    spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{base}/{COMMITS}/at={version}")


def commit_dataset(df: DataFrame, base: str, name: str, note: str = "", version: str | None = None) -> str:
    """S7/S8 ``pin_write``: write ``df`` as a new version of ``name`` with a note.
    Returns the version string."""
    v = version or _version()
    path = f"{name}/version={v}"
    df.write.mode("overwrite").parquet(f"{base}/{path}")
    _commit(df.sparkSession, base, v, {name: path}, note)
    return v


def commit_splits(split: DataFrame, base: str, tag: str, note: str = "", prefix: str = "clean_split_") -> str:
    """S7 ``commit_clean_splits``: ``<prefix><tag>_training`` and ``_testing``.

    Both are written in one pass over ``split`` and become visible together; a
    half without rows is an empty dataset, other values of ``split`` are left out."""
    v = _version()
    halves = ("training", "testing")
    path = f"{prefix}{tag}/version={v}"
    split.filter(F.col("split").isin(*halves)).withColumn("half", F.col("split")).drop("split").write.mode(
        "overwrite").partitionBy("half").parquet(f"{base}/{path}")
    empty = split.drop("split").limit(0)
    for wh in halves:  # the folder of a half without rows
        empty.write.mode("append").parquet(f"{base}/{path}/half={wh}")
    _commit(split.sparkSession, base, v, {f"{prefix}{tag}_{wh}": f"{path}/half={wh}" for wh in halves}, note)
    return v


def read_dataset(spark: SparkSession, base: str, name: str, version: str | None = None) -> DataFrame:
    """S7 ``pin_read``: the given version, or the latest one; KeyError where no
    manifest names it."""
    commits = read_if_there(spark, f"{base}/{COMMITS}", COMMIT_SCHEMA).filter(F.col("name") == name)
    if version is not None:
        commits = commits.filter(F.col("version") == version)
    path = commits.agg(F.max_by("path", "version")).first()[0]  # one row
    if path is None:
        raise KeyError(name if version is None else (name, version))
    return spark.read.parquet(f"{base}/{path}")


def get_split(spark: SparkSession, base: str, tag: str, wh: str = "training", prefix: str = "clean_split_",
              version: str | None = None) -> DataFrame:
    """S7 ``get_clean_splits``; ``wh`` must be ``training`` or ``testing``."""
    if wh not in ("training", "testing"):
        raise ValueError("wh must be 'training' or 'testing'")
    return read_dataset(spark, base, f"{prefix}{tag}_{wh}", version)


def list_datasets(spark: SparkSession, base: str, search: str | None = None) -> DataFrame:
    """S7 ``list_clean_splits`` / ``pin_search``: names, versions and notes."""
    df = read_if_there(spark, f"{base}/{COMMITS}", COMMIT_SCHEMA).select("name", "version", "note")
    if search:
        df = df.filter(F.col("name").contains(search))
    return df


def open_dataset(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S10 ``get_arrow_ds``: a folder of files as one DataFrame."""
    return spark.read.format(fmt).load(path)


def write_chunk_counts(counts: DataFrame, path: str, chunk_col: str = "bucket",
                       to: str | Callable[[DataFrame, str], None] = "parquet") -> None:
    """S9 ``tokenize_to``: per-chunk counts, one folder per chunk, in the format
    ``to``, or as the callable ``to(counts, path)`` writes them."""
    if callable(to):
        to(counts, path)
    else:
        counts.write.mode("overwrite").partitionBy(chunk_col).format(to).save(path)


# --- partial counts, merged by levels -------------------------------------------

MERGE = 8  # so many live folders of a level become one of the next
MANIFESTS = "_manifests"
LIVE_SCHEMA = "path string, level int, first long, last long"


def live_partials(spark: SparkSession, path: str) -> tuple[int, list]:
    """The newest manifest: its number (-1: none) and its rows, one per live
    folder (at most ``MERGE`` a level, so a few dozen rows whatever was counted)."""
    all_of_them = read_if_there(spark, f"{path}/{MANIFESTS}", LIVE_SCHEMA + ", number long")
    number = all_of_them.agg(F.max("number")).first()[0]
    if number is None:
        return -1, []
    return number, all_of_them.filter(F.col("number") == number).orderBy("first").drop("number").collect()


def _publish(spark: SparkSession, path: str, number: int, live: list) -> None:
    rows = [tuple(r) for r in live]
    spark.createDataFrame(rows, LIVE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/{MANIFESTS}/number={number}")


def _summed(df: DataFrame) -> DataFrame:
    return df.groupBy("order", "begins", "ends").agg(F.sum("ngram_count").cast("bigint").alias("ngram_count"))


def write_partial_counts(counts: DataFrame, path: str, batch_id: int, merge: int = MERGE) -> None:
    """S5 append of partial counts (order, begins, ends, ngram_count), one writer
    at a time, batches in rising order.

    The counts are written to a folder of their batch, then a manifest names it.
    A batch that the manifest covers is not written again (a replay), one that
    died before its manifest overwrites its own folder.  When a level holds
    ``merge`` live folders, their sum becomes one folder of the next level, so a
    count is rewritten once a level and readers sum a few dozen folders."""
    spark = counts.sparkSession
    number, live = live_partials(spark, path)
    if any(r["first"] <= batch_id <= r["last"] for r in live):
        return
    folder = f"level=0/batch={batch_id}"
    counts.write.mode("overwrite").parquet(f"{path}/{folder}")
    number, live = number + 1, [*live, (folder, 0, batch_id, batch_id)]
    _publish(spark, path, number, live)
    merge_partials(spark, path, merge)


def merge_partials(spark: SparkSession, path: str, merge: int = MERGE) -> None:
    """Merge full levels, lowest first.  Safe to repeat: a merge that died before
    its manifest left only a folder that the next one overwrites."""
    number, live = live_partials(spark, path)
    level = 0
    while any(r[1] >= level for r in live):
        full = [r for r in live if r[1] == level]
        if len(full) >= merge:
            first, last = min(r[2] for r in full), max(r[3] for r in full)
            folder = f"level={level + 1}/batch={first}-{last}"
            _summed(_folders(spark, path, full)).write.mode("overwrite").parquet(f"{path}/{folder}")
            number, live = number + 1, [r for r in live if r[1] != level] + [(folder, level + 1, first, last)]
            _publish(spark, path, number, live)
        level += 1


PARTIAL_SCHEMA = "order int, begins string, ends string, ngram_count long"


def _folders(spark: SparkSession, path: str, live: list) -> DataFrame:
    if not live:
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    return spark.read.schema(PARTIAL_SCHEMA).parquet(*[f"{path}/{r[0]}" for r in live])


def sum_partial_counts(spark: SparkSession, path: str) -> DataFrame:
    """A1 ``do_model``: final counts = sum of the partial counts that the newest
    manifest names."""
    return _summed(_folders(spark, path, live_partials(spark, path)[1]))


def vacuum_partials(spark: SparkSession, path: str) -> list[str]:
    """Delete folders and manifests that the newest manifest has replaced; gives
    their names.  Not beside a reader that began before the last merge, nor a writer."""
    number, live = live_partials(spark, path)
    if number < 0:
        return []
    names = {r["path"] for r in live} | {f"{MANIFESTS}/number={number}"}
    files = spark._jvm.org.apache.hadoop.fs
    fs = files.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for top in fs.listStatus(files.Path(path)):
        for sub in fs.listStatus(top.getPath()) if top.isDirectory() else []:
            name = f"{top.getPath().getName()}/{sub.getPath().getName()}"
            if sub.isDirectory() and name not in names:
                fs.delete(sub.getPath(), True)
                gone.append(name)
    return sorted(gone)
