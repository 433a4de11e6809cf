"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import contextvars
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefilter import asked_bits, may_be_asked
from ..session import ensure_checkpoint_dir

FILTER_BITS = 1 << 24  # two megabytes, however many keys are wanted
ARROW_ROWS = 1000  # rows of an Arrow batch; Spark's default of 10,000 whole texts is too much for a worker


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id bigint, text string`` of any documents-like table (null text: empty)."""
    return docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of the ids that no model may learn from (null ids: held out)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 5 == 0, F.lit(True))


def bounded_sample(df: DataFrame, n: int, *ties: str) -> DataFrame:
    """The ``n`` rows whose doc_id has the smallest hash (all rows, if fewer).

    A bound on the hash that about 2n rows pass is set from the row count first,
    so that the tasks of a large table do not each hand over n rows."""
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40))
    rows = df.count()
    few = df.filter(place < int((1 << 40) * (2.0 * n / rows))) if rows > 2 * n else df
    return few.orderBy(place, "doc_id", *ties).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """A column name starting with ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_private: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("private tables", default=None)


def write_table(df: DataFrame) -> str:
    """Write ``df`` as Parquet into a new folder of the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def saved_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read back.

    For wide tables: compressed, and safe when executors are lost.  Narrow
    tables use ``session.cut_lineage`` (a checkpoint) instead.  Inside
    ``freed_tables`` the files go when that block ends.
    """
    path, paths = write_table(df), _private.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system (nothing to do where it is missing)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def freed_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``saved_table`` writes in this block are deleted at its end;
    what is read from them must be written by then."""
    paths: list[str] = []
    token = _private.set(paths)
    try:
        yield
    finally:
        _private.reset(token)
        for path in paths:
            delete_table(spark, path)
        drop_unused(spark)


def drop_unused(spark: SparkSession) -> None:
    """Plans that nobody holds any more are collected, so that Spark drops their shuffle
    files and checkpoints: between rounds that each write many small ones."""
    gc.collect()
    spark._jvm.System.gc()


def without(table: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` whose ``key`` is not in ``gone`` (its only column).

    A bitmap of fixed size tells for most rows that they stay; only the others
    go through the exact anti-join, so whole texts are shuffled about as often
    as rows go."""
    bits = asked_bits(gone, FILTER_BITS)
    doubtful = may_be_asked(bits, table[key], bits=FILTER_BITS)
    return table.filter(~doubtful).unionByName(table.filter(doubtful).join(gone, key, "left_anti"))


def small_arrow_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``ARROW_ROWS`` if it is larger.

    Texts can be long; a Python worker holds one batch at a time.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def text_slices(batch: pa.RecordBatch, max_chars: int = 4 << 20,
                column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows of about ``max_chars`` bytes of text.

    A longer text makes a slice of its own; no text is cut.
    """
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype("int64"))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + max_chars, side="right")))
        yield batch.slice(at, to - at)
        at = to
