"""A stored model keyed by context: bucketed and sorted, for lookups without a shuffle of the model.

``context`` is what the next word follows: '' for order 1, ``begins`` above.
It determines the order (its number of words), so the context alone is the
bucketing key, and a join on it moves the phrases to the model's buckets, never
the model.  Literal contexts read only their own buckets, and inside a bucket
the rows are sorted by context, so row groups are skipped by their bounds.

From the tables of each order (``tokenize.counts_by_order``) the buckets go by the context's
first two words (``lead``), by which rows of order 3 and up lie in their partitions already:
they are written where they were counted.  A context's rows share a bucket here too.  Asked
contexts are told by bitmaps in place of a join, so that the model does not move for them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import prefilter as PF
from ..operators import ranking as W
from ..session import ensure_checkpoint_dir, stored

STORED = ["context", "order", "begins", "ends", "ngram_count"]
LED = ["lead", *STORED]


def context_of() -> Column:
    return F.when(F.col("order") == 1, F.lit("")).otherwise(F.col("begins"))


def store_keyed(counts: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write a model (order, begins, ends, ngram_count) as the bucketed table
    ``table`` (replaced if it exists) and return it.

    ``path``: folder of the files (default: the warehouse's).  ``buckets``:
    default the session's shuffle partitions, so that phrases meet them in one
    exchange; for lookups by literals, choose as many as give buckets of a few
    hundred MB.  A context's rows share a bucket: at most one per word."""
    n = buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt by the context, which is told again from the row behind the exchange: its words move once
    rows = counts.select(*STORED[1:]).repartition(n, context_of()).select(context_of().alias("context"), *STORED[1:])
    return _write(rows, table, n, "context", path)


def store_led(by_order: dict[int, DataFrame], table: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``store_keyed`` for the tables of each order, bucketed by ``lead``: only order 2 (whose
    rows of a context lie apart) is dealt out again."""
    n = buckets or int(by_order[1].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [(c.repartition(n, "begins") if k == 2 else c).select(
        lead_of(context_of()).alias("lead"), context_of().alias("context"), *STORED[1:]) for k, c in by_order.items()]
    return _write(reduce(DataFrame.unionByName, parts), table, n, "lead", path)


def lead_of(context: Column) -> Column:
    return F.substring_index(context, " ", 2)


def _write(rows: DataFrame, table: str, n: int, key: str, path: str | None) -> DataFrame:
    writer = (
        rows.write.mode("overwrite").format("parquet").option("compression", "zstd")
        .bucketBy(n, key).sortBy("context", "ends")
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return rows.sparkSession.table(table)


def store_in_shared_folder(counts: DataFrame | dict[int, DataFrame], buckets: int | None = None) -> DataFrame:
    """``store_keyed`` (of the tables of each order: ``store_led``) under a name of its own,
    files in the shared checkpoint folder."""
    name = f"model_{uuid.uuid4().hex}"
    store, some = (store_led, counts[1]) if isinstance(counts, dict) else (store_keyed, counts)
    return store(counts, name, buckets, f"{ensure_checkpoint_dir(some.sparkSession)}/{name}")


def open_keyed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def rows_of_contexts(model: DataFrame, contexts: list[str]) -> DataFrame:
    """The stored rows of a few literal contexts: other buckets are not read."""
    rows = model.filter(F.col("context").isin(contexts))
    leads = {" ".join(c.split(" ")[:2]) for c in contexts}
    return rows.filter(F.col("lead").isin(sorted(leads))) if "lead" in model.columns else rows


def context_grams(grams: DataFrame, key: list[str]) -> DataFrame:
    """Suffix grams (order, begins, ends) of phrases as the contexts they ask for."""
    whole = F.when(F.col("order") == 1, F.col("ends")).otherwise(F.concat_ws(" ", "begins", "ends"))
    return grams.select(*key, (F.col("order") + 1).cast("int").alias("asked_order"), whole.alias("context"))


def stored_next_words(grams: DataFrame, model: DataFrame, key: list[str], k: int = 5) -> DataFrame:
    """M5 over a stored model: of each phrase's contexts that the model knows,
    the longest one's ``k`` most frequent next words (ties by word), ranked.

    The model is cut to the asked contexts' top ``k`` in its own buckets
    (semi-join, or bitmaps, and window need no exchange), before the phrases are joined."""
    asked = context_grams(grams, key)
    contexts = asked.select("context").distinct()
    if "lead" in model.columns:
        known, group = model.filter(PF.asked_twice(stored(contexts), F.col("context"))), ["lead", "context"]
    else:
        known, group = model.join(contexts, "context", "left_semi"), ["context"]
    top = W.top_k(known, group, [F.col("ngram_count").desc(), F.col("ends")], k)
    met = asked.join(top.filter(F.col("order") > 1), "context").filter(F.col("order") == F.col("asked_order"))
    longest = met.groupBy(*key).agg(F.max("order").alias("order"))
    return W.top_k(met.join(longest, [*key, "order"]), [*key], [F.col("ngram_count").desc(), F.col("ends")], k,
                   rank_col="rank").select(*key, "order", "begins", "ends", "ngram_count", "rank")
