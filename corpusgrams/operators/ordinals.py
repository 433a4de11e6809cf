"""Exact row numbers without one-task windows.

``row_number() over (partition by g order by k)`` sends a whole group to one
task; with a source holding a third of the corpus (or no partition at all)
that task holds a third of the data.  The helpers here give the same numbers
from bounded pieces:

* ``ordinal_in_group``: a coarse *bucket* that is monotone in the order key
  splits each group into small (group, bucket) windows; bucket sizes are
  summed into offsets over a table with one row per (group, bucket).  The
  offsets of a group meet in one task, so buckets must hold many rows each:
  ids should be dense, or the bucket a hash prefix.
* ``global_row_number``: range-partition by the order key, number rows inside
  each partition, and add the (broadcast, one row per partition) offsets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

DOC_BUCKET = 1000  # documents per bucket when ordering by (doc_id, ...)
HASH_BUCKET_HEX = 4  # md5 prefix digits: 65,536 buckets per group


def seeded_hash(seed: int, *cols: str) -> Column:
    """md5 of ``"seed:c1:c2..."`` (same string as the DuckDB oracle builds)."""
    parts: list[Column] = [F.lit(f"{seed}")]
    for c in cols:
        parts += [F.lit(":"), F.col(c).cast("string")]
    return F.md5(F.concat(*parts))


def hash_bucket(h: Column) -> Column:
    """Leading hex digits of an md5 string as an int; monotone in ``h``."""
    return F.conv(F.substring(h, 1, HASH_BUCKET_HEX), 16, 10).cast("int")


def doc_bucket(doc_id: str = "doc_id") -> Column:
    return F.floor(F.col(doc_id) / DOC_BUCKET)


def ordinal_in_group(df: DataFrame, group: list[str], bucket: Column, order: list[Column],
                     name: str = "ordinal") -> DataFrame:
    """``row_number() over (partition by group order by order)`` computed as
    offset of the row's bucket + row number inside (group, bucket).

    ``bucket`` must be non-decreasing in ``order`` within a group.
    """
    b = df.withColumn("_bk", bucket)
    sizes = b.groupBy(*group, "_bk").agg(F.count(F.lit(1)).alias("_bn"))
    wb = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_bk")
    offsets = sizes.select(
        *group, "_bk",
        F.coalesce(F.sum("_bn").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    inner = F.row_number().over(Window.partitionBy(*group, "_bk").orderBy(*order))
    out = b.withColumn("_r", inner).join(offsets, [*group, "_bk"])
    return out.withColumn(name, (F.col("_off") + F.col("_r")).cast("bigint")).drop("_bk", "_r", "_off")


def global_row_number(df: DataFrame, order: list[str], name: str = "row_id",
                      partitions: int | None = None) -> DataFrame:
    """Dense ``row_number() over (order by order)`` (order keys unique).

    Range partitioning spreads the rows; each row's number inside its
    partition comes from ``monotonically_increasing_id`` (partition index in
    the high bits); the partition ids are fixed by writing the rows out
    before the per-partition counts are taken.  Unless ``partitions`` is given,
    adaptive execution sizes the ranges.
    """
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    return number_in_ranges([ranged], order, name)


def number_in_ranges(parts: list[DataFrame], order: list[str], name: str = "row_id") -> DataFrame:
    """Dense row numbers through the tables ``parts`` one after another, each in
    ``order`` (keys unique).  A table's partitions must follow each other in that
    order already; nothing is shuffled, all are written out together once."""
    tagged = reduce(DataFrame.unionByName, [
        p.sortWithinPartitions(*order).select(
            "*", F.lit(i).alias("_part"), F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid"))
        for i, p in enumerate(parts)])
    tagged = stored(tagged)
    counts = tagged.groupBy("_part", "_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part", "_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = tagged.join(F.broadcast(offsets), ["_part", "_pid"])
    return out.withColumn(name, (F.col("_off") + local + 1).cast("bigint")).drop("_part", "_pid", "_mid", "_off")


def running_totals(df: DataFrame, order: list[str], values: list[str]) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each of ``values`` over all rows before in
    ``order`` (keys unique).

    Rows are dealt out in ranges, summed inside each, and the (broadcast, one row per
    range) sums of the ranges before are added."""
    ranged = stored(df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()))
    sums = ranged.groupBy("_pid").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_pid", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in values])
    inside = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values])
    out = out.join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"{v}_before") for v in values])
