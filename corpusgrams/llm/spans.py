"""Regular-expression spans in DataFrame functions (no Python in the tasks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:int,end:int,found:string>>"


def find_spans(text: Column, pattern: Column) -> Column:
    """All leftmost non-overlapping matches of a (never empty) pattern, as
    ``array<struct<start, end, found>>`` in code points, end exclusive.

    The pieces between the matches and the matches alternate, so running sums of
    their lengths are the positions."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                      lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"), x["hit"].alias("found")))).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {SPANS})").alias("spans"))
    return F.aggregate(both, first, step, lambda acc: acc["spans"])


def spans_where(gate: Column, text: Column, pattern: Column) -> Column:
    """``find_spans`` for texts that pass a cheap test, else no span."""
    return F.when(gate, find_spans(text, pattern)).otherwise(F.expr(f"cast(array() as {SPANS})"))
