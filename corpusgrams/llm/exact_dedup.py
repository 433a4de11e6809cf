"""Exact dedup through a minimal perfect hash over historical distinct digests.

Texts are equal when identical after deleting every character of
``[\\x20\\x09-\\x0D]``.  The historical documents (any Boolean rule over the
table's columns) are reduced to one row per distinct SHA-256 digest.  The
digests are split by their first bits into parts of about ``PART_DIGESTS``; for
each part one task builds a minimal perfect hash (levels of bit arrays, a key's
slot is the rank of its bit) whose slots hold the full 32-byte digest and the
locator of the winner.  The index is a table with one row per part, so nothing
of it passes through the driver.

Arrivals are also reduced to one row per digest before they are shuffled, so a
text that makes up a third of all rows is one row there.  Each arriving digest
is hashed to its slot and compared byte by byte with the digest in it: equal
means a repeat, and slot and arrival agree on one winner; otherwise the digest
is no member of the history and forms a group of its own.

The winner of a group is the row with the most code points in its original
text, then the smallest doc_id (null last), then the first of repeated rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import fresh, saved_table, without

PART_DIGESTS = 50_000  # digests of one part of the index: about 4 MB
GAMMA = 2.0  # bits of a level for each key that reaches it
GOLD = 0x9E3779B97F4A7C15

BEST = "lacks long, no_id boolean, id long, uid long"  # ascending order: best row first
SLOTS = f"digest binary, copies long, {BEST}"
INDEX = ("part long, sizes array<long>, bits array<binary>, digest binary, copies array<long>, "
         "lacks array<long>, no_id array<boolean>, id array<long>, uid array<long>")
ANSWER = f"digest binary, copies long, repeats boolean, {BEST}"


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the text without ASCII white space; null counts as empty."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")
    return F.unhex(F.sha2(bare, 256))


def in_history(docs: DataFrame, rule: str | None) -> Column:
    """Which rows count as loaded before; without a rule, half of the ids by a hash."""
    marked = F.expr(rule) if rule else F.xxhash64(docs["doc_id"]) % 2 == 0
    return F.coalesce(marked, F.lit(False))


# --- the minimal perfect hash (one part, in numpy) ---------------------------


def digest_words(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """(n, 4) unsigned words of n 32-byte digests."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 4)


def level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys[:, 0] ^ (keys[:, 1] * np.uint64((GOLD * (2 * level + 1)) % 2**64))
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + keys[:, 2]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) + keys[:, 3] * np.uint64(level + 1)
    return x ^ (x >> np.uint64(31))


def build_levels(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of the levels, and each key's slot: a bijection onto 0..n-1.

    At each level a key keeps its position if no other key hit it; the others
    go on to the next level.  Distinct digests part within a few levels.
    """
    left, levels, base = np.arange(len(keys)), [], 0
    slot = np.empty(len(keys), np.int64)
    while len(left):
        if len(levels) > 200:
            raise ValueError("digests are not distinct")
        size = max(8, int(GAMMA * len(left)))
        at = (level_hash(keys[left], len(levels)) % np.uint64(size)).astype(np.int64)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        slot[left[alone]] = base + np.cumsum(bits)[at[alone]] - 1
        base += int(bits.sum())
        levels.append(bits)
        left = left[~alone]
    return levels, slot


def find_slots(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The slot that each key hashes to, -1 for none.  A key that was never
    added may get any slot: the caller compares the digest stored there."""
    slot = np.full(len(keys), -1, np.int64)
    left, base = np.arange(len(keys)), 0
    for n, bits in enumerate(levels):
        at = (level_hash(keys[left], n) % np.uint64(len(bits))).astype(np.int64)
        hit = bits[at]
        rank = np.cumsum(bits)
        slot[left[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1])
        left = left[~hit]
    return slot


def _build_part(key: tuple, table: pa.Table) -> pa.Table:
    levels, slot = build_levels(digest_words(table["digest"]))
    order = np.empty_like(slot)
    order[slot] = np.arange(len(slot))
    table = table.take(pa.array(order))
    row = {c: [table[c].to_pylist()] for c in ("copies", "lacks", "no_id", "id", "uid")}
    row |= {
        "part": [key[0].as_py()],
        "sizes": [[len(b) for b in levels]],
        "bits": [[np.packbits(b).tobytes() for b in levels]],
        "digest": [b"".join(table["digest"].to_pylist())],
    }
    return pa.table({c: pa.array(row[c], _INDEX_TYPES[c]) for c in _INDEX_TYPES})


_INDEX_TYPES = {
    "part": pa.int64(), "sizes": pa.list_(pa.int64()), "bits": pa.list_(pa.binary()), "digest": pa.binary(),
    "copies": pa.list_(pa.int64()), "lacks": pa.list_(pa.int64()), "no_id": pa.list_(pa.bool_()),
    "id": pa.list_(pa.int64()), "uid": pa.list_(pa.int64()),
}


def _answer_part(arrivals: pa.Table, index: pa.Table) -> pa.Table:
    """One row per digest of the part, in the index or only among the arrivals."""
    new = [dict(zip(_LOCATOR, r)) for r in zip(*(arrivals[c].to_pylist() for c in _LOCATOR))]
    slots: list[dict] = []
    found = np.full(len(new), -1, np.int64)
    if index.num_rows:
        row = {c: index[c][0].as_py() for c in index.column_names}
        blob = row["digest"]
        slots = [dict(zip(_LOCATOR, (blob[32 * i:32 * i + 32], *rest))) for i, rest in
                 enumerate(zip(row["copies"], row["lacks"], row["no_id"], row["id"], row["uid"]))]
        if new:
            levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)
                      for b, n in zip(row["bits"], row["sizes"])]
            keys = digest_words(arrivals["digest"])
            found = find_slots(levels, keys)
            stored = np.frombuffer(blob, "<u8").reshape(-1, 4)
            found[(found >= 0) & (stored[found] != keys).any(axis=1)] = -1  # byte check
    rank = lambda r: (r["lacks"], r["no_id"], r["id"] or 0, r["uid"])
    out = [s | {"repeats": False} for s in slots]
    for r, at in zip(new, found):
        if at < 0:
            out.append(r | {"repeats": False})
            continue
        s = out[at]
        out[at] = (r if rank(r) < rank(s) else s) | {"copies": r["copies"] + s["copies"], "repeats": True}
    types = {"digest": pa.binary(), "copies": pa.int64(), "repeats": pa.bool_(), "lacks": pa.int64(),
             "no_id": pa.bool_(), "id": pa.int64(), "uid": pa.int64()}
    return pa.table({c: pa.array([r[c] for r in out], t) for c, t in types.items()})


_LOCATOR = ("digest", "copies", "lacks", "no_id", "id", "uid")


# --- the operator ------------------------------------------------------------


def _distinct(rows: DataFrame) -> DataFrame:
    best = F.struct((-F.col("n_points")).alias("lacks"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id").alias("id"), F.col("uid"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(best).alias("b")).select(
        "digest", "copies", "b.*")


def _with_part(df: DataFrame, bits: int) -> DataFrame:
    first = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    return df.withColumn("part", F.shiftright(first, 32 - bits))


def build_index(history: DataFrame, bits: int) -> DataFrame:
    """The minimal perfect hash as a table, one row per part (2**bits parts).

    ``history`` has one row per distinct digest (columns SLOTS)."""
    return _with_part(history, bits).groupBy("part").applyInArrow(_build_part, INDEX)


def look_up(index: DataFrame, arrivals: DataFrame, bits: int) -> DataFrame:
    """One row (columns ANSWER) per digest of the index or the arrivals."""
    return (
        _with_part(arrivals, bits).groupBy("part").cogroup(index.groupBy("part"))
        .applyInArrow(_answer_part, ANSWER)
    )


def exact_groups(rows: DataFrame) -> DataFrame:
    """``rows`` (uid, doc_id, digest, n_points, historical) with the winner of
    each row's group: plus keep_id, group_size, kept, repeats (the arrivals
    repeated a historical digest)."""
    rows = cut_lineage(rows)
    history = cut_lineage(_distinct(rows.filter("historical")))
    n = history.count()
    bits = min(30, max(0, int(np.ceil(np.log2(max(n, 1) / PART_DIGESTS))) if n > PART_DIGESTS else 0))
    bits = max(bits, 4)  # also a small index is built by several tasks
    arrivals = _distinct(rows.filter("NOT historical"))
    answers = look_up(build_index(history, bits), arrivals, bits)
    winners = answers.select("digest", F.col("id").alias("keep_id"), F.col("copies").alias("group_size"),
                             F.col("uid").alias("keep_uid"), "repeats")
    return rows.join(winners, "digest").withColumn("kept", F.col("uid") == F.col("keep_uid"))


def exact_dedup(docs: DataFrame, history: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, repeats.

    ``history``: SQL predicate over the columns of ``docs`` that marks the
    documents loaded before (default: half of the ids).  It changes which digests the index
    holds, never the result.

    Null texts count as empty, all empty and white-space-only texts are one
    group.  Null doc_ids lose ties; repeated rows (same id and text) are
    separate members of which one is kept.  Other columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        docs["doc_id"].cast("bigint").alias("doc_id"),
        digest(docs["text"]).alias("digest"),
        F.length(F.coalesce(docs["text"], F.lit(""))).cast("bigint").alias("n_points"),
        in_history(docs, history).alias("historical"),
    )
    return exact_groups(rows).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), "repeats")


def keep_first_copies(docs: DataFrame, history: str | None = None) -> DataFrame:
    """The winners' whole rows, with the columns of ``docs``."""
    uid, dig = fresh(docs, "row_uid"), fresh(docs, "row_digest")
    table = saved_table(docs.withColumns({
        uid: F.monotonically_increasing_id(),
        dig: digest(docs["text"]),
    }))
    rows = table.select(
        F.col(uid).alias("uid"), table["doc_id"].cast("bigint").alias("doc_id"), F.col(dig).alias("digest"),
        F.length(F.coalesce(table["text"], F.lit(""))).cast("bigint").alias("n_points"),
        in_history(table, history).alias("historical"),
    )
    gone = cut_lineage(exact_groups(rows).filter("NOT kept").select(F.col("uid").alias(uid)))
    return without(table, gone, uid).drop(uid, dig)


# --- registered query --------------------------------------------------------


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("repeats")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
