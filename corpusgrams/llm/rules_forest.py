"""Quality rules with an isolation forest on the rules' statistics.

The rules count things in every whole text (words, symbols, repeated lines and
three-word windows).  A document that fails a base rule goes.  The others'
statistics, as shares that do not depend on the length, meet a forest of random
splits: an unusual document is isolated by few splits, so its mean path is
short.  All documents grow the forest: by a hash of its id each grows one tree,
or as many as give every tree ``TREE_ROWS`` documents.  Trees grow level by
level: the tasks find how many documents reach each node and the range of their
statistics, the driver draws the splits (a row per tree and node, whatever the
number of documents).
The threshold comes from all labelled documents, whose scores are counted in
``BINS`` bins; it lies between two of their scores, one candidate a bin.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, held_out, id_and_text, labels, small_arrow_batches, text_slices
from .words import Words

MIN_WORDS = 50  # base rule
MAX_REPEAT_PERCENT = 50  # base rule
TREES, TREE_ROWS, DEPTH = 200, 64, 8  # a tree has TREE_ROWS documents at least, if there are so many
GATHER = 100_000  # documents (times the trees of each) that a task takes through the trees at once
BINS = 1 << 16  # of the score, for the threshold
GOOD_LOST = 0.002  # share of good labelled documents that the threshold may reject

STATISTICS = ("word_length", "symbols", "upper_case", "most_frequent_word")  # none depends on the length alone
COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_LEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_SYMBOL = _table(b"#*$%&|<>")
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes(range(65, 91)) + bytes(range(97, 123)))


def count_rules(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The exact base counts of each text, and its statistics (rows of STATISTICS)."""
    w = Words(texts)
    n = w.n_texts
    count = lambda table: w.sum_by_text(w.count_bytes(table[w.bytes])).astype(np.int64)
    points = w.count_bytes(_LEAD[w.bytes])
    chars = w.sum_by_text(points).astype(np.int64)
    symbols = count(_SYMBOL)
    duplicate, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    begin = 0
    for i, end in enumerate(w.text_end.tolist()):
        full = [x for x in w.joined[begin:end - 1].split(b"\n") if x.strip()]
        lines[i], duplicate[i] = len(full), len(full) - len(set(full))
        begin = end
    at, content = w.windows
    covered = np.zeros(len(w.start), bool)
    if len(at):
        twice = at[np.bincount(content)[content] > 1]
        for k in range(3):
            covered[twice + k] = True
    repeat = w.sum_by_text(covered).astype(np.int64)
    frequent = np.zeros(n)  # occurrences of the most frequent word
    if len(w.start):
        both, times = np.unique(w.text * (w.ids.max() + 1) + w.ids, return_counts=True)
        np.maximum.at(frequent, both // (w.ids.max() + 1), times)
    words = np.maximum(w.per_text, 1)
    stats = np.stack([chars / words, symbols / words, count(_UPPER) / np.maximum(count(_LETTER), 1),
                      frequent / words], axis=1)
    return {"n_words": w.per_text.astype(np.int64), "word_chars": chars, "n_symbols": symbols,
            "n_dup_lines": duplicate, "n_repeat_words": repeat}, stats


def _count_batches(batches):
    for batch in batches:
        for s in text_slices(batch):
            counts, stats = count_rules(s.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)),
                                             pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), *map(pa.array, counts.values()), lists],
                                             ["doc_id", *counts, "stats"])


# --- the forest (numpy) ----------------------------------------------------------


def usual_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1),
                    np.where(n == 2, 1.0, 0.0))


def bare_forest(trees: int = TREES) -> dict[str, np.ndarray]:
    """Trees as heaps: split feature (-1: leaf), split value, and path length at each node."""
    nodes = 2 ** (DEPTH + 1) - 1
    return {"feature": np.full((trees, nodes), -1, np.int32), "value": np.zeros((trees, nodes)),
            "path": np.zeros((trees, nodes)), "usual": np.array(1e-9)}


def trees_a_row(rows: int, trees: int) -> int:
    """How many trees each of ``rows`` documents grows."""
    return min(trees, max(1, -(-TREE_ROWS * trees // max(rows, 1))))


def own_trees(ids: np.ndarray, each: int, trees: int) -> np.ndarray:
    """The ``each`` trees of every id, a row of them each."""
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    strides = np.array([k for k in range(1, trees + 1) if np.gcd(k, trees) == 1], np.uint64)
    step = strides[(h >> np.uint64(50)) % np.uint64(len(strides))]
    return ((h >> np.uint64(32))[:, None] + np.arange(each, dtype=np.uint64) * step[:, None]).astype(np.uint64) % np.uint64(trees)


def node_ranges(forest: dict[str, np.ndarray], x: np.ndarray, ids: np.ndarray, each: int, depth: int):
    """Nodes (tree * width + place in the level) of one level that rows reach in
    their own trees: how many do, and the lowest and highest of each of their statistics."""
    trees, width = len(forest["feature"]), 2 ** depth
    tree = own_trees(ids, each, trees).ravel().astype(np.int64)
    row, node = np.repeat(np.arange(len(x)), each), np.zeros(len(tree), np.int64)
    for _ in range(depth):
        f = forest["feature"][tree, node]
        node = np.where(f < 0, node, 2 * node + 1 + (x[row, f] > forest["value"][tree, node]))
    here = np.flatnonzero(node >= width - 1)  # the others ended in a leaf above
    place = tree[here] * width + node[here] - (width - 1)
    if not len(here):
        return None
    order = np.argsort(place, kind="stable")
    place, part = place[order], x[row[here[order]]]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    return (place[first], np.diff(first, append=len(place)),
            np.minimum.reduceat(part, first), np.maximum.reduceat(part, first))


def split_level(forest: dict[str, np.ndarray], depth: int, place: np.ndarray, count: np.ndarray,
                low: np.ndarray, high: np.ndarray, seed: int = 7) -> None:
    """Split the nodes of one level at random inside their ranges; those of one
    value or at the last level become leaves."""
    width = 2 ** depth
    shape = (len(forest["feature"]), width)
    which, where = np.random.default_rng((seed, depth)).random((2, *shape))
    tree, node = place // width, place % width + width - 1
    which, where = which[tree, place % width], where[tree, place % width]
    able = high > low
    n = able.sum(1)
    leaf = (n == 0) | (depth == DEPTH)
    forest["path"][tree[leaf], node[leaf]] = depth + usual_path(count[leaf])
    f = np.argmax(np.cumsum(able, 1) > np.floor(which * n)[:, None], 1)  # the chosen one of the able
    row = np.arange(len(place))
    v = low[row, f] + where * (high[row, f] - low[row, f])
    forest["feature"][tree[~leaf], node[~leaf]] = f[~leaf]
    forest["value"][tree[~leaf], node[~leaf]] = v[~leaf]


def usual_of(rows: int, each: int, trees: int) -> np.ndarray:
    """The usual path in a tree of the mean size."""
    return np.array(float(max(usual_path(max(rows * each / trees, 2)), 1e-9)))


def grow_forest(x: np.ndarray, trees: int = TREES, rows: int | None = None) -> dict[str, np.ndarray]:
    """A forest of the rows of one array (its first ``rows``), numbered as ids."""
    x, forest = x[:rows], bare_forest(trees)
    each = trees_a_row(len(x), trees)
    for depth in range(DEPTH + 1):
        found = node_ranges(forest, x, np.arange(len(x)), each, depth)
        if found:
            split_level(forest, depth, *found)
    forest["usual"] = usual_of(len(x), each, trees)
    return forest


def anomaly(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Isolation score in (0, 1]; higher: isolated by fewer splits."""
    total = np.zeros(len(x))
    row = np.arange(len(x))
    for feature, value, path in zip(forest["feature"], forest["value"], forest["path"]):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            f = feature[node]
            node = np.where(f < 0, node, 2 * node + 1 + (x[row, f] > value[node]))
        total += path[node]
    return 2.0 ** (-total / len(forest["feature"]) / forest["usual"])


def calibrate(good: np.ndarray, bad: np.ndarray, least: np.ndarray, most: np.ndarray) -> float:
    """The threshold (above it: rejected) with the best balanced accuracy among
    those that reject at most ``GOOD_LOST`` of the good rows: good and bad rows,
    least and greatest score of each bin that has any, in order."""
    if not good.sum() or not bad.sum():
        return float("inf")
    kept, n = np.cumsum(good), int(good.sum())
    floor = int(np.searchsorted(kept, max(int(np.ceil((1 - GOOD_LOST) * n)), 1)))
    balance = kept / n - np.cumsum(bad) / bad.sum()
    best = floor + int(np.argmax(balance[floor:]))
    return float((most[best] + least[best + 1]) / 2) if best + 1 < len(most) else float(most[best])


# --- the operator ------------------------------------------------------------


def rule_counts(docs: DataFrame) -> DataFrame:
    """The base counts, base_failed and statistics of every document."""
    small_arrow_batches(docs.sparkSession)
    counted = id_and_text(docs).mapInArrow(_count_batches, f"{COUNTS}, stats array<double>")
    return counted.withColumn(
        "base_failed",
        F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def _statistics(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


_RANGES = [f"{end}{i}" for end in ("low", "high") for i in range(len(STATISTICS))]


def _range_batches(forest: dict, each: int, depth: int, batches):
    def found():
        got = node_ranges(forest, np.concatenate(parts), np.concatenate(ids), each, depth)
        ids.clear()
        parts.clear()
        if got:
            place, count, low, high = got
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(count.astype(np.int64)), *map(pa.array, low.T),
                                              *map(pa.array, high.T)], ["place", "n", *_RANGES])

    ids, parts = [], []
    for batch in batches:
        ids.append(pc.fill_null(batch.column("doc_id"), 0).to_numpy(zero_copy_only=False))
        parts.append(_statistics(batch.column("stats")))
        if sum(map(len, parts)) * each >= GATHER:
            yield from found()
    if parts:
        yield from found()


def grow_on_all(able: DataFrame) -> dict[str, np.ndarray] | None:
    """The forest of all rows of ``able`` (doc_id, stats); None for fewer than two rows."""
    n = able.count()
    if n < 2:
        return None
    forest, each = bare_forest(), trees_a_row(n, TREES)
    schema = ", ".join(["place long, n long", *(f"{c} double" for c in _RANGES)])
    ends = [(F.min if c.startswith("low") else F.max)(c).alias(c) for c in _RANGES]
    for depth in range(DEPTH + 1):
        reached = able.select("doc_id", "stats").mapInArrow(functools.partial(_range_batches, forest, each, depth), schema)
        rows = reached.groupBy("place").agg(F.sum("n").alias("n"), *ends).orderBy("place").collect()  # at most a row per node
        if rows:
            split_level(forest, depth, np.array([r.place for r in rows]), np.array([r.n for r in rows]),
                        *np.split(np.array([r[2:] for r in rows]), 2, axis=1))
    forest["usual"] = usual_of(n, each, TREES)
    return forest


def _label_batches(forest: dict, batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(anomaly(forest, _statistics(batch.column("stats"))))],
                                         ["quality", "score"])


def fit_forest(counted: DataFrame, labelled: DataFrame) -> dict:
    """Forest and threshold, from all documents that pass the base rules.

    ``labelled``: doc_id, quality; the held-out fifth and null rows are left
    out.  Without rows to learn from nothing is rejected."""
    able = counted.filter("NOT base_failed").select("doc_id", "stats")
    forest = grow_on_all(able)
    if forest is None:
        return {"forest": None, "threshold": float("inf")}
    rows = labelled.select(labelled["doc_id"].cast("bigint").alias("doc_id"), labelled["quality"].cast("int").alias("quality"))
    usable = rows.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out())
    marks = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    scored = able.join(marks, "doc_id").select("quality", "stats").mapInArrow(
        functools.partial(_label_batches, forest), "quality int, score double")
    bins = scored.groupBy(F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin")).agg(
        F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"),
        F.min("score").alias("least"), F.max("score").alias("most"))
    known = np.array([tuple(r)[1:] for r in bins.orderBy("bin").collect()], float).reshape(-1, 4)  # at most BINS rows
    return {"forest": forest, "threshold": calibrate(*known.T)}


def _score_batches(model: dict, batches):
    for batch in batches:
        at = batch.schema.get_field_index("stats")
        x = _statistics(batch.column(at))
        score = anomaly(model["forest"], x) if model["forest"] is not None else np.zeros(len(x))
        rest = [batch.column(i) for i in range(batch.num_columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(score)], [*names, "anomaly"])


def quality_rules(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, anomaly of every document.

    Null and empty texts have no words and fail.  Repeated rows get equal
    results (of repeated labels the smaller counts), null ids are passed
    through, other columns are ignored, an empty table gives no rows."""
    counted = cut_lineage(rule_counts(docs))
    model = fit_forest(counted, labelled)
    scored = counted.mapInArrow(functools.partial(_score_batches, model),
                                f"{COUNTS}, base_failed boolean, anomaly double")
    keep = ~F.col("base_failed") & (F.col("anomaly") <= F.lit(model["threshold"]))
    return scored.withColumn("kept", keep)


# --- registered query --------------------------------------------------------


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir), labels(spark, sf_dir))
