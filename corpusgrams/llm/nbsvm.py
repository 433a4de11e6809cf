"""Quality classifier: support vectors on naive Bayes features.

Features are n-gram indicators (n = 1 to 3) over the *forms* of a document's
words, not over the words themselves: letter case, last character, length,
whether a line begins here, and whether the word repeats its predecessor or
closes a three-word window seen before in the text.  So a spelling that the
sample never held still has known features.  Each indicator is hashed to one of
``N_FEATURES`` places.

The fit scales each indicator by its class log-count ratio (naive Bayes), gives
every document unit length, and solves the linear hinge-loss machine by dual
coordinate descent.  It learns from at most ``MAX_TRAIN`` labelled documents (a
bound on the driver's work; all other steps cover every document).  A fifth of
those are set aside to turn margins into probabilities (a logistic curve).
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_sample, documents, held_out, id_and_text, labels, small_arrow_batches, text_slices
from .words import Words, first_of_each

N_FEATURES = 1 << 18
MAX_TRAIN = 8000  # labelled documents that the fit reads, at most
MIN_DOCS = 3  # an indicator counts if so many training documents have it
COST = 1.0  # of the hinge loss
EPOCHS = 20
KEEP_AT = 0.3  # predicted 1 from this score on


# --- features ----------------------------------------------------------------

_CLASS = np.full(256, 7, np.int64)  # of a word's last byte: other punctuation
for _chars, _c in ((b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 0), (b".;:", 1), (b",", 2),
                   (b"!?", 3), (b"|", 4), (b"#*$%&<>=~^@+_", 5), (b"0123456789", 6)):
    _CLASS[list(_chars)] = _c
_CLASS[128:] = 0
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_LOWER[128:] = True  # letters of other scripts have no case here
_LEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a character
_LENGTHS = np.array([1, 3, 6, 10, 20])


def word_forms(w: Words) -> np.ndarray:
    """A code below 2**11 for the form of each word."""
    letters_up, letters_low = w.count_bytes(_UPPER[w.bytes]), w.count_bytes(_LOWER[w.bytes])
    case = np.select([letters_up + letters_low == 0, letters_up == 0, letters_low == 0, letters_up == 1],
                     [0, 1, 2, 3], 4)
    case[(case == 2) & (letters_up == 1)] = 3
    length = np.searchsorted(_LENGTHS, w.count_bytes(_LEAD[w.bytes]), side="left")
    last = _CLASS[w.bytes[w.end - 1]]
    line = (w.bytes[np.maximum(w.start - 1, 0)] == 10) & (w.start > 0)
    line[w.first[w.per_text > 0]] = True
    repeat = np.zeros(len(w.start), np.int64)
    if len(w.start) > 1:
        at, content = w.windows
        seen = at[~first_of_each(content)] + 2
        repeat[seen] = 1
        same = (w.ids[1:] == w.ids[:-1]) & (w.text[1:] == w.text[:-1])
        repeat[1:][same] = 2
    return (((case * 8 + last) * 6 + length) * 2 + line) * 3 + repeat


def indicators(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once, ordered by text."""
    w = Words(texts)
    form = word_forms(w).astype(np.uint64) + np.uint64(1)
    keys, of = [form], [w.text]
    code = form
    for n in (2, 3):
        if len(form) < n:
            break
        code = code[:-1] * np.uint64(4099) + form[n - 1:]
        same = w.text[n - 1:] == w.text[: len(w.text) - n + 1]
        keys.append((code + np.uint64(n << 50))[same])
        of.append(w.text[n - 1:][same])
    key = np.concatenate(keys)
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    feature = (key >> np.uint64(46)).astype(np.int64)  # 18 bits
    pair = np.unique(np.concatenate(of) * N_FEATURES + feature)
    return pair // N_FEATURES, pair % N_FEATURES


def _feature_lists(batches):
    for batch in batches:
        for s in text_slices(batch):
            doc, feature = indicators(s.column("text"))
            cut = np.searchsorted(doc, np.arange(s.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([s.column("doc_id"), s.column("quality"), lists],
                                             ["doc_id", "quality", "features"])


# --- the fit (numpy, on a bounded sample) ---------------------------------------


def log_count_ratio(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Naive Bayes: log of the class's smoothed shares of each indicator."""
    p, q = np.ones(N_FEATURES), np.ones(N_FEATURES)
    for x, label in zip(docs, y):
        (p if label else q)[x] += 1
    r = np.log((p / p.sum()) / (q / q.sum()))
    r[p + q - 2 < MIN_DOCS] = 0
    return r


def dual_coordinate_descent(docs: list[np.ndarray], values: list[np.ndarray], y: np.ndarray,
                            cost: float = COST, epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """Linear L1-loss support vector machine; the bias is a feature of value 1.

    Each step minimises the dual in one document's alpha, within [0, cost]."""
    w, b = np.zeros(N_FEATURES), 0.0
    alpha = np.zeros(len(docs))
    sign = np.where(y == 1, 1.0, -1.0)
    square = np.array([float(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(docs)):
            x, v = docs[i], values[i]
            gradient = sign[i] * (w[x] @ v + b) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * v
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, b


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, c of 1 / (1 + exp(-(a * margin + c))), by Newton steps, a kept positive."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + c, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * (a - 1), (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        da, dc = np.linalg.solve(h, g)
        a, c = max(1e-3, a - np.clip(da, -2, 2)), c - np.clip(dc, -2, 2)
    return float(a), float(c)


def fit_arrays(docs: list[np.ndarray], y: np.ndarray) -> dict:
    """Model of indicator lists and 0/1 labels; with one class or none, a constant."""
    if len(y) == 0 or y.min() == y.max():
        return {"feature": np.empty(0, np.int64), "weight": np.empty(0), "ratio": np.empty(0), "bias": 0.0,
                "a": 1.0, "c": 0.0 if len(y) == 0 else (3.0 if y[0] else -3.0)}
    aside = np.arange(len(y)) % 5 == 0
    if min(y[aside].sum(), (1 - y[aside]).sum()) < 2 or len(set(y[~aside])) < 2:
        aside[:] = False
    use = np.flatnonzero(~aside)
    r = log_count_ratio([docs[i] for i in use], y[use])
    unit = lambda x: r[x] / max(np.sqrt((r[x] ** 2).sum()), 1e-9)
    values = [unit(x) for x in docs]
    w, b = dual_coordinate_descent([docs[i] for i in use], [values[i] for i in use], y[use])
    margin = np.array([w[x] @ v + b for x, v in zip(docs, values)])
    on = np.flatnonzero(aside) if aside.any() else use
    a, c = logistic_curve(margin[on], y[on])
    feature = np.flatnonzero(r)
    return {"feature": feature, "weight": w[feature], "ratio": r[feature], "bias": b, "a": a, "c": c}


def fit(docs: DataFrame, labelled: DataFrame, max_train: int = MAX_TRAIN) -> dict:
    """Learn from labelled documents outside the held-out fifth.

    ``labelled``: doc_id, quality (0 or 1; null rows are left out, of repeated
    ids the smallest label counts).  The sample is the ``max_train`` ids of
    smallest hash, so it does not depend on the order of the rows."""
    small_arrow_batches(docs.sparkSession)
    marks = labelled.select(labelled["doc_id"].cast("bigint").alias("doc_id"), labelled["quality"].cast("int").alias("quality"))
    able = marks.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out())
    sample = bounded_sample(able, max_train, "quality").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = (
        id_and_text(docs).join(F.broadcast(sample), "doc_id")  # at most max_train rows
        .select("doc_id", "quality", "text")
        .mapInArrow(_feature_lists, "doc_id long, quality int, features array<int>")
    )
    got = {}
    for r in rows.toArrow().to_batches():
        for i, q, x in zip(r.column(0).to_pylist(), r.column(1).to_pylist(), r.column(2)):
            got.setdefault(i, (q, np.asarray(x.values, dtype=np.int64)))
    order = sorted(got)
    return fit_arrays([got[i][1] for i in order], np.array([got[i][0] for i in order], dtype=np.int64))


# --- scores ------------------------------------------------------------------


def score_texts(texts: pa.Array, ratio: np.ndarray, weight: np.ndarray, model: dict) -> np.ndarray:
    doc, x = indicators(texts)
    known = ratio[x] != 0
    doc, x = doc[known], x[known]
    n = len(texts)
    square = np.bincount(doc, weights=ratio[x] ** 2, minlength=n)
    dot = np.bincount(doc, weights=ratio[x] * weight[x], minlength=n)
    margin = dot / np.maximum(np.sqrt(square), 1e-9) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(model["a"] * margin + model["c"], -30, 30)))


def _score_batches(model: dict, batches):
    ratio, weight = np.zeros(N_FEATURES), np.zeros(N_FEATURES)
    ratio[model["feature"]], weight[model["feature"]] = model["ratio"], model["weight"]
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for s in text_slices(batch):
            score = score_texts(s.column(at), ratio, weight, model)
            rest = [s.column(i) for i in range(s.num_columns) if i != at]
            names = [f for i, f in enumerate(s.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(score)], [*names, "score"])


def quality_scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted for every document; reads the text only.

    Null texts count as empty; an empty text gets the score of a document
    without any known indicator.  Repeated rows get equal scores, null ids are
    passed through, other columns are ignored, an empty table gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    scored = id_and_text(docs).mapInArrow(functools.partial(_score_batches, model), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= KEEP_AT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs``, all columns, that the model does not reject."""
    small_arrow_batches(docs.sparkSession)

    def kept(batches):
        ratio, weight = np.zeros(N_FEATURES), np.zeros(N_FEATURES)
        ratio[model["feature"]], weight[model["feature"]] = model["ratio"], model["weight"]
        for batch in batches:
            at = [n.lower() for n in batch.schema.names].index("text")
            for s in text_slices(batch, column=batch.schema.names[at]):
                yield s.filter(pa.array(score_texts(s.column(at), ratio, weight, model) >= KEEP_AT))

    return docs.mapInArrow(kept, docs.schema)


# --- registered query --------------------------------------------------------


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_scores(docs, fit(docs, labels(spark, sf_dir)))
