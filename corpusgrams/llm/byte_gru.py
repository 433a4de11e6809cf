"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's UTF-8 bytes in both directions (its state begins anew
at each word, so a word that occurs often is run once per slice), labels every
byte position, and a document's language is the label of the highest mean
probability over all positions of its whole text.

It is trained in numpy by backpropagation through time, with Adam, on words of
at most ``PER_LANGUAGE`` documents a language (``CHARS`` characters from a place
of each, chosen by a hash): a bound on the driver's work.  All documents are
read whole when they are labelled.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, held_out, small_arrow_batches, text_slices
from .words import Words

HIDDEN = 12
SEGMENT = 32  # bytes of a word that are read with one state; longer words are several segments
PER_LANGUAGE, CHARS = 400, 600
STEPS, BATCH, RATE = 400, 512, 0.02
MEMORY = 300_000  # words whose result a Python worker remembers
BLOCK = 4096  # words that are run together
UNKNOWN = "und"


# --- the network (numpy) ------------------------------------------------------------


def segments(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes (n, width) padded with 0, sizes, word of each segment)."""
    whole = np.frombuffer(b"".join(words), np.uint8)
    size = np.array([len(w) for w in words], np.int64)
    pieces = np.maximum(-(-size // SEGMENT), 1)
    word = np.repeat(np.arange(len(words)), pieces)
    number = np.arange(len(word)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = (np.cumsum(size) - size)[word] + number * SEGMENT
    length = np.minimum(size[word] - number * SEGMENT, SEGMENT)
    width = max(1, int(length.max())) if len(length) else 1
    inside = np.arange(width) < length[:, None]
    out = np.zeros(inside.shape, np.uint8)
    out[inside] = whole[(start[:, None] + np.arange(width))[inside]]
    return out, length, word


def reverse(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each row's first ``length`` entries in reverse order (rows, positions, ...)."""
    at = np.arange(x.shape[1])
    at = np.where(at < length[:, None], length[:, None] - 1 - at, at)
    return x[np.arange(len(x))[:, None], at]


def start_network(n_labels: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    h = HIDDEN
    p = {"out_bias": np.zeros((n_labels, 1))}
    for d in ("f", "b"):
        p["in_" + d] = rng.normal(0, 0.3, (3 * h, 256))
        p["state_" + d] = rng.normal(0, 1 / np.sqrt(h), (3 * h, h))
        p["out_" + d] = rng.normal(0, 1 / np.sqrt(h), (n_labels, h))
    return {k: v.astype(np.float32) for k, v in p.items()}


def run_direction(p: dict[str, np.ndarray], d: str, x: np.ndarray, keep: bool = False):
    """States (positions, hidden, rows) of one direction; ``keep``: also what
    backpropagation needs.  Update and reset gates, then the candidate state."""
    h = HIDDEN
    state = np.zeros((h, len(x)), np.float32)
    states, kept = [], []
    for t in range(x.shape[1]):
        seen = np.take(p["in_" + d], x[:, t], axis=1)
        past = p["state_" + d] @ state
        gates = np.tanh((seen[: 2 * h] + past[: 2 * h]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
        update, reset = gates[:h], gates[h:]
        new = np.tanh(seen[2 * h:] + reset * past[2 * h:])
        if keep:
            kept.append((state, update, reset, new, past[2 * h:]))
        state = state + update * (new - state)
        states.append(state)
    return np.stack(states), kept


def back_direction(p: dict[str, np.ndarray], d: str, x: np.ndarray, kept: list, grad: np.ndarray) -> dict:
    """Backpropagation through time of the gradients of the states."""
    h = HIDDEN
    g_in, g_state = np.zeros_like(p["in_" + d]), np.zeros_like(p["state_" + d])
    later = np.zeros_like(grad[0])
    for t in range(x.shape[1] - 1, -1, -1):
        state, update, reset, new, past = kept[t]
        g = grad[t] + later
        g_new = g * update * (1 - new * new)
        g_update = g * (new - state) * update * (1 - update)
        g_reset = g_new * past * reset * (1 - reset)
        g_past = np.concatenate([g_update, g_reset, g_new * reset])
        g_seen = np.concatenate([g_update, g_reset, g_new])
        g_state += g_past @ state.T
        later = g * (1 - update) + p["state_" + d].T @ g_past
        np.add.at(g_in.T, x[:, t], g_seen.T)
    return {"in_" + d: g_in, "state_" + d: g_state}


def position_logits(p: dict[str, np.ndarray], x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(positions, labels, rows)."""
    forth, _ = run_direction(p, "f", x)
    back, _ = run_direction(p, "b", reverse(x, length))
    back = reverse(back.transpose(2, 0, 1), length).transpose(1, 2, 0)
    return p["out_f"] @ forth + p["out_b"] @ back + p["out_bias"]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(p: dict[str, np.ndarray], x: np.ndarray, length: np.ndarray, label: np.ndarray,
              weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy over the weighted positions, and its gradients."""
    forth, kept_f = run_direction(p, "f", x, keep=True)
    turned = reverse(x, length)
    back_turned, kept_b = run_direction(p, "b", turned, keep=True)
    back = reverse(back_turned.transpose(2, 0, 1), length).transpose(1, 2, 0)
    prob = softmax(p["out_f"] @ forth + p["out_b"] @ back + p["out_bias"])
    inside = (np.arange(x.shape[1])[:, None] < length) * weight
    total = inside.sum()
    row = np.arange(len(x))
    right = prob[:, label, row]
    loss = float(-(np.log(np.maximum(right, 1e-9)) * inside).sum() / total)
    g = prob
    g[:, label, row] -= 1
    g *= (inside / total)[:, None, :].astype(np.float32)
    out = {"out_f": np.einsum("tlr,thr->lh", g, forth, optimize=True),
           "out_b": np.einsum("tlr,thr->lh", g, back, optimize=True), "out_bias": g.sum((0, 2))[:, None]}
    out |= back_direction(p, "f", x, kept_f, p["out_f"].T @ g)
    g_back = reverse((p["out_b"].T @ g).transpose(2, 0, 1), length).transpose(1, 2, 0)
    out |= back_direction(p, "b", turned, kept_b, g_back)
    return loss, out


def train(words: list[bytes], label: np.ndarray, n_labels: int, steps: int = STEPS, seed: int = 3) -> dict:
    """Adam over random batches of words; languages count alike."""
    rng = np.random.default_rng(seed)
    p = start_network(n_labels, rng)
    x, length, word = segments(words)
    y = np.asarray(label)[word]
    weight = (1 / np.maximum(np.bincount(y, weights=length, minlength=n_labels), 1))[y].astype(np.float32)
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), min(BATCH, len(x)))
        n = length[pick]
        _, g = gradients(p, x[pick][:, : max(1, n.max())], n, y[pick], weight[pick])
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k in p:
            mean[k] = 0.9 * mean[k] + 0.1 * g[k]
            square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
            p[k] = (p[k] - rate * (mean[k] / (1 - 0.9**step))
                    / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p


class WordLabels:
    """For each word: its positions' probabilities summed up, its number of
    bytes, and whether it holds a letter."""

    def __init__(self, network: dict[str, np.ndarray]):
        import regex

        self.p, self.n_labels = network, len(network["out_bias"])
        self.letter = regex.compile(r"\p{L}").search
        self.memory: dict[bytes, int] = {}
        self.known = np.empty((0, self.n_labels + 1))

    def run(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), self.n_labels + 1))
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for at in range(0, len(order), BLOCK):
            rows = np.array(order[at:at + BLOCK])
            x, length, word = segments([words[i] for i in rows])
            for k in range(0, len(x), 2 * BLOCK):  # a very long word is many segments
                part, n, of = x[k:k + 2 * BLOCK], length[k:k + 2 * BLOCK], rows[word[k:k + 2 * BLOCK]]
                prob = softmax(position_logits(self.p, part, n))
                prob *= (np.arange(part.shape[1])[:, None] < n)[:, None, :]
                np.add.at(out[:, :-1], of, prob.sum(0).T)
        out[:, -1] = [self.letter(w.decode()) is not None for w in words]
        return out

    def rows(self, words: list[bytes]) -> np.ndarray:
        """(words, labels + 1), of distinct words."""
        new = [w for w in words if w not in self.memory]
        if len(self.memory) + len(new) > MEMORY:
            self.memory, self.known, new = {}, self.known[:0], words
        if new:
            n = len(self.known)
            self.known = np.concatenate([self.known, self.run(new)])
            self.memory.update(zip(new, range(n, n + len(new))))
        return self.known[[self.memory[w] for w in words]]


def label_texts(labeller: WordLabels, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: label number, its mean probability, whether it has a letter."""
    w = Words(texts)
    values = np.empty(len(w.start), object)
    values[:] = w.strings
    ids, distinct = pd.factorize(values)
    rows = labeller.rows(list(distinct))
    total = np.stack([w.sum_by_text(rows[ids, c]) for c in range(rows.shape[1])], axis=1)
    size = np.maximum(w.sum_by_text(w.end - w.start), 1)
    prob = total[:, :-1] / size[:, None]
    best = prob.argmax(1)
    return best, prob[np.arange(len(best)), best], total[:, -1] > 0


# --- Spark -----------------------------------------------------------------------


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, steps: int = STEPS) -> dict:
    """Learn from text and language outside the held-out fifth.

    Rows without id, text or language are left out.  The sample is drawn by a
    hash of the id, at a rate that gives about ``per_language`` documents of
    each language."""
    known = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"),
        docs["lang"].cast("string").alias("lang"),
    ).filter("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").filter(~held_out())
    counts = {r.lang: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return {"languages": [], "network": None}
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.greatest(F.length("text") - CHARS, F.lit(1)))
    chance = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(v) for k in languages
                            for v in (k, min(1 << 30, int((1 << 30) * 1.1 * per_language / counts[k]) + 1))])
    sample = (
        known.filter(chance < limits[F.col("lang")])
        .select("lang", F.substring(F.col("text"), (place + 1).cast("int"), F.lit(CHARS)).alias("part"), chance.alias("c"), "doc_id")
        .orderBy("c", "doc_id", "part").limit(2 * per_language * len(languages)).collect()
    )
    words, label = [], []
    for r in sample:
        for w in r.part.encode().split():
            words.append(w)
            label.append(languages.index(r.lang))
    if not words:
        return {"languages": [], "network": None}
    return {"languages": languages, "network": train(words, np.array(label), len(languages), steps)}


_LABELLER: list = [None, None]  # of this Python worker: the model's key and its WordLabels


def _labeller(model: dict) -> WordLabels:
    key = hash(b"".join(v.tobytes() for v in model["network"].values()))
    if _LABELLER[0] != key:
        _LABELLER[:] = [key, WordLabels(model["network"])]
    return _LABELLER[1]


def _label_batches(model: dict, batches):
    names = np.array([*model["languages"], UNKNOWN], object)
    labeller = _labeller(model) if model["network"] is not None else None
    for batch in batches:
        for s in text_slices(batch, 8 << 20):
            if labeller is None:
                lang, score = np.full(s.num_rows, UNKNOWN, object), np.zeros(s.num_rows)
            else:
                best, score, letters = label_texts(labeller, s.column("text"))
                lang, score = names[np.where(letters, best, len(names) - 1)], np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1))],
                ["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; reads the text only.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if there was nothing to learn from.  Repeated rows get equal results,
    null ids are passed through, other columns are ignored, an empty table
    gives no rows."""
    small_arrow_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    labelled = rows.mapInArrow(functools.partial(_label_batches, model), "doc_id long, lang_pred string, score double")
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


# --- registered query --------------------------------------------------------


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, fit(docs))
