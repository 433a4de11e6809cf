"""A hidden Markov language model: latent states by Baum-Welch, exact likelihoods by the forward recursion.

A text is its words (ASCII letters lower-cased) and one end token.  A path of
latent states emits it: state after state by a transition matrix, in each state
one class of words, and of the class one word:

    P(text) = sum over paths of  start * products of (transition, P(class | state))
              * product over words of P(word | class)

Every word belongs to one class: each of the most frequent words is a class of
its own, the end token too, all others share classes by their last three
characters.  So the matrices stay small however large the vocabulary grows,
while P(word | class) comes from counts of the whole training corpus (a word
with count c of a class with n tokens and v words: c / (n + v); any word that
training never saw: v / (n + v)).  It factors out of the sum over paths, so the
recursion runs over classes and stays exact.

* ``encode_blocks``: tasks number the distinct words of blocks of texts.
* The blocks' words are summed to corpus counts and joined back; no count table
  is broadcast or sent to the driver.  A block then keeps the classes of its
  tokens and the sums of its texts over everything that hangs on words alone.
* ``expected_counts``: one Baum-Welch step.  Each task runs the scaled forward
  and backward recursions over its blocks and hands over one row per class; the
  driver gets their sums, (classes x states) numbers.  Every step reads all
  training texts.
* ``score``: the forward recursion over all texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, saved_table, small_arrow_batches, text_slices
from .packed import pack_numbers, unpack_numbers

END = ""  # the end token; no word is empty
STATES = 8
FREQUENT = 4096  # words that are classes of their own
TAIL = 4096  # classes of all other words
SHARES = (1,) * 10  # Baum-Welch steps: one text in so many takes part
PRIOR = 1.0  # weight of the corpus's own class shares in a state's, in tokens
BLOCK_BYTES = 8 << 20
BATCH_TOKENS, BATCH_TEXTS = 75_000, 160  # the recursions' batches: so many tokens or, if more, so many texts
HELD_TOKENS = 6_000_000  # tokens that a task gathers before it cuts them into batches
RESCALE = 8  # tokens between two rescalings; P(class | state) is far above 1e-38

BLOCKS = "block long, doc_id array<long>, trains array<boolean>, n_tokens array<long>, words array<string>, times array<long>, tokens binary"
CLASSED = ("block long, doc_id array<long>, trains array<boolean>, n_tokens array<long>, n_known array<long>, "
           "add_one array<double>, within array<double>, classes binary")


# --- blocks of texts -------------------------------------------------------------


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of tokens of each text, the tokens as numbers, and the word of each number (0: the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))  # ASCII white space, A-Z only
    parts = lists.flatten()
    word = pc.greater(pc.binary_length(parts), 0)  # white space at a text's edges leaves empty parts
    text = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    text = text[word.to_numpy(zero_copy_only=False)]
    coded = parts.filter(word).dictionary_encode()
    size = np.bincount(text, minlength=len(lists)) + 1
    is_end = np.zeros(int(size.sum()), bool)
    is_end[np.cumsum(size) - 1] = True
    tokens = np.zeros(len(is_end), np.int64)
    tokens[~is_end] = coded.indices.to_numpy(zero_copy_only=False) + 1
    return size, tokens, pa.concat_arrays([pa.array([END], parts.type), coded.dictionary])


def _block(number: int, slices: list[pa.RecordBatch]) -> pa.RecordBatch:
    column = lambda c: pa.concat_arrays([s.column(c) for s in slices])
    size, tokens, words = tokens_of(column("text"))
    used = np.bincount(tokens, minlength=len(words))
    order = np.argsort(-used, kind="stable")  # frequent words get small numbers
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    learnt = np.repeat(column("trains").to_numpy(zero_copy_only=False), size)
    times = np.bincount(tokens[learnt], minlength=len(words))[order]
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = {"block": pa.array([number], pa.int64()), "doc_id": one(column("doc_id")), "trains": one(column("trains")),
               "n_tokens": one(pa.array(size)), "words": one(words.take(pa.array(order)).cast(pa.string())),
               "times": one(pa.array(times)), "tokens": pa.array([pack_numbers(place[tokens])], pa.binary())}
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, slices, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for s in text_slices(batch):
            slices.append(s)
            size += pc.sum(pc.binary_length(s.column("text"))).as_py() or 0
            if size >= BLOCK_BYTES:
                yield _block(number, slices)
                number, slices, size = number + 1, [], 0
    if slices:
        yield _block(number, slices)


def encode_blocks(docs: DataFrame, trains: Column) -> DataFrame:
    """One row per block of texts: its documents, its distinct words with how
    often they occur in training texts, and every token as the number of its word."""
    small_arrow_batches(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
                       F.coalesce(trains, F.lit(False)).alias("trains"))
    return saved_table(rows.mapInArrow(_blocks, BLOCKS))


# --- words, counts, classes ------------------------------------------------------


def word_counts(blocks: DataFrame) -> DataFrame:
    """word, count: all words of the blocks; the count is that in training texts."""
    words = blocks.select(F.inline(F.arrays_zip("words", "times"))).toDF("word", "times")
    return cut_lineage(words.groupBy("word").agg(F.sum("times").alias("count")))


def with_classes(counts: DataFrame, frequent: int = FREQUENT, tail: int = TAIL) -> DataFrame:
    """``counts`` with the class of each word: 0 for the end token, 1.. for the
    most frequent others (as many counts, from the highest down, as have no more
    than ``frequent`` words together), then ``tail`` classes by a hash of the
    last three characters."""
    spark = counts.sparkSession
    known = counts.filter((F.col("count") > 0) & (F.col("word") != END))
    running = F.sum("words").over(Window.orderBy(F.desc("count")))  # a row per distinct count: few
    by_count = known.groupBy("count").agg(F.count(F.lit(1)).alias("words")).withColumn("so_far", running)
    least = by_count.filter(F.col("so_far") <= frequent).agg(F.min("count")).first()[0]
    top = known.filter(F.col("count") >= least) if least is not None else known.limit(0)  # at most ``frequent`` words
    rows = top.select("count", F.xxhash64("word").alias("h")).collect()  # words can be long, hashes are not
    own = spark.createDataFrame([(r.h, i + 1) for i, r in enumerate(sorted(rows, key=lambda r: (-r[0], r.h)))],
                                "h long, own int")
    shared = F.pmod(F.xxhash64(F.right("word", F.lit(3))), F.lit(tail)) + 1 + frequent
    return (
        counts.withColumn("h", F.when(F.col("count") > 0, F.xxhash64("word")))
        .join(F.broadcast(own), "h", "left")  # at most ``frequent`` rows
        .select("word", "count", F.when(F.col("word") == END, 0).otherwise(F.coalesce("own", shared)).cast("int").alias("class"))
    )


def class_totals(classed: DataFrame, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words of each class."""
    n, v = np.zeros(n_classes, np.int64), np.zeros(n_classes, np.int64)
    rows = classed.filter("count > 0").groupBy("class").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("v"))
    for r in rows.collect():  # at most n_classes rows
        n[r["class"]], v[r["class"]] = r.n, r.v
    return n, v


def log_share(count: np.ndarray, n: np.ndarray, v: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """log10 P(word | class); ``alone``: classes without unknown words."""
    mass = np.where(count > 0, count, np.maximum(v, 1))
    return np.log10(mass) - np.log10(np.maximum(np.where(alone, n, n + v), 1))


def _classed(n: np.ndarray, v: np.ndarray, tail_from: int, blocks: pa.Table, answers: pa.Table) -> pa.Table:
    (row,) = blocks.to_pylist()
    place = answers["place"].to_numpy()
    count, of_class = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], of_class[place] = answers["count"].to_numpy(), answers["class"].to_numpy()
    share = log_share(count, n[of_class], v[of_class], of_class < tail_from)
    size = np.array(row["n_tokens"], np.int64)
    tokens = unpack_numbers(row["tokens"], int(size.sum()))
    first = np.cumsum(size) - size
    by_text = lambda value: np.add.reduceat(value[tokens], first) if len(size) else value[:0]
    out = {"block": pa.array([row["block"]], pa.int64()), "doc_id": pa.array([row["doc_id"]], pa.list_(pa.int64())),
           "trains": pa.array([row["trains"]], pa.list_(pa.bool_())),
           "n_tokens": pa.array([row["n_tokens"]], pa.list_(pa.int64())),
           "n_known": pa.array([by_text((count > 0).astype(np.int64))], pa.list_(pa.int64())),
           "add_one": pa.array([by_text(np.log10(count + 1.0))], pa.list_(pa.float64())),
           "within": pa.array([by_text(share)], pa.list_(pa.float64())),
           "classes": pa.array([pack_numbers(of_class[tokens])], pa.binary())}
    return pa.table(out)


def classed_blocks(blocks: DataFrame, classed: DataFrame, n: np.ndarray, v: np.ndarray, tail_from: int) -> DataFrame:
    """Blocks with their tokens' classes and, per text, n_known, the sum of
    log10(count + 1) and that of log10 P(word | class)."""
    places = blocks.select(F.col("block").alias("of_block"), F.posexplode("words").alias("place", "word"))
    answers = places.join(classed, "word").select("of_block", "place", "count", "class")
    out = (
        blocks.drop("words", "times").groupBy("block").cogroup(answers.groupBy("of_block"))
        .applyInArrow(functools.partial(_classed, n, v, tail_from), CLASSED)
    )
    return saved_table(out)


# --- the model (numpy) -----------------------------------------------------------


class Model:
    """start (S), move (S, S) and emit (classes, S): P(class | state) in its columns."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit


def class_shares(n: np.ndarray) -> np.ndarray:
    """The corpus's share of each class, none of them 0."""
    return (n + 1.0) / (n.sum() + len(n))


def first_model(n: np.ndarray, states: int, seed: int = 13) -> Model:
    """States that differ by random weights of the classes and tend to stay."""
    rng = np.random.default_rng(seed)
    emit = class_shares(n)[:, None] * np.exp(rng.normal(0, 1.0, (len(n), states)))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def time_major(classes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first tokens of all texts (longest text first), then all second ones, ...:
    the tokens, where each time starts, and the texts' order."""
    order = np.argsort(-size, kind="stable")
    n_at = np.searchsorted(-size[order], -np.arange(int(size.max(initial=0))), side="left")  # texts longer than t
    begin = np.concatenate([[0], np.cumsum(n_at)])
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    time = np.arange(len(classes)) - np.repeat(np.cumsum(size) - size, size)
    out = np.empty(len(classes), np.int64)
    out[begin[time] + np.repeat(rank, size)] = classes
    return out, begin, order


class Workspace:
    """Arrays that one batch after another is worked out in: fresh ones cost their pages each time.

    Only batches of up to ``most`` tokens are kept room for."""

    def __init__(self, most: int = 200_000):
        self.most, self.held = most, {}

    def __call__(self, name: str, shape: tuple[int, int]) -> np.ndarray:
        n = shape[0] * shape[1]
        if max(shape) > self.most:
            return np.empty(shape)
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty(n)
        return self.held[name][:n].reshape(shape)


def forward(model: Model, emitted: np.ndarray, begin: np.ndarray,
            room: Workspace | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward recursion over time-major tokens, ``emitted`` = P(class | state)
    of each: the scaled values, and the logarithm (base 10) of what each token's
    values were divided by.  Values are rescaled every ``RESCALE`` tokens."""
    values = (room or Workspace())("alpha", emitted.shape)
    scale, one = np.zeros(len(emitted)), np.ones(len(model.start))
    ends = begin.tolist()
    for t, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        now = values[a:b]
        if t:
            np.dot(values[ends[t - 1]:ends[t - 1] + b - a], model.move, out=now)
            now *= emitted[a:b]
        else:
            np.multiply(emitted[a:b], model.start, out=now)
        if t % RESCALE == RESCALE - 1:
            total = now @ one
            now /= total[:, None]
            scale[a:b] = np.log10(total)
    return values, scale


def backward(model: Model, emitted: np.ndarray, begin: np.ndarray, room: Workspace | None = None,
             ahead: np.ndarray | None = None) -> np.ndarray:
    """Backward values of time-major tokens, each text's up to a factor a token;
    ``ahead`` gets their products with ``emitted`` (but of the first tokens)."""
    values = (room or Workspace())("beta", emitted.shape)
    values.fill(1.0)
    ahead = np.empty_like(emitted) if ahead is None else ahead
    ends, turned, one = begin.tolist(), np.ascontiguousarray(model.move.T), np.ones(len(model.start))
    for t in range(len(ends) - 3, -1, -1):
        a, b, c = ends[t:t + 3]
        now = values[a:a + c - b]  # of the texts that go on
        np.dot(np.multiply(emitted[b:c], values[b:c], out=ahead[b:c]), turned, out=now)
        if t % RESCALE == 0:
            now /= (now @ one)[:, None]
    return values


def log_likelihood(model: Model, classes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's classes."""
    tokens, begin, order = time_major(classes, size)
    values, scale = forward(model, np.take(model.emit, tokens, axis=0), begin)
    text = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))  # place in ``order``
    last = begin[size[order] - 1] + np.arange(len(size))
    out = np.empty(len(size))
    out[order] = np.bincount(text, weights=scale, minlength=len(size)) + np.log10(np.take(values, last, axis=0).sum(1))
    return out


def baum_welch(model: Model, classes: np.ndarray, size: np.ndarray,
               room: Workspace | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts of start (S), move (S, S), emit (classes, S)."""
    room = room or Workspace()
    n_classes, states = model.emit.shape
    if not len(classes):
        return np.zeros(states), np.zeros((states, states)), np.zeros((n_classes, states))
    tokens, begin, _ = time_major(classes, size)
    shape = (len(tokens), states)
    emitted, ahead = np.take(model.emit, tokens, axis=0, out=room("emitted", shape), mode="clip"), room("ahead", shape)
    (alpha, scale), beta = forward(model, emitted, begin, room), backward(model, emitted, begin, room, ahead)
    # moves: from each token that is not its text's last to the next one
    n_next = np.diff(begin)[1:]
    here = np.arange(int(n_next.sum())) + np.repeat(begin[:-2] - (np.cumsum(n_next) - n_next), n_next)
    before = np.take(alpha, here, axis=0, out=room("before", (len(here), states)), mode="clip")
    alpha *= beta
    share = 1 / (alpha @ np.ones(states))
    # a token's forward values times what they were divided by are those of the token before, moved, times ``emitted``
    first, undo = int(begin[1]), share.copy()
    scaled = np.flatnonzero(scale)
    undo[scaled] /= 10.0 ** scale[scaled]
    before *= undo[first:, None]
    moved = before.T @ ahead[first:] * model.move
    alpha *= share[:, None]  # the states' probabilities given the whole text
    turned = room("beta", shape[::-1])  # no longer needed
    np.copyto(turned, alpha.T)
    emit = np.stack([np.bincount(tokens, weights=x, minlength=n_classes) for x in turned], axis=1)
    return alpha[:first].sum(0), moved, emit


def next_model(start: np.ndarray, move: np.ndarray, emit: np.ndarray, shares: np.ndarray) -> Model:
    """The M step; each count distribution gets ``PRIOR`` tokens of a smooth one."""
    states = len(start)
    even = PRIOR / states
    return Model((start + even) / (start.sum() + PRIOR), (move + even) / (move.sum(1, keepdims=True) + PRIOR),
                 (emit + PRIOR * shares[:, None]) / (emit.sum(0) + PRIOR))


# --- Baum-Welch over the cluster -------------------------------------------------


def batches_of_texts(size: np.ndarray, limit: int = BATCH_TOKENS, side: int = BATCH_TEXTS) -> Iterator[np.ndarray]:
    """Texts of similar length together: about ``limit`` tokens, or ``side``
    texts if that is more (a step of the recursions then has enough to do)."""
    order = np.argsort(size, kind="stable")
    total = np.concatenate([[0], np.cumsum(size[order])])
    at = 0
    while at < len(order):
        to = max(int(np.searchsorted(total, total[at] + limit, side="right")) - 1, at + side)
        yield order[at:to]
        at = to


def take_texts(classes: np.ndarray, size: np.ndarray, texts: np.ndarray) -> np.ndarray:
    first = (np.cumsum(size) - size)[texts]
    n = size[texts]
    return classes[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def _texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and classes of a block's texts."""
    size = np.array(row["n_tokens"], np.int64)
    return size, unpack_numbers(row["classes"], int(size.sum()))


def _chosen(share: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training texts, one in ``share`` by a hash of the id, some blocks' together."""
    sizes, parts = [], []

    def gathered() -> pa.RecordBatch:
        size = np.concatenate(sizes)
        row = pack_numbers(np.concatenate(parts))
        sizes.clear()
        parts.clear()
        return pa.RecordBatch.from_arrays([pa.array([size], pa.list_(pa.int64())), pa.array([row], pa.binary())],
                                          ["n_tokens", "classes"])

    for batch in batches:
        for row in batch.to_pylist():
            size, classes = _texts(row)
            ids = np.array([i or 0 for i in row["doc_id"]], np.int64).view(np.uint64)
            spread = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            texts = np.flatnonzero(np.array(row["trains"], bool) & (spread % np.uint64(share) == 0))
            sizes.append(size[texts])
            parts.append(take_texts(classes, size, texts))
            if sum(map(len, parts)) >= HELD_TOKENS:
                yield gathered()
    if sizes:
        yield gathered()


def training_texts(classed: DataFrame, share: int = 1) -> DataFrame:
    """n_tokens, classes: what one Baum-Welch step reads, written out."""
    rows = classed.select("doc_id", "trains", "n_tokens", "classes")
    return saved_table(rows.mapInArrow(functools.partial(_chosen, share), "n_tokens array<long>, classes binary"))


def _expected(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n_classes, states = model.emit.shape
    total, room = np.zeros((n_classes + states + 1, states)), Workspace()  # classes, moves, start
    for batch in batches:
        for row in batch.to_pylist():
            size, classes = _texts(row)
            for part in batches_of_texts(size):
                start, move, emit = baum_welch(model, take_texts(classes, size, part).astype(np.int64), size[part], room)
                total[:n_classes] += emit
                total[n_classes:-1] += move
                total[-1] += start
    some = np.flatnonzero(total.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(total[some, s]) for s in range(states))],
                                     ["place", *(f"s{s}" for s in range(states))])


def expected_counts(texts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected start, move and emit counts of training texts, summed over all partitions."""
    n_classes, states = model.emit.shape
    names = [f"s{s}" for s in range(states)]
    schema = "place long, " + ", ".join(f"{c} double" for c in names)
    rows = texts.mapInArrow(functools.partial(_expected, model), schema)
    total = np.zeros((n_classes + states + 1, states))
    for r in rows.groupBy("place").agg(*(F.sum(c).alias(c) for c in names)).collect():  # a row per class
        total[r.place] = r[1:]
    return total[-1], total[n_classes:-1], total[:n_classes]


def train(classed: DataFrame, n: np.ndarray, states: int = STATES, shares: tuple[int, ...] = SHARES) -> Model:
    """Baum-Welch from a random start, one step per entry of ``shares``."""
    model = first_model(n, states)
    texts = {share: training_texts(classed, share) for share in set(shares)}
    for share in shares:
        model = next_model(*expected_counts(texts[share], model), class_shares(n))
    return model


# --- the operator ----------------------------------------------------------------


def _scored(model: Model, tokens: int, words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            (size, classes), score = _texts(row), np.array(row["within"])
            for part in batches_of_texts(size):
                score[part] += log_likelihood(model, take_texts(classes, size, part).astype(np.int64), size[part])
            base = np.array(row["add_one"]) - size * np.log10(tokens + words + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array([not t for t in row["trains"]], pa.bool_()),
                 pa.array(size), pa.array(row["n_known"], pa.int64()), pa.array(np.full(len(size), tokens)),
                 pa.array(base), pa.array(score)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame, trains: Column, states: int = STATES, frequent: int = FREQUENT,
                    tail: int = TAIL, shares: tuple[int, ...] = SHARES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``trains`` says which rows the model learns from (null: not); every row is
    scored.  ``n_tokens`` counts the words and the end, ``n_known`` those seen
    in training, ``base_score`` is the text's log10 probability with add-one
    unigrams, ``score`` that of the hidden Markov model.  Null and empty texts
    are the end token alone.  Repeated rows are learnt from and scored each for
    itself; null ids are passed through, other columns ignored; an empty table
    gives no rows, and without training rows all words are equally unknown.
    """
    blocks = encode_blocks(docs, trains)
    classed = with_classes(word_counts(blocks), frequent, tail)
    n, v = class_totals(classed, 1 + frequent + tail)
    texts = classed_blocks(blocks, classed, n, v, 1 + frequent)
    model = train(texts, n, states, shares)
    return texts.mapInArrow(functools.partial(_scored, model, int(n.sum()), int(v.sum())), SCORED)


# --- registered query ------------------------------------------------------------


def op13_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model learns from the documents whose id hash has another remainder by 7 than 2."""
    return score_documents(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
