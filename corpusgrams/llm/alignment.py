"""Alignment of two tokenizations of the same text, by divide and conquer at shared cuts.

Two tokenizers cut the same bytes into tokens.  A byte offset where a token of
either side ends is a shared cut.  An interval of tokens is split at the shared
cut nearest to its middle: starting from the middle token of the first side and
going outwards, each token's end is looked for among the other side's ends by
bisection.  Both halves are split the same way; an interval without a cut is a
leaf, one group of the alignment.  The intervals of one depth, of all texts of
a block, are split together in numpy.

A blank between two characters that are none is a shared cut whatever stands
around it: no token of either vocabulary crosses from another character into a
blank.  So texts are first cut there, and each distinct stretch of a block (a
word, mostly) is encoded and aligned once.

Inside a group every token pair whose byte ranges overlap is a link.  A pair's
count is how many links of the corpus hold it.  Counting works on blocks of
texts: a task keeps its block's distinct pairs, the pairs of each stretch and the
stretches of each text; the pairs of all blocks are summed and joined back, so
neither a link nor a pair table passes through the driver or a broadcast (only
the highest count of each id of the second vocabulary does, one row an id).
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, id_and_text, saved_table, small_arrow_batches, text_slices
from .packed import pack_numbers, unpack_numbers

BLOCK_BYTES = 6 << 20  # text of a block (more only if one text has more)
ID_BITS = 32  # a pair is (first id << ID_BITS) | second id

ALIGNED = ("doc_id long, a_ids array<int>, b_ids array<int>, a_lengths array<int>, b_lengths array<int>")
BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, groups_sha256 array<string>, n_stretches array<long>, stretches binary, "
          "stretch_links array<long>, pairs array<long>, times array<long>, which binary")
ANSWER = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


# --- the two tokenizers ----------------------------------------------------------


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Ids of texts by a byte-level vocabulary; special strings are plain text.

    Texts of Latin letters are encoded by tiktoken over the vocabulary's own
    ranks, several times faster than the tokenizers library; texts with other
    characters (whose classes the two libraries' Unicode tables might tell
    apart) or with very long words or blanks by the latter."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        special = {i for i, t in self.library.get_added_tokens_decoder().items()}
        of = byte_level_alphabet()
        vocabulary = self.library.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            if i not in special:
                self.bytes[i] = bytes(of[c] for c in t)
        ranks = {t: i for i, t in enumerate(self.bytes) if i not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})
        self.blanks = re.compile(r"\s{400}").search

    def plain(self, text: str) -> bool:
        """Latin letters, no very long word or blank."""
        if not text.isascii() and max(text) > "\u024f":
            return False
        return max(map(len, text.split()), default=0) < 400 and not self.blanks(text)

    def ids(self, texts: list[str]) -> list[list[int]]:
        out = [self.fast.encode_ordinary(t) if self.plain(t) else None for t in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(rest), 100):
            part = rest[at:at + 100]
            found = self.library.encode_batch_fast([texts[i] for i in part], add_special_tokens=False)
            for i, e in zip(part, found):
                out[i] = e.ids
        return out


class Pieces:
    """Ids of texts by a sentencepiece model, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                      else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


# --- alignment of a slice (numpy) ------------------------------------------------


def _ragged(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """first[i], first[i]+1, ... (size[i] of them) for every i, and the i of each."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + first[owner], owner


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each interval of tokens low..high-1 of A, the inner token whose end is
    also an end of B and which is nearest to the middle (the left of equals); -1 if none.

    Looks 1, 1, 2, 4, ... tokens further out on either side, until one is found or the interval is left."""
    found = np.full(len(low), -1, np.int64)
    live = np.flatnonzero(high - low >= 2)
    middle = (low + high - 2) // 2
    near, far = 0, 1  # distances looked at: near..far-1
    while len(live):
        m, last = middle[live], high[live] - 2
        left, left_of = _ragged(np.maximum(m - far + 1, low[live]), np.clip(m - near - np.maximum(m - far + 1, low[live]) + 1, 0, None))
        first = m + max(near, 1)
        right, right_of = _ragged(first, np.clip(np.minimum(m + far - 1, last) - first + 1, 0, None))
        token, owner = np.concatenate([left, right]), np.concatenate([left_of, right_of])
        end = ends_a[token]
        at = np.searchsorted(ends_b, end)  # bisection; texts never share offsets, so all of B may be searched
        hit = ends_b[at] == end
        token, owner = token[hit], owner[hit]
        if len(token):
            distance = 2 * np.abs(token - m[owner]) + (token > m[owner])
            order = np.lexsort((distance, owner))
            owner, index = np.unique(owner[order], return_index=True)
            found[live[owner]] = token[order][index]
        more = (found[live] < 0) & ((m - far >= low[live]) | (m + far <= last))
        live = live[more]
        near, far = far, 2 * far
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray) -> np.ndarray:
    """The tokens of A (ascending) whose ends are shared cuts.

    ``ends_a``, ``ends_b``: ascending end offsets of the tokens of many texts
    laid end to end; ``last_a``: the last token of A of each text, where B also
    ends.  Divide and conquer, all intervals of a depth together."""
    cuts = [last_a]
    high = last_a + 1
    low = np.concatenate([[0], high[:-1]]) if len(high) else high
    while len(low):
        cut = _near_middle(ends_a, ends_b, low, high)
        inner = cut >= 0
        low, high, cut = low[inner], high[inner], cut[inner]
        cuts.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut + 1, high])
    return np.sort(np.concatenate(cuts))


_BLANK = re.compile(r"(?<=\S) (?=\S)")
_SPACES = re.compile(r"\s\s").search


def stretches(text: str) -> list[str]:
    """The text cut at blanks between other characters (which are left out)."""
    if not text or text[0].isspace() or text[-1].isspace() or _SPACES(text):
        return _BLANK.split(text)
    return text.split(" ")


class Alignment:
    """Tokens, groups and links of a list of stretches, each with a space before it.
    Stretches that are not spelled by the tokens of both sides have none."""

    def __init__(self, texts: list[str], a: ByteLevel, b: Pieces):
        ids_a, ids_b = a.ids([" " + t for t in texts]), b.ids(texts)
        for i, t in enumerate(texts):
            whole = b" " + t.encode()
            if b"".join([a.bytes[x] for x in ids_a[i]]) != whole or b"".join([b.bytes[x] for x in ids_b[i]]) != whole:
                ids_a[i], ids_b[i] = [], []
        self.n_a, self.n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        self.a, self.b = (np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
                          for ids, n in ((ids_a, self.n_a), (ids_b, self.n_b)))
        size_a, size_b = (np.array([len(x) for x in v.bytes], np.int64) for v in (a, b))
        self.ends_a, self.ends_b = np.cumsum(size_a[self.a]), np.cumsum(size_b[self.b])
        full = self.n_a > 0  # a stretch and its space have a token of A, unless it failed
        last = np.cumsum(self.n_a)[full] - 1
        self.cut_a = shared_cuts(self.ends_a, self.ends_b, last)
        self.cut_b = np.searchsorted(self.ends_b, self.ends_a[self.cut_a])
        cuts_before = np.concatenate([[0], np.searchsorted(self.cut_a, np.cumsum(self.n_a))])
        self.n_groups = np.diff(cuts_before)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A id, B id and text of every link.  Between two neighbouring ends of
        either side lies exactly one overlap, and no pair overlaps twice."""
        n = len(self.ends_a)
        order = np.argsort(np.concatenate([self.ends_a, self.ends_b]), kind="stable")  # two sorted runs
        of_a = order < n
        end = np.concatenate([self.ends_a, self.ends_b])[order]
        last = np.concatenate([end[1:] != end[:-1], [True]]) if n else of_a  # the later of two equal ends
        at_a, at_b = np.cumsum(of_a)[last], np.cumsum(~of_a)[last]  # tokens ended so far, this end included
        closed = np.diff(at_a, prepend=0) > 0
        at_a, at_b = at_a - closed, at_b - (np.diff(at_b, prepend=0) > 0)
        n_links = self.n_a + self.n_b - self.n_groups
        return self.a[at_a], self.b[at_b], np.repeat(np.arange(len(n_links)), n_links)

    def group_sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B in each group, of all texts."""
        return np.diff(self.cut_a, prepend=-1), np.diff(self.cut_b, prepend=-1)


@functools.lru_cache(maxsize=4)
def _decimals(n_a: int, n_b: int) -> list[str]:
    """Ids as text, followed by what separates them (see ``written``)."""
    n = max(n_a, n_b)
    return [f"{i}{s}" for s in (",", "|", ";", "") for i in range(n)]


def written(x: Alignment, n_ids: int) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3`` ('' without tokens)."""
    table = _decimals(n_ids, n_ids)
    total = len(x.a) + len(x.b)
    size_a, size_b = x.group_sizes()
    group_a, group_b = (np.repeat(np.arange(len(n)), n) for n in (size_a, size_b))
    before_a, before_b = np.concatenate([[0], x.cut_a + 1]), np.concatenate([[0], x.cut_b + 1])
    code = np.empty(total, np.int64)
    place_a = np.arange(len(x.a)) + before_b[group_a]
    place_b = np.arange(len(x.b)) + before_a[group_b + 1]
    code[place_a], code[place_b] = x.a, x.b
    code[place_a[x.cut_a]] += n_ids
    last = np.zeros(len(x.cut_a), bool)
    last[np.cumsum(x.n_groups)[x.n_groups > 0] - 1] = True
    code[place_b[x.cut_b]] += np.where(last, 3, 2) * n_ids
    parts = list(map(table.__getitem__, code.tolist()))
    end = np.cumsum(x.n_a + x.n_b).tolist()
    return ["".join(parts[i:j]) for i, j in zip([0, *end], end)]


@functools.lru_cache(maxsize=2)
def _vocabularies(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    """One pair per Python worker, kept between tasks."""
    return ByteLevel(a_path), Pieces(b_path)


class Block:
    """Texts (null: empty) as their stretches; those with a failing stretch, and empty ones, have no tokens."""

    def __init__(self, texts: list[str | None], a: ByteLevel, b: Pieces):
        cut = [stretches(t) if t else [] for t in texts]
        coded = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.x = Alignment(coded.dictionary.to_pylist(), a, b)
        self.size = np.array([len(c) for c in cut], np.int64)
        failed = _sum_by(self._owner(), (self.x.n_a == 0).astype(np.int64)[self.code], len(texts)) > 0
        self.code = self.code[np.repeat(~failed, self.size)]
        self.size[failed] = 0
        self.stretch_links = self.x.n_a + self.x.n_b - self.x.n_groups

    def _owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)

    def total(self, of_stretch: np.ndarray) -> np.ndarray:
        """Sum of a number of each stretch, by text."""
        return _sum_by(self._owner(), of_stretch[self.code], len(self.size))

    def lists(self, values: np.ndarray, n: np.ndarray) -> pa.Array:
        """Each text's values; ``values`` holds those of the stretches end to end, ``n`` how many they are."""
        place, _ = _ragged((np.cumsum(n) - n)[self.code], n[self.code])
        offsets = np.concatenate([[0], np.cumsum(self.total(n))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[place].astype(np.int32)))

    def digests(self, n_ids: int) -> list[str]:
        """SHA-256 of each text's groups as written, '' without tokens."""
        text = written(self.x, n_ids)
        parts = list(map(text.__getitem__, self.code.tolist()))
        end = np.cumsum(self.size).tolist()
        return [hashlib.sha256(";".join(parts[i:j]).encode()).hexdigest() if j > i else ""
                for i, j in zip([0, *end], end)]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """doc_ids and texts of about ``BLOCK_BYTES`` of text."""
    doc_id, texts, size = [], [], 0
    for batch in batches:
        for s in text_slices(batch, BLOCK_BYTES):
            doc_id += s.column("doc_id").to_pylist()
            new = s.column("text").to_pylist()
            texts += new
            size += sum(map(len, new))
            if size >= BLOCK_BYTES:
                yield doc_id, texts
                doc_id, texts, size = [], [], 0
    if doc_id:
        yield doc_id, texts


# --- the operator ----------------------------------------------------------------


def _aligned(a_path: str, b_path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _vocabularies(a_path, b_path)
    for doc_id, texts in _gathered(batches):
        block = Block(texts, a, b)
        x, (size_a, size_b) = block.x, block.x.group_sizes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), block.lists(x.a, x.n_a), block.lists(x.b, x.n_b),
             block.lists(size_a, x.n_groups), block.lists(size_b, x.n_groups)],
            ["doc_id", "a_ids", "b_ids", "a_lengths", "b_lengths"])


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, a_ids, b_ids, a_lengths, b_lengths: the tokens of both sides and
    how many of each make up every group, in order.

    ``a_path``: a byte-level vocabulary of the tokenizers library, given the text
    with a space before it; ``b_path``: a sentencepiece model that adds this
    space itself.  Texts that are null, empty or not spelled by the tokens of
    both sides have empty arrays.  Repeated rows and null ids are passed
    through, other columns ignored; an empty table gives no rows.
    """
    small_arrow_batches(docs.sparkSession)
    return id_and_text(docs).mapInArrow(functools.partial(_aligned, a_path, b_path), ALIGNED)


def _block_row(number: int, doc_id: list, block: Block, n_ids: int) -> pa.RecordBatch:
    """A block with its distinct pairs, the most frequent first, and the pair of every stretch's links."""
    x = block.x
    id_a, id_b, stretch = x.links()
    which, distinct = pd.factorize((id_a << ID_BITS) | id_b)
    used = np.bincount(block.code, minlength=len(x.n_a))
    times = np.bincount(which, weights=used[stretch], minlength=len(distinct)).astype(np.int64)
    order = np.argsort(-times, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    row = {"block": [number], "doc_id": [doc_id], "n_a": [block.total(x.n_a)], "n_b": [block.total(x.n_b)],
           "n_groups": [block.total(x.n_groups)], "n_links": [block.total(block.stretch_links)],
           "groups_sha256": [block.digests(n_ids)], "n_stretches": [block.size],
           "stretches": [pack_numbers(block.code)], "stretch_links": [block.stretch_links],
           "pairs": [distinct[order]], "times": [times[order]], "which": [pack_numbers(place[which])]}
    types = {"block": pa.int64(), "which": pa.binary(), "stretches": pa.binary(), "groups_sha256": pa.list_(pa.string())}
    return pa.RecordBatch.from_arrays([pa.array(v, types.get(c, pa.list_(pa.int64()))) for c, v in row.items()], list(row))


def _blocks(a_path: str, b_path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _vocabularies(a_path, b_path)
    first, n_ids = TaskContext.get().partitionId() << 32, max(len(a.bytes), len(b.bytes))
    for k, (doc_id, texts) in enumerate(_gathered(batches)):
        yield _block_row(first + k, doc_id, Block(texts, a, b), n_ids)


def _answer(blocks: pa.Table, counts: pa.Table) -> pa.Table:
    """The sums of a block's documents over their links."""
    (row,) = blocks.to_pylist()
    count, best = (np.zeros(counts.num_rows, np.int64) for _ in range(2))
    place = counts["place"].to_numpy()
    count[place], best[place] = counts["count"].to_numpy(), counts["best"].to_numpy(zero_copy_only=False)
    links, size = np.array(row["stretch_links"], np.int64), np.array(row["n_stretches"], np.int64)
    which = unpack_numbers(row["which"], int(links.sum()))
    stretch, text = np.repeat(np.arange(len(links)), links), np.repeat(np.arange(len(size)), size)
    code = unpack_numbers(row["stretches"], int(size.sum()))
    total = lambda v: _sum_by(text, _sum_by(stretch, v[which], len(links))[code], len(size))
    out = {c: row[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    out |= {"n_best": total(best), "count_sum": total(count)}
    columns = {c: pa.array(v, pa.int64()) for c, v in out.items()}
    return pa.table(columns | {"groups_sha256": pa.array(row["groups_sha256"], pa.string())})


def _sum_by(group: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Exact integer sums by ascending group number."""
    total = np.concatenate([[0], np.cumsum(value)])
    end = np.searchsorted(group, np.arange(n), side="right")
    return np.diff(total[end], prepend=0)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, count, best: the corpus-wide count of each linked id pair, and
    whether no other pair of its second id has a higher one."""
    pairs = blocks.select(F.inline(F.arrays_zip("pairs", "times"))).toDF("pair", "times").filter("times > 0")
    counts = cut_lineage(pairs.groupBy("pair").agg(F.sum("times").alias("count")))
    second = F.col("pair").bitwiseAND((1 << ID_BITS) - 1)
    top = counts.groupBy(second.alias("second")).agg(F.max("count").alias("top"))  # a row per id of a vocabulary
    return counts.withColumn("second", second).join(F.broadcast(top), "second").select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best"))


def alignment_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose pair is the most frequent of its second id (ties
    included); ``count_sum``: the counts of all links' pairs, summed.  Edge
    cases as in ``align_documents``; documents without tokens have zeros and ''.
    """
    small_arrow_batches(docs.sparkSession)
    blocks = saved_table(id_and_text(docs).mapInArrow(functools.partial(_blocks, a_path, b_path), BLOCKS))
    places = blocks.select(F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair"))
    counts = places.join(pair_counts(blocks), "pair", "left").select(  # left: pairs of failing texts only
        "of_block", "place", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("best", F.lit(False)).alias("best"))
    return (
        blocks.drop("pairs", "times").groupBy("block").cogroup(counts.groupBy("of_block"))
        .applyInArrow(_answer, ANSWER)
    )


# --- registered query ------------------------------------------------------------


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))
