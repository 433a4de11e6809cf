"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding runs the score-ordered agenda of adjacent symbol pairs (``agenda``)
over the vocabulary's pieces and scores.  A piece holds the space mark only as
its first characters, so no merge crosses from another character into a space
mark, and none crosses a character that no longer piece contains (the line
feed, usually): the text is cut there, and each distinct chunk of an Arrow
batch is merged once.  A bounded memory keeps chunks between batches.

Every new chunk is checked against the sentencepiece library's own encoding in
the same batch; a difference raises.  Decoding is the library's.
"""

from __future__ import annotations

import functools
import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .agenda import PairTable, merge_all
from .common import documents, id_and_text, small_arrow_batches, text_slices

MARK = "▁"
MEMORY = 400_000  # chunks that a Python worker remembers between batches


class PieceCodec:
    """Vocabulary, pair table and chunk memory of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        normal = {}
        self.byte_id = [sp.unk_id()] * 256
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal[sp.id_to_piece(i)] = i
        self.fallback = any(sp.is_byte(i) for i in range(n))
        if sp.normalize(f" a½  b{MARK} \n") != f"{MARK}{MARK}a½{MARK}{MARK}b{MARK}{MARK}\n":
            raise ValueError("the model's normaliser is not the identity with a leading space")
        if self.library.encode("\n")[-1:] != self.library.encode("a\n")[-1:]:
            raise ValueError("the line feed does not stand alone in this vocabulary")
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece holds the space mark behind other characters")
        self.n_pieces = n
        symbols = dict(normal)  # a character of a piece need not be a piece itself
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(symbols) + n)
        self.symbols = symbols
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = (i, sp.get_score(i))
        self.table = PairTable(pairs, n + len(symbols) + 1)
        self.text_of = {i: p for p, i in symbols.items()}
        single = sorted((ord(p), i) for p, i in symbols.items() if len(p) == 1)
        self.points = np.array([p for p, _ in single])
        self.point_symbol = np.array([i for _, i in single])
        joining = {c for p in normal if len(p) > 1 for c in p}
        self.cut = "" if "\n" in joining else "\n"
        self.chunks = re.compile(f"{MARK}+[^{MARK}{self.cut}]*|[^{MARK}{self.cut}]+" + ("|\n" if self.cut else ""))
        self.decimal = [str(i) for i in range(n)]
        self.memory: dict[str, bytes] = {}

    def _spell(self, chunk: str, merged: list[int]) -> list[int]:
        """Ids of merged symbols of which some are no pieces: their bytes."""
        out: list[int] = []
        rest = iter(c for c in chunk if c not in self.symbols)
        for s in merged:
            if 0 <= s < self.n_pieces:
                out.append(s)
            else:
                c = self.text_of[s] if s >= 0 else next(rest)
                out += [self.byte_id[b] for b in c.encode()] if self.fallback else [self.library.unk_id()]
        return out

    def _check(self, chunks: list[str], ids: np.ndarray) -> None:
        """Compare with the library, which puts a space mark before each text:
        it stands for the chunk's own first mark, or for one before a line feed
        that is put there for a chunk without."""
        own = [c[0] == MARK and len(c) > 1 for c in chunks]
        theirs = self.library.encode([c[1:] if o else "\n" + c for o, c in zip(own, chunks)], num_threads=1)
        skip = len(self.library.encode("\n"))
        theirs = [t if o else t[skip:] for o, t in zip(own, theirs)]
        if list(chain.from_iterable(theirs)) != ids.tolist():
            raise ValueError("an encoding differs from the sentencepiece library's")

    def learn(self, wanted: set[str]) -> None:
        """Encode the chunks that are not remembered."""
        new = [c for c in wanted if c not in self.memory]
        if len(self.memory) + len(new) > MEMORY:
            self.memory.clear()
            new = list(wanted)
        if not new:
            return
        code = np.frombuffer("".join(new).encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, code), len(self.points) - 1)
        flat = np.where(self.points[at] == code, self.point_symbol[at], -1)
        ids, size = merge_all(flat, np.array([len(c) for c in new]), self.table)
        odd = (ids < 0) | (ids >= self.n_pieces)
        if odd.any():
            end = np.cumsum(size)
            rows = np.unique(np.searchsorted(end, np.flatnonzero(odd), side="right"))
            parts = np.split(ids, end[:-1])
            for i in rows:
                parts[i] = np.array(self._spell(new[i], parts[i].tolist()))
                size[i] = len(parts[i])
            ids = np.concatenate(parts)
        self._check(new, ids)
        packed, end = ids.astype("<i4").tobytes(), (4 * np.cumsum(size)).tolist()
        self.memory.update(zip(new, (packed[a:b] for a, b in zip([0, *end], end))))

    def split(self, text: str) -> list[str]:
        return self.chunks.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        known = self.memory.__getitem__
        return [np.frombuffer(b"".join(map(known, s)), "<i4").tolist() for s in split]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


@functools.lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One per Python worker, kept between tasks."""
    return PieceCodec(model_file)


def _encoded(model_file: str, batches):
    c = codec(model_file)
    for batch in batches:
        for s in text_slices(batch):
            ids = c.encode(s.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(c.decode(ids))],
                ["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids array<int>, decoded: whole texts, no begin or end ids.

    Null and empty texts have no ids and decode to the empty string.  Repeated
    rows and null ids are passed through, other columns ignored.  ``model_file``
    must lie at the same local path on every executor.
    """
    small_arrow_batches(docs.sparkSession)
    return id_and_text(docs).mapInArrow(functools.partial(_encoded, model_file),
                                        "doc_id long, ids array<int>, decoded string")


def _digests(model_file: str, batches):
    c = codec(model_file)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for batch in batches:
        for s in text_slices(batch, 1 << 20):
            ids = c.encode(s.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [s.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([sha(",".join(map(c.decimal.__getitem__, x))) for x in ids]),
                 pa.array([sha(t) for t in c.decode(ids)])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ``PieceCodec``'s ids and decoded texts (the ids stay in the tasks)."""
    import public_tokenizers

    small_arrow_batches(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    return id_and_text(documents(spark, sf_dir)).mapInArrow(
        functools.partial(_digests, model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
