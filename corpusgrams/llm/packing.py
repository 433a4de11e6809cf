"""Sum-of-squares packing of token documents into fixed-size sequences.

Documents arrive one after another.  A level array counts the partially filled
windows of each fill level; a document goes to the level (or a new window) for
which the sum of the squared counts grows least, the fullest of equals.  A
document longer than a window is cut into full windows and a rest.

Each task packs the documents of its own partition.  At its end the windows
still open are filled up by cutting the pieces of the emptiest ones, so at most
one window of a task stays open; these few (with their ids) are shuffled in
groups of ``MEET_TASKS`` tasks and packed once more the same way.  So padding is
at most one window for so many tasks, and no task sees more than its partition
or ``MEET_TASKS`` windows.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import documents, id_and_text, small_arrow_batches, text_slices

LENGTH = 4096
MEET_TASKS = 128
SLICE = 1 << 20  # bytes of text whose words a Python worker splits at a time
MEMORY = 100_000  # words, and as many letter runs, that a Python worker remembers (twice that while they are sorted out)

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary, task long")
_TYPES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
          ("task", pa.int64())]


# --- the packer (inside a task) --------------------------------------------------

Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids as 4-byte integers, tokens of the document


class LevelPacker:
    """Online packing; ``add`` returns the windows that became full."""

    def __init__(self, size: int = LENGTH):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # of open windows by fill; 0 and size stay 0
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def level(self, n: int) -> int:
        """The fill level (0: a new window) that an item of ``n`` goes to."""
        before = self.count[: self.size - n + 1]
        grow = np.where(before > 0, 1 - 2 * before, np.iinfo(np.int64).max)
        grow[0] = 0
        after = 2 * self.count[n:] + 1
        after[-1] = 0  # a full window is no longer open
        possible = before > 0
        possible[0] = True
        total = np.where(possible, np.where(possible, grow, 0) + after, np.iinfo(np.int64).max)
        best = total.min()
        return int(np.flatnonzero(total == best)[-1])

    def add(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int) -> list[list[Piece]]:
        full = []
        step = 4 * self.size
        while len(ids) >= step:
            full.append([(doc_id, start, ids[:step], doc_tokens)])
            start, ids = start + self.size, ids[step:]
        n = len(ids) // 4
        if n:
            at = self.level(n)
            window = self.open[at].pop() if at else []
            if at:
                self.count[at] -= 1
            window.append((doc_id, start, ids, doc_tokens))
            if at + n == self.size:
                full.append(window)
            else:
                self.open[at + n].append(window)
                self.count[at + n] += 1
        return full

    def finish(self) -> tuple[list[list[Piece]], list[Piece]]:
        """Fill the open windows up with pieces of the emptiest ones: the full
        windows, and the one that stays open (or an empty list)."""
        windows = [(fill, w) for fill in sorted(self.open, reverse=True) for w in self.open[fill]]
        full, i, j = [], 0, len(windows) - 1
        fills, windows = [f for f, _ in windows], [w for _, w in windows]
        while i < j:
            need = self.size - fills[i]
            doc, start, ids, tokens = windows[j].pop()
            n = min(need, len(ids) // 4)
            windows[i].append((doc, start, ids[: 4 * n], tokens))
            if len(ids) > 4 * n:
                windows[j].append((doc, start + n, ids[4 * n:], tokens))
            fills[i] += n
            if not windows[j]:
                j -= 1
            if fills[i] == self.size:
                full.append(windows[i])
                i += 1
        last = windows[i] if windows and i == j else []
        self.open.clear()
        self.count[:] = 0
        return full, last


def _rows(windows: list[list[Piece]], first_id: int, task: int, keep_ids: bool = False) -> pa.RecordBatch:
    columns: list[list] = [[] for _ in _TYPES]
    for k, window in enumerate(windows):
        offset = 0
        for doc, start, ids, tokens in window:
            n = len(ids) // 4
            for c, v in zip(columns, (doc, start, n, zlib.crc32(ids), tokens, first_id + k, offset,
                                      ids if keep_ids else None, task)):
                c.append(v)
            offset += n
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _TYPES)],
                                      [n for n, _ in _TYPES])


# --- tokens -------------------------------------------------------------------


class Memory(dict):
    """A bounded dict: when it is full, what is used from then on stays."""

    def __init__(self, size: int = MEMORY):
        super().__init__()
        self.size, self.old = size, {}

    def turn(self) -> None:
        """Between two uses: a full dict becomes the old one."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()

    def missing(self, wanted: set) -> list:
        """The keys that are not remembered; the others are in this dict afterwards."""
        new = wanted.difference(self)
        if self.old:
            again = new & self.old.keys()
            self.update(zip(again, map(self.old.__getitem__, again)))
            new -= again
        return list(new)


SEPARATOR = b"\xff" * 4  # no id: the two upper bytes of one are 0


class WordTokens:
    """Ids of texts by the tokenizers library, word by word.

    The tokenizer splits at white space before anything else, so a text's ids
    are its words' ids in order; each distinct word is encoded once.  Words of
    Latin-1 characters are split further, by the tokenizer's own pattern, into
    runs that many words share.  Others, and those that hold an added token's
    string (which gets that token's id), are left to the library whole."""

    def __init__(self, path: str):
        import regex
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        if any(len(t.split()) != 1 for t in added):
            raise ValueError("an added token holds white space")
        self.control = re.compile(b"|".join(map(re.escape, added)) or b"(?!)").finditer
        self.runs = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n").findall
        self.latin_runs = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n").findall
        self.latin = re.compile("[!-~À-ÿ]+").fullmatch
        # lower-case printable ASCII stays as it is under the normaliser and the byte alphabet
        self.bare = tokenizers.Tokenizer(self.library.model)
        self.bare.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a run
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        if len(self.ends) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.words: dict[bytes, bytes] = Memory()
        self.parts: dict[bytes, bytes] = Memory()

    def _run_ids(self, runs: list[bytes], library) -> list[bytes]:
        """Runs are encoded many at a time, with spaces between; each gives
        tokens of which exactly the last ends a run."""
        out: list[bytes] = []
        for at in range(0, len(runs), 1000):
            part = runs[at:at + 1000]
            encoded = library.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
            ids = np.array(encoded[0].ids, "<u4")
            cut = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(cut) != len(part):
                raise ValueError("the tokenizer does not mark the ends of runs")
            packed = ids.tobytes()
            out += [packed[a:b] for a, b in zip([0, *cut], cut)]
        return out

    def _whole_ids(self, words: list[bytes]) -> list[bytes]:
        """Words of any characters, whole."""
        e = self.library.encode([w.decode() for w in words], is_pretokenized=True, add_special_tokens=False)
        packed = np.array(e.ids, "<u4").tobytes()
        cut = (np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(words) + 1)) * 4).tolist()
        return [packed[a:b] for a, b in zip(cut, cut[1:])]

    def _joined_ids(self, words: list[bytes], ascii_only: bool) -> list[bytes]:
        """Words of printable Latin-1: their runs are found in all of them at once."""
        joined = b"\n".join(words)
        if ascii_only:
            runs = self.runs(joined.lower())
        else:
            runs = [r.encode() for r in self.latin_runs(joined.decode().lower())]
        self.parts.turn()
        new = self.parts.missing(set(runs) - {b"\n"})
        self.parts.update(zip(new, self._run_ids(new, self.bare if ascii_only else self.library)))
        self.parts[b"\n"] = SEPARATOR
        return b"".join(map(self.parts.__getitem__, runs)).split(SEPARATOR)

    def learn(self, wanted: set[bytes]) -> None:
        new = self.words.missing(wanted)
        if not new:
            return
        joined = b"\n".join(new)
        characters = np.frombuffer(joined, np.uint8)
        ends = np.append(np.flatnonzero(characters == 10), len(joined))
        odd = np.diff(ends, prepend=-1) > 65  # 64 bytes and the line feed
        strange = np.flatnonzero(((characters < 33) & (characters != 10)) | (characters > 126))
        odd[np.searchsorted(ends, strange)] = True
        odd[np.searchsorted(ends, [m.start() for m in self.control(joined)])] = True
        groups = {"plain": [new[i] for i in np.flatnonzero(~odd).tolist()], "latin": [], "whole": []}
        for w in (new[i] for i in np.flatnonzero(odd).tolist()):
            latin = len(w) <= 64 and self.latin(w.decode()) and not next(self.control(w), None)
            groups["latin" if latin else "whole"].append(w)
        for kind, words in groups.items():
            if words:
                self.words.update(zip(words, self._whole_ids(words) if kind == "whole" else
                                      self._joined_ids(words, kind == "plain")))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 4-byte integers."""
        split = [t.encode().split() for t in texts]
        self.words.turn()
        self.learn(set().union(*split))
        known = self.words.__getitem__
        return [b"".join(map(known, s)) for s in split]


@functools.lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, kept between tasks."""
    return WordTokens(path)


# --- the operator ------------------------------------------------------------


def _pack_partition(tokens: Callable[[list[str]], list[bytes]] | str, end: bytes, size: int,
                    batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    to_ids = word_tokens(tokens).ids if isinstance(tokens, str) else tokens
    task = TaskContext.get().partitionId()
    packer, number = LevelPacker(size), task << 32
    for batch in batches:
        for s in text_slices(batch, SLICE):
            full: list[list[Piece]] = []
            for doc, ids in zip(s.column("doc_id").to_pylist(), to_ids(s.column("text").to_pylist())):
                ids += end
                full += packer.add(doc, 0, ids, len(ids) // 4)
            yield _rows(full, number, task)
            number += len(full)
    full, last = packer.finish()
    yield _rows(full, number, task)
    if last:
        yield _rows([last], number + len(full), task, keep_ids=True)


def _pack_leftovers(size: int, key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by([("task", "ascending"), ("offset", "ascending")])
    packer, full = LevelPacker(size), []
    for r in table.to_pylist():
        full += packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
    more, last = packer.finish()
    windows = full + more + ([last] if last else [])
    first = (1 << 62) + (key[0].as_py() << 32)
    return pa.Table.from_batches([_rows(windows, first, -1)])


def pack(docs: DataFrame, tokens: Callable[[list[str]], list[bytes]] | str, end_id: int = 2,
         size: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokens``: path of a tokenizers file whose pre-tokenizer splits at white
    space, or a function from texts to ids packed as 4-byte integers.  Each
    document's ids end with ``end_id``; a null or empty text is that id alone.
    Repeated rows are packed each for itself, null ids are passed through,
    other columns are ignored, an empty table gives no rows.  ``sequence_id``
    is unique, not dense.
    """
    small_arrow_batches(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    packed = cut_lineage(id_and_text(docs).mapInArrow(functools.partial(_pack_partition, tokens, end, size), PIECES))
    rest = (
        packed.filter("ids IS NOT NULL").groupBy(F.expr(f"task div {MEET_TASKS}").alias("meet"))
        .applyInArrow(lambda key, table: _pack_leftovers(size, key, table), PIECES)
    )
    return packed.filter("ids IS NULL").unionByName(rest).drop("ids", "task")


# --- registered query --------------------------------------------------------


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
