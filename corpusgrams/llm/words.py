"""Words of an Arrow slice of texts as numpy arrays (helper inside tasks).

A word is a run of characters outside ``[\\x20\\x09-\\x0D]``, on UTF-8 bytes.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


class Words:
    """Texts joined with a line feed after each; positions are bytes of the whole."""

    def __init__(self, texts: pa.Array):
        parts = [t.encode() for t in texts.fill_null("").to_pylist()]
        self.n_texts = len(parts)
        self.joined = b"\n".join(parts) + b"\n"
        self.bytes = np.frombuffer(self.joined, np.uint8)
        self.text_end = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)  # after the line feed
        word = ~SPACE[self.bytes]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if len(word) and word[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]  # the last byte is a line feed
        self.text = np.searchsorted(self.text_end, self.start, side="right")  # text of each word
        self.per_text = np.bincount(self.text, minlength=self.n_texts)
        self.first = np.cumsum(self.per_text) - self.per_text  # first word of each text

    @cached_property
    def strings(self) -> list[bytes]:
        return self.joined.split()  # bytes.split(): exactly this white space

    @cached_property
    def ids(self) -> np.ndarray:
        """A number for each distinct word of the slice."""
        values = np.empty(len(self.start), object)
        values[:] = self.strings
        return pd.factorize(values)[0].astype(np.int64)

    def count_bytes(self, mask: np.ndarray) -> np.ndarray:
        """Bytes of each word where ``mask`` (over all bytes) holds."""
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[self.end] - total[self.start]

    def sum_by_text(self, per_word: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, weights=per_word, minlength=self.n_texts)

    @cached_property
    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, number of the distinct content within its text) of every window of 3 words."""
        n = len(self.ids)
        if n < 3:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.text[2:] == self.text[:-2])
        size = int(self.ids.max()) + 1
        pair = pd.factorize(self.ids[at] * size + self.ids[at + 1])[0].astype(np.int64)
        both = pd.factorize(pair * size + self.ids[at + 2])[0].astype(np.int64)
        return at, pd.factorize(both * self.n_texts + self.text[at])[0].astype(np.int64)


def first_of_each(values: np.ndarray) -> np.ndarray:
    """True where a value occurs for the first time."""
    return ~pd.Series(values).duplicated().to_numpy()
