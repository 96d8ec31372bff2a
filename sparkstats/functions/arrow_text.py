"""Tokens of Arrow batches: texts are cut, numbered and counted where they are, without a row per token."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .text import WHITESPACE

#: What lies between word tokens, and between whitespace words.
NO_WORD = r"[^\p{L}\p{N}_]+"
BLANK = WHITESPACE
#: Texts of at most so many bytes are cut and numbered at once: tokens, their numbers and n-grams take some forty times that.
PART_BYTES = 2 << 20


def parts(texts: pa.Array, most: int | None = None):
    """(first row, texts): slices of an Arrow batch of at most `most` bytes, a longer text by itself.

    What a worker holds is bounded by them, however many and long the rows of a batch are.
    """
    most, rows, at = most or PART_BYTES, len(texts), 0
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while at < rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


class Items:
    """The tokens of a batch of texts in order: `code` numbers them into `names`, `row` is their text."""

    def __init__(self, texts: pa.Array, apart: str, min_len: int = 1):
        lists = pc.split_pattern_regex(pc.fill_null(texts, ""), apart)
        flat = lists.flatten()
        kept = pc.greater_equal(pc.utf8_length(flat), max(1, min_len))
        coded = flat.filter(kept).dictionary_encode()
        self.rows = len(texts)
        self.row = pc.list_parent_indices(lists).filter(kept).to_numpy().astype(np.int64)
        self.code = coded.indices.to_numpy().astype(np.int64)
        self.names = coded.dictionary

    def ngrams(self, n: int) -> "Items":
        """Space-joined runs of n neighbouring tokens of a text."""
        out, code, names = object.__new__(Items), self.code, self.names
        for k in range(1, n):
            both = code[:-1] * max(1, len(self.names)) + self.code[k:]
            both = both[self.row[:len(both)] == self.row[k:]] if k == n - 1 else both
            pair, code = np.unique(both, return_inverse=True)
            left, right = pair // max(1, len(self.names)), pair % max(1, len(self.names))
            names = pc.binary_join_element_wise(names.take(pa.array(left)), self.names.take(pa.array(right)), " ")
        out.rows, out.code, out.names = self.rows, code, names
        out.row = self.row if n == 1 else self.row[:max(0, len(self.row) - n + 1)][self.row[:max(0, len(self.row) - n + 1)] == self.row[n - 1:]]
        return out

    def ends(self) -> "Items":
        """The last item of each text."""
        out, last = object.__new__(Items), np.flatnonzero(np.append(self.row[1:] != self.row[:-1], len(self.row) > 0))
        out.rows, out.row, out.code, out.names = self.rows, self.row[last], self.code[last], self.names
        return out

    def by_row(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(row, token, count) of all tokens of each text."""
        width = max(1, len(self.names))
        pair, count = np.unique(self.row * width + self.code, return_counts=True)
        return pair // width, self.names.take(pa.array(pair % width)), count

    def totals(self) -> tuple[pa.Array, np.ndarray]:
        """(token, count) over the batch."""
        count = np.bincount(self.code, minlength=len(self.names))
        there = np.flatnonzero(count)
        return self.names.take(pa.array(there)), count[there]
