"""Sparse document-term rows of an Arrow text column, with the words of a slice numbered.

The words of a slice are encoded by Arrow's exact dictionary encoding, so no
two words share a number; a document's row holds its distinct words and how
often each occurs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .words import LOWER, word_spans


class Rows(NamedTuple):
    """CSR: row i has ``indices[indptr[i]:indptr[i + 1]]`` and as many ``counts``; ``words`` names the columns."""

    indptr: np.ndarray
    indices: np.ndarray
    counts: np.ndarray
    words: pa.BinaryArray


def sparse_rows(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = False) -> Rows:
    """The rows of the texts ``data[offsets[i]:offsets[i + 1]]``; words are what lies between ``separators`` (a flag for each byte)."""
    if lower:
        data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, separators)
    n = len(starts)
    places = np.zeros(n + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    letters = np.ascontiguousarray(data[~separators[data]])
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(places), pa.py_buffer(letters)]).dictionary_encode()
    width = max(len(words.dictionary), 1)
    key = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64) * width, np.diff(first))
    key += words.indices.to_numpy(zero_copy_only=False)
    key.sort()
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if n else np.zeros(0, np.int64)
    counts = np.diff(np.r_[new, n]).astype(np.int64)
    row, indices = np.divmod(key[new], width)
    indptr = np.searchsorted(row, np.arange(len(offsets)))
    return Rows(indptr, indices, counts, words.dictionary.cast(pa.binary()))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of each pair, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


def one_list(values: pa.Array) -> pa.ListArray:
    """A column of one row that holds all ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
