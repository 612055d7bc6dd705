"""Words of whole texts as numpy arrays: bounds, 64-bit hashes and hashes of word windows.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Texts are handled in pieces of half a megabyte; one longer text is a piece of
its own, which :func:`long_parts` cuts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 512 << 10
LONG_WORD = 1 << 16
SHORT_WORD = 32

_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[9, 10, 11, 12, 13, 32]] = False
_BYTE_KEYS = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """``data`` holds the bytes of all texts, ``first`` the number of the first word of each text
    and, at the end, the number of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text, or one row."""
    sizes = np.cumsum(np.diff(text_bytes(batch.column(column))[1]))
    at, rows = 0, batch.num_rows
    while at < rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def is_long(piece: pa.RecordBatch, column: str = "text") -> bool:
    """Whether a piece is one text of over ``PIECE_BYTES``."""
    return piece.num_rows == 1 and len(text_bytes(piece.column(column))[0]) > PIECE_BYTES


def long_parts(column: pa.Array, overlap: int, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Parts of about ``limit`` bytes of a single text, and the byte each begins at.

    No word is cut. Each part begins ``overlap`` words before the end of the one before, so that every
    window of ``overlap`` + 1 words lies whole in one part and in no other.
    """
    data, _ = text_bytes(column)
    at, size = 0, limit
    while True:
        to = min(at + size, len(data))
        while to < len(data) and _WORD_BYTE[data[to]]:
            out = np.flatnonzero(~_WORD_BYTE[data[to : to + limit]])
            to = to + int(out[0]) if len(out) else min(to + limit, len(data))
        part = data[at:to]
        inside = _WORD_BYTE[part]
        starts = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
        if to < len(data) and len(starts) <= overlap:
            size *= 2
            continue
        bounds = np.array([0, len(part)], np.int64)
        yield at, pa.LargeStringArray.from_buffers(1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(part)))
        if to == len(data):
            return
        at, size = (at + int(starts[-overlap]) if overlap else to), limit


def with_text(batch: pa.RecordBatch, field: str | None) -> pa.RecordBatch:
    """The batch with a column text, taken from a field of the struct column row if one is given."""
    if field is None:
        return batch
    return batch.append_column("text", pc.struct_field(batch.column("row"), field))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their bounds. A null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def find_words(column: pa.Array, lower: bool = False) -> Words:
    """The words of a column of texts; ``lower`` maps A-Z to a-z and nothing else."""
    data, bounds = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD_BYTE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, bounds))


@lru_cache(2)
def _powers(length: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(length - 1, _STEP)]))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    lengths = words.ends - words.starts
    if lengths.max() > LONG_WORD:
        return _hashes_with_long(words, lengths)
    # Byte by byte over the words that are long enough, longest first; the rest of them all at once.
    order = np.argsort(-np.minimum(lengths, SHORT_WORD + 1).astype(np.int8), kind="stable")
    at, sums = words.starts[order], np.zeros(len(lengths), np.uint64)
    left = len(lengths) - np.cumsum(np.bincount(np.minimum(lengths, SHORT_WORD + 1), minlength=SHORT_WORD + 2))
    for place in range(min(int(lengths.max()), SHORT_WORD)):
        n = left[place]
        sums[:n] += _BYTE_KEYS[words.data[at[:n] + place]] * _powers(64)[place]
    hashes = np.empty_like(sums)
    hashes[order] = sums
    long = np.flatnonzero(lengths > SHORT_WORD)
    if len(long):
        hashes[long] = _sums(words.data, words.starts[long], lengths[long])
    return mixed(hashes + lengths.astype(np.uint64))


def _sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same sums with an entry for each byte."""
    offsets = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(offsets, lengths)
    longest = 1 << int(max(64, lengths.max()) - 1).bit_length()
    terms = _BYTE_KEYS[data[place + np.repeat(starts, lengths)]] * _powers(longest)[place]
    return np.add.reduceat(terms, offsets)


def _hashes_with_long(words: Words, lengths: np.ndarray) -> np.ndarray:
    """The same hashes where some words are very long: these are summed block by block."""
    short = lengths <= LONG_WORD
    hashes = np.zeros(len(lengths), np.uint64)
    hashes[short] = word_hashes(Words(words.data, words.starts[short], words.ends[short], np.array([0, int(short.sum())])))
    for word in np.flatnonzero(~short):
        total = _long_sum(words.data[words.starts[word] : words.ends[word]])
        hashes[word] = mixed(np.array([total + np.uint64(lengths[word])]))[0]
    return hashes


def _long_sum(data: np.ndarray) -> np.uint64:
    """The same sum for one word, block by block."""
    total, lead = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for at in range(0, len(data), LONG_WORD):
        block = _BYTE_KEYS[data[at : at + LONG_WORD]] * _powers(LONG_WORD)[: len(data) - at]
        total += block.sum(keepdims=True, dtype=np.uint64) * lead
        lead *= _powers(LONG_WORD)[-1:] * _STEP
    return total[0]


def window_starts(words: Words, width: int) -> np.ndarray:
    """The numbers of the words at which a window of ``width`` words of one text starts."""
    room = words.counts - width + 1
    last = np.repeat(words.first[1:] - width, words.counts)
    at = np.arange(len(words.starts))
    return at[at <= last] if (room > 0).any() else at[:0]


def window_hashes(hashes: np.ndarray, starts: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A 64-bit hash of the window at each start, from the hashes of its words."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    room = len(hashes) - width + 1
    total = np.zeros(room, np.uint64)
    for i in range(width):
        total *= np.uint64(factor | 1)
        total += hashes[i : room + i]
    return mixed(total[starts])
