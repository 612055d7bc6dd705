"""Substring dedup: repeated word windows, found behind a count-min filter.

1. Every task adds its windows to a sparse partial count-min sketch (two rows of cells, counts
   saturating at two). The partial sketches are merged by block of cells. A merged count is at
   least the true one, so a cell of one proves a window unique.
2. A second pass hands on only windows with two or more in every cell, as 96-bit hashes of their
   words, and these alone are grouped exactly. Windows that collide in the sketch merely travel
   in vain; none is lost. They travel in bundles, one for each range of hashes and ``FLUSH_ROWS``
   windows of a task, in which a window stands for its smallest document only. Its other places are
   known to go: they are dealt by document, not by window. A range merges what it holds whenever that
   has doubled, so it holds its distinct windows and not their copies.
3. Positions return to their documents, which lose the covered words.

Windows are told apart by these 96 bits, never by their words.

Only one bit a cell ("two or more") is broadcast: ``depth * 2**log2_cells / 8`` bytes at most,
64 MB by default, chosen from the size of the texts below that. On a corpus for which the bound is
too small the filter lets more windows through and the exact grouping carries the load; the result
stays the same.

Defined cases: a null text has no words. A document of null id keeps all its words and takes words
from no one. Rows of equal id are one document for "smaller", judged and rebuilt row by row by text. A text
of over ``PIECE_BYTES`` is read in parts, which overlap so that each window lies whole in just one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakelayers.llm.shipping import ship
from lakelayers.llm.words import Words, find_words, is_long, long_parts, mixed, pieces, window_hashes, window_starts, with_text, word_hashes

WINDOW = 13
DEPTH = 2
BLOCK_BITS = 18
MAX_LOG2_CELLS = 28
RANGE_WINDOWS = 4_000_000
FLUSH_ROWS = 400_000
HELD_ROWS = 1_000_000

_HASHES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_PARTIAL = "row int, block int, cells binary"


def pack(values: np.ndarray) -> bytes:
    """Numbers compressed by byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(packed: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cell numbers of a block, each once or twice, as compressed differences."""
    return pack(np.diff(cells.astype(np.uint32), prepend=np.uint32(0)))


def unpack_cells(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint32), dtype=np.int64)


def at_most_twice(ordered: np.ndarray) -> np.ndarray:
    keep = np.ones(len(ordered), bool)
    keep[2:] = ordered[2:] != ordered[:-2]
    return ordered[keep]


def cell_numbers(first: np.ndarray, row: int, log2_cells: int) -> np.ndarray:
    return mixed(first + np.uint64(row) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - log2_cells)


def parts_of(piece: pa.RecordBatch, width: int, limit: int | None = None) -> Iterator[tuple[int, Words]]:
    """The words of a piece and the number of the first one; of a single long text the words of its parts, in
    which every window of ``width`` words lies once."""
    if limit is None and not is_long(piece):
        yield 0, find_words(piece.column("text"))
        return
    before = 0
    for _, part in long_parts(piece.column("text"), width - 1, *([limit] if limit else [])):
        words = find_words(part)
        yield before, words
        before += len(words.starts) - width + 1


def partial_sketches(width: int, log2_cells: int, depth: int):
    block_bits = min(BLOCK_BITS, log2_cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for piece in pieces(batch):
                for _, words in parts_of(piece, width):
                    found.append(window_hashes(word_hashes(words), window_starts(words, width), width, _HASHES[0]))
            hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
            rows, blocks, cells = [], [], []
            for row in range(depth):
                numbers = at_most_twice(np.sort(cell_numbers(hashes, row, log2_cells)))
                owner = numbers >> np.uint64(block_bits)
                for block in np.unique(owner):
                    low, high = np.searchsorted(owner, block), np.searchsorted(owner, block, "right")
                    rows.append(row)
                    blocks.append(int(block))
                    cells.append(pack_cells(numbers[low:high] & np.uint64((1 << block_bits) - 1)))
            columns = [pa.array(rows, pa.int32()), pa.array(blocks, pa.int32()), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "block", "cells"])

    return run


def merge_cells(log2_cells: int):
    """Merges partial sketches, sorted by block, one block at a time, into one bit a cell."""
    size = 1 << min(BLOCK_BITS, log2_cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, counts = None, np.zeros(0, np.uint8)

        def close():
            bits = np.packbits(counts >= 2, bitorder="little").tobytes()
            return pd.DataFrame({"row": [key[0]], "block": [key[1]], "cells": [bits]})

        for batch in batches:
            for row, block, packed in zip(batch["row"], batch["block"], batch["cells"], strict=True):
                if key != (row, block):
                    if key is not None:
                        yield close()
                    key, counts = (row, block), np.zeros(size, np.uint8)
                cells = unpack_cells(packed)
                again = np.flatnonzero(cells[1:] == cells[:-1])
                counts[cells] = np.minimum(counts[cells] + 1, 2)
                counts[cells[again]] = 2
        if key is not None:
            yield close()

    return run


def repeated_bits(docs: DataFrame, width: int, log2_cells: int, depth: int) -> list[np.ndarray]:
    """For each row of the merged sketch the bits of the cells that count two or more."""
    parts = docs.select("text").mapInArrow(partial_sketches(width, log2_cells, depth), _PARTIAL)
    dealt = parts.repartition("row", "block").sortWithinPartitions("row", "block")
    done = dealt.mapInPandas(merge_cells(log2_cells), _PARTIAL)
    bits = [np.zeros(max(1, (1 << log2_cells) // 8), np.uint8) for _ in range(depth)]
    size = max(1, (1 << min(BLOCK_BITS, log2_cells)) // 8)
    for line in done.toLocalIterator():  # bounded: the sketch's own size
        bits[line["row"]][line["block"] * size : (line["block"] + 1) * size] = np.frombuffer(line["cells"], np.uint8)
    return bits


def estimated_repeated(hashes: np.ndarray, bits: list[np.ndarray], log2_cells: int) -> np.ndarray:
    """Whether every cell of a window counts two or more."""
    good = np.ones(len(hashes), bool)
    for row, plane in enumerate(bits):
        cell = cell_numbers(hashes, row, log2_cells)
        good &= (plane[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return good


_PART = np.dtype([("h1", np.uint64), ("h2", np.uint32), ("doc", np.int64), ("key", np.int64), ("at", np.int32)])
_BUNDLE = "range int, h1 binary, h2 binary, doc binary, at binary, docs binary, keys binary, local boolean"


def without_larger(every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the smallest document that has them, and those of the others."""
    every = every[np.lexsort((every["doc"], every["h2"], every["h1"]))]
    new = np.ones(len(every), bool)
    new[1:] = (every["h1"][1:] != every["h1"][:-1]) | (every["h2"][1:] != every["h2"][:-1])
    goes = every["doc"] > every["doc"][np.flatnonzero(new)][np.cumsum(new) - 1]
    return every[~goes], every[goes]


def distinct_places(every: np.ndarray) -> np.ndarray:
    """In order of document, text and place."""
    every = every[np.lexsort((every["at"], every["key"], every["doc"]))]
    new = np.ones(len(every), bool)
    new[1:] = (every["doc"][1:] != every["doc"][:-1]) | (every["key"][1:] != every["key"][:-1]) | (every["at"][1:] != every["at"][:-1])
    return every[new]


def bundles(every: np.ndarray, local: bool, ranges: int) -> pa.RecordBatch:
    """One row for each range of first hashes, or of documents if the places are ``local``; a window
    names its text by number."""
    if local:  # copies of a row have the same places
        every = distinct_places(every)
    dealt_by = mixed(every["doc"].view(np.uint64) ^ mixed(every["key"].view(np.uint64))) if local else every["h1"]
    owner = (dealt_by >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    order = np.argsort(owner, kind="stable")
    every, owner = every[order], owner[order]
    numbers, begin = np.unique(owner, return_index=True)
    columns: list[list] = [[] for _ in range(8)]
    for number, low, high in zip(numbers, begin, np.append(begin, len(every))[1:], strict=True):
        part = every[low:high]
        texts, name = np.unique(np.rec.fromarrays([part["doc"], part["key"]], names="doc,key"), return_inverse=True)
        names = (None, None) if local else (pack(part["h1"]), pack(part["h2"]))
        row = [int(number), *names, pack(name.astype(np.uint32)), pack(part["at"]), pack(texts["doc"]), pack(texts["key"]), local]
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    kinds = [pa.int32(), *[pa.binary()] * 6, pa.bool_()]
    names = [x.split()[0] for x in _BUNDLE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def unbundle(row: dict) -> np.ndarray:
    name = unpack(row["doc"], np.uint32)
    part = np.empty(len(name), _PART)
    if not row["local"]:
        part["h1"], part["h2"] = unpack(row["h1"], np.uint64), unpack(row["h2"], np.uint32)
    part["at"] = unpack(row["at"], np.int32)
    part["doc"], part["key"] = unpack(row["docs"], np.int64)[name], unpack(row["keys"], np.int64)[name]
    return part


def candidate_windows(width: int, log2_cells: int, ranges: int, shared):
    """Windows that may be repeated, in bundles. Of those that some smaller document of the same
    windows has, it is already known that they go (``local``)."""

    def close(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        stays, goes = without_larger(np.concatenate(parts))
        yield bundles(stays, False, ranges)
        yield bundles(goes, True, ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, parts, held = shared.value, [], 0
        for batch in batches:
            for piece in pieces(batch):
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
                keys = piece.column("text_key").to_numpy(zero_copy_only=False)
                for before, words in parts_of(piece, width):
                    starts = window_starts(words, width)
                    hashes = word_hashes(words)
                    first = window_hashes(hashes, starts, width, _HASHES[0])
                    maybe = estimated_repeated(first, bits, log2_cells)
                    starts = starts[maybe]
                    row = np.searchsorted(words.first, starts, "right") - 1
                    part = np.empty(len(starts), _PART)
                    part["h1"] = first[maybe]
                    part["h2"] = window_hashes(hashes, starts, width, _HASHES[1]) >> np.uint64(32)
                    part["doc"], part["key"], part["at"] = ids[row], keys[row], before + starts - words.first[row]
                    parts.append(part)
                    held += len(part)
                    if held >= FLUSH_ROWS:
                        yield from close(parts)
                        parts, held = [], 0
        if held:
            yield from close(parts)

    return run


_PLACES = "doc_id long, text_key long, places binary"


class RangeMerge:
    """Takes bundles sorted by range. ``merge`` parts the rows of a range into those held on and those
    handed out; it is called whenever the rows held have doubled, and at the end of the range."""

    def __init__(self, merge) -> None:
        self.merge, self.at, self.held, self.rows, self.limit = merge, None, [], 0, HELD_ROWS

    def add(self, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["range"] != self.at:
                yield from self.close()
                self.at = row["range"]
            self.held.append(unbundle(row))
            self.rows += len(self.held[-1])
            if self.rows >= self.limit:
                stays, out = self.merge(np.concatenate(self.held), False)
                yield out
                self.held, self.rows, self.limit = [stays], len(stays), max(HELD_ROWS, 2 * len(stays))

    def close(self) -> Iterator[np.ndarray]:
        if self.held:
            yield self.merge(np.concatenate(self.held), True)[1]
        self.held, self.rows, self.limit = [], 0, HELD_ROWS


def repeated_places(ranges: int):
    """From bundles sorted by range, bundles of the places that go, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        standing = RangeMerge(lambda every, done: without_larger(every))
        for batch in batches:
            known = batch.column("local")
            yield batch.filter(known)
            yield from (bundles(goes, True, ranges) for goes in standing.add(batch.filter(pc.invert(known))))
        yield from (bundles(goes, True, ranges) for goes in standing.close())

    return run


def places_of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document of which words go, from bundles sorted by their range of documents."""

    def merge(every: np.ndarray, done: bool) -> tuple[np.ndarray, np.ndarray]:
        every = distinct_places(every)
        return (every[:0], every) if done else (every, every[:0])

    def placed(gone: np.ndarray) -> pa.RecordBatch:
        new = np.ones(len(gone), bool)
        new[1:] = (gone["doc"][1:] != gone["doc"][:-1]) | (gone["key"][1:] != gone["key"][:-1])
        begin = np.flatnonzero(new)
        places = np.ascontiguousarray(gone["at"]).view(np.uint8)
        bounds = (np.append(begin, len(gone)) * 4).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(places)])
        columns = [pa.array(np.ascontiguousarray(gone[c][begin])) for c in ("doc", "key")]
        return pa.RecordBatch.from_arrays([*columns, binary], ["doc_id", "text_key", "places"])

    ranges = RangeMerge(merge)
    for batch in batches:
        yield from (placed(gone) for gone in ranges.add(batch))
    yield from (placed(gone) for gone in ranges.close())


def kept_of(piece: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of words and of removed words, and what is left of each text."""
    words = find_words(piece.column("text"))
    goes = np.zeros(len(words.starts) + 1, np.int64)
    for row, places in enumerate(piece.column("places").to_pylist()):
        if places:
            at = np.frombuffer(places, np.int32) + words.first[row]
            goes[at] += 1
            goes[at + width] -= 1
    stays = np.cumsum(goes[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(stays)])[words.first]
    return words.counts, words.counts - np.diff(kept), spaced(words, stays, kept)


def kept_of_long(piece: pa.RecordBatch, width: int, limit: int | None = None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The same of a single long text, in parts of ``limit`` bytes."""
    places = np.sort(np.frombuffer(piece.column("places")[0].as_py() or b"", np.int32)).astype(np.int64)
    before, removed, texts = 0, 0, []
    for _, part in long_parts(piece.column("text"), 0, *([limit] if limit else [])):
        words = find_words(part)
        n = len(words.starts)
        near = places[np.searchsorted(places, before - width + 1) : np.searchsorted(places, before + n)] - before
        goes = np.bincount(np.maximum(near, 0), minlength=n + 1) - np.bincount(np.minimum(near + width, n), minlength=n + 1)
        stays = np.cumsum(goes[:n]) == 0
        kept = int(stays.sum())
        if kept:
            texts += spaced(words, stays, np.array([0, kept]))
        before, removed = before + n, removed + n - kept
    return np.array([before]), np.array([removed]), [b" ".join(texts)]


def kept_words(width: int, field: str | None):
    """Texts without the words that their windows at ``places`` cover. ``field``: where in the
    column row the text stands, if rows are carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(with_text(batch, field)):
                if is_long(piece):
                    counts, removed, texts = kept_of_long(piece, width)
                else:
                    counts, removed, texts = kept_of(piece, width)
                columns = [
                    piece.column("doc_id"),
                    pa.array(counts.astype(np.int64)),
                    pa.array(removed.astype(np.int64)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if field is not None:
                    columns += [pa.array([x.decode() if n else None for x, n in zip(texts, removed, strict=True)], pa.string()), piece.column("row")]
                    names += ["new_text", "row"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def spaced(words: Words, stays: np.ndarray, kept: np.ndarray) -> list[bytes]:
    """The words of each text that stay, one space between them. ``kept``: bounds of the texts
    among the words that stay."""
    lengths = (words.ends - words.starts)[stays] + 1
    total = np.cumsum(lengths)
    place = np.arange(int(lengths.sum())) - np.repeat(total - lengths, lengths)
    source = np.minimum(place + np.repeat(words.starts[stays], lengths), max(0, len(words.data) - 1))
    data = words.data[source] if len(source) else np.zeros(0, np.uint8)
    data[total - 1] = 32
    raw, bounds = data.tobytes(), np.concatenate([[0], total])[kept]
    return [raw[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def text_bytes_of(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def log2_cells_for(size: int, most: int = MAX_LOG2_CELLS) -> int:
    """Cells for about three times the windows of texts of ``size`` bytes, between 2**16 and
    ``2**most``."""
    return min(most, max(16, int(size // 2).bit_length()))


def dedup_substrings(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WINDOW,
    depth: int = DEPTH,
    max_log2_cells: int = MAX_LOG2_CELLS,
    with_rows: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256; ``with_rows`` adds
    new_text (null where nothing is removed) and row, a struct of all input columns.

    A word is removed if a window of ``width`` words covers it whose words also start in a
    document of smaller id.
    """
    ship(df.sparkSession)
    row = [F.struct(*[df[c] for c in df.columns]).alias("row")] if with_rows else []
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *row)
    size = text_bytes_of(docs)
    log2_cells = log2_cells_for(size, max_log2_cells)
    ranges = 12 + size // (6 * RANGE_WINDOWS)
    shared = df.sparkSession.sparkContext.broadcast(repeated_bits(docs, width, log2_cells, depth))
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    named = keyed.select("doc_id", "text_key", "text").filter("doc_id is not null")
    found = named.mapInArrow(candidate_windows(width, log2_cells, ranges, shared), _BUNDLE)
    dealt = found.repartitionById(ranges, "range").sortWithinPartitions("range")
    goes = dealt.mapInArrow(repeated_places(ranges), _BUNDLE)
    places = goes.repartitionById(ranges, "range").sortWithinPartitions("range").mapInArrow(places_of_documents, _PLACES)
    # A text is shuffled once: as a column or within its row.
    carried = keyed.select("doc_id", "text_key", "row" if with_rows else "text")
    joined = carried.join(places, ["doc_id", "text_key"], "left").select(*carried.columns, "places")
    result = StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_sha256 string")
    if with_rows:
        result = result.add("new_text", "string").add("row", docs.schema["row"].dataType)
    return joined.mapInArrow(kept_words(width, text_col if with_rows else None), result)


def without_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """Documents without their repeated words, in the columns of ``docs``.

    A document that loses nothing keeps its text as it is, one that loses all its words goes.
    ``n_chars``, if there, follows the text.
    """
    cut = dedup_substrings(docs, width=width, with_rows=True).filter("n_removed = 0 or n_removed < n_words")
    text = F.coalesce("new_text", "row.text")
    columns = {"text": text, "n_chars": F.when(F.col("new_text").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("long"))} if "n_chars" in docs.columns else {"text": text}
    return cut.select(*[columns.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
