"""SimHash near-dedup over anchor points of a covering code.

A fingerprint has 64 bits, split into three blocks of 21, 21 and 22. Fingerprints at distance 4 or
less differ in at most one bit of some block. The anchors of a block are the words of a code: the
Hamming code on 15 of its bits, all values on the other 6 or 7. Its covering radius is 1, so each
fingerprint has a home anchor within 1 and is copied to every anchor within 1 + 1. If two
fingerprints differ by one bit in the block, the home anchor of either also holds the other.
Copies: about 14 a block, each with one of 2**17 (2**18) anchors. ``WIDE_BLOCKS``, two blocks of 32
bits that may differ in two, are for more than some 10**9 distinct fingerprints: about 300 copies a
block, but 2**28 anchors. The result is the same.

Distinct fingerprints alone are compared, at each anchor the ones at home with all. An anchor hands
on a star for each of its local components, never its pairs. An anchor of more than ``CHUNK``
fingerprints is cut into chunks and compared chunk pair by chunk pair, in tasks of their own.

Defined cases: null and empty texts and texts without words have the fingerprint zero and are linked
like any other. A text of fewer words than a shingle is one shingle. A text of over ``PIECE_BYTES`` is
read in parts. A null id never is a component
id; a component of null ids only has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import xor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.components import component_roots
from lakelayers.llm.shipping import ship
from lakelayers.llm.words import PIECE_BYTES, Words, find_words, is_long, long_parts, pieces
from lakelayers.scratch import stage

SHINGLE = 4
SEED = 42
DISTANCE = 4
BLOCKS = ((0, 21), (21, 21), (42, 22))
WIDE_BLOCKS = ((0, 32), (32, 32))
CODE_BITS = 15
CHUNK = 16_384
ANCHORED_ROWS = 2_000
SMALL_GROUP = 256


def shingle_hashes(text_words: tuple[bytes, np.ndarray, np.ndarray], first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the shingles of all texts, and how many each text has."""
    raw, starts, ends = text_words
    counts = np.diff(first)
    shingles = np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))
    offsets = np.cumsum(shingles) - shingles
    head = np.arange(int(shingles.sum())) - np.repeat(offsets - first[:-1], shingles)
    tail = np.minimum(head + width, np.repeat(first[1:], shingles)) - 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[head].tolist(), ends[tail].tolist(), strict=True)
    return np.fromiter((digest(raw[a:b], SEED) for a, b in pairs), np.uint64, len(head)), shingles


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text the bits set in over half of its hashes."""
    out = np.zeros(len(counts), np.uint64)
    some = counts > 0
    if len(hashes):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        offsets = (np.cumsum(counts) - counts)[some]
        sums = np.add.reduceat(bits, offsets, axis=0, dtype=np.int32)
        majority = (2 * sums > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _word_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts, the words of a shingle joined by one space."""
    lengths = words.ends - words.starts
    stop = np.cumsum(lengths + 1)
    place = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - lengths - 1, lengths + 1)
    source = np.minimum(place + np.repeat(words.starts, lengths + 1), max(0, len(words.data) - 1))
    spaced = words.data[source] if len(source) else np.zeros(0, np.uint8)
    if len(stop):
        spaced[stop - 1] = 32
    return shingle_hashes((spaced.tobytes(), stop - lengths - 1, stop - 1), words.first, SHINGLE)


def long_fingerprint(column: pa.Array, limit: int = PIECE_BYTES) -> np.ndarray:
    """The fingerprint of a single text, read in parts that share no shingle."""
    sums, total = np.zeros(64, np.int64), 0
    for _, part in long_parts(column, SHINGLE - 1, limit):
        words = find_words(part, lower=True)
        if words.counts[0] >= SHINGLE:
            hashes, _ = _word_shingles(words)
            sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
    if not total:  # a few long words
        return majority_bits(*_word_shingles(find_words(column, lower=True)))
    return np.packbits((2 * sums > total).astype(np.uint8), bitorder="little").view(np.uint64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            text = piece.column("text")
            fp = long_fingerprint(text) if is_long(piece) else majority_bits(*_word_shingles(find_words(text, lower=True)))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_key"), pa.array(fp.view(np.int64))], ["doc_id", "text_key", "fp"])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a 64-bit hash of the text), fp for every row."""
    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long")


def _syndromes() -> np.ndarray:
    values = np.arange(1 << CODE_BITS)
    out = np.zeros_like(values)
    for bit in range(CODE_BITS):
        out ^= np.where(values >> bit & 1, bit + 1, 0)
    return out


def _flips(syndrome: int, rest: int, reach: int) -> list[int]:
    """What to flip in a block to reach each anchor within ``reach``; the first gives the home
    anchor. Flips in the code part must make up its syndrome."""

    def sets(first: int, count: int, most: int):
        for size in range(most + 1):
            yield from combinations(range(first, first + count), size)

    in_code = [c for c in sets(1, CODE_BITS, reach) if reduce(xor, c, 0) == syndrome]
    found = [(c, r) for c in in_code for r in sets(CODE_BITS + 1, rest, reach - len(c))]
    return [sum(1 << bit - 1 for bit in (*c, *r)) for c, r in sorted(found, key=lambda x: len(x[0]) + len(x[1]))]


def anchors_of(fp: np.ndarray, blocks: tuple[tuple[int, int], ...] = BLOCKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For uint64 fingerprints: anchor, number of the fingerprint, and whether it is at home."""
    syndromes, reach = _syndromes(), 1 + DISTANCE // len(blocks)
    keys, owners, homes = [], [], []
    for number, (shift, size) in enumerate(blocks):
        block = (fp >> np.uint64(shift)).astype(np.int64) & ((1 << size) - 1)
        syndrome = syndromes[block & ((1 << CODE_BITS) - 1)]
        for s in np.unique(syndrome):
            rows = np.flatnonzero(syndrome == s)
            flips = np.array(_flips(int(s), size - CODE_BITS, reach), np.int64)
            keys.append((block[rows][:, None] ^ flips | number << 32).ravel())
            owners.append(np.repeat(rows, len(flips)))
            homes.append(np.tile(np.arange(len(flips)) == 0, len(rows)))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(homes)


def _to_anchors(blocks: tuple[tuple[int, int], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ANCHORED_ROWS):
                fp = batch.column("fp").slice(at, ANCHORED_ROWS).to_numpy()
                anchor, owner, home = anchors_of(fp.view(np.uint64), blocks)
                columns = [pa.array(anchor), pa.array(fp[owner]), pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "fp", "home"])

    return run


def local_roots(fp: np.ndarray, home: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For rows sorted by group, the first row of each local component; links run from the rows at
    home to the rows of their group."""
    root = np.arange(len(fp))
    new = np.ones(len(fp), bool)
    new[1:] = group[1:] != group[:-1]
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(fp)))
    small = np.repeat(size <= SMALL_GROUP, size)
    at_home = np.flatnonzero(home & small)
    starts, sizes = np.repeat(begin, size)[at_home], np.repeat(size, size)[at_home]
    left = np.repeat(at_home, sizes)
    right = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes)
    near = np.bitwise_count(fp[left] ^ fp[right]) <= DISTANCE
    left, right = left[near], right[near]
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        root = root[root]
        if (root == before).all():
            break
    for start, count in zip(begin[size > SMALL_GROUP], size[size > SMALL_GROUP], strict=True):
        own = slice(start, start + count)
        label, values = np.arange(count), fp[own]
        for i in np.flatnonzero(home[own]):
            met = np.unique(label[np.bitwise_count(values ^ values[i]) <= DISTANCE])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
        root[own] = label + start
    return root


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by task; a task may span batches."""
    held: list[pa.RecordBatch] = []

    def close(part: pa.Table) -> pa.RecordBatch:
        fp = part.column("fp").to_numpy()
        group = np.rec.fromarrays([part.column(c).to_numpy() for c in ("anchor", "i", "j")])
        root = local_roots(fp.view(np.uint64), part.column("home").to_numpy(), group)
        moved = np.flatnonzero(root != np.arange(len(root)))
        pairs = np.unique(np.stack([fp[moved], fp[root[moved]]]), axis=1) if len(moved) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        last = np.ones(batch.num_rows, bool)
        for c in ("anchor", "i", "j"):
            values = batch.column(c).to_numpy()
            last &= values == values[-1]
        cut = int(np.argmax(last))  # the last task may go on in the next batch
        same = held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in ("anchor", "i", "j"))
        if cut or not same:
            if held and not same:
                yield close(pa.Table.from_batches(held))
                held = []
            if cut:
                yield close(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
        held.append(batch.slice(cut))
    if held:
        yield close(pa.Table.from_batches(held))


def links(fps: DataFrame, chunk: int = CHUNK, blocks: tuple[tuple[int, int], ...] = BLOCKS) -> DataFrame:
    """a, b: links that connect all distinct fingerprints at distance 4 or less, with no claim to
    hold every pair."""
    ship(fps.sparkSession)
    rows = fps.select("fp").mapInArrow(_to_anchors(blocks), "anchor long, fp long, home boolean")
    hot = stage(rows.groupBy("anchor").count().filter(F.col("count") > chunk), "hot-anchors")
    if hot.isEmpty():
        tasks = rows.selectExpr("*", "0 i", "0 j")
    else:
        parts = hot.select("anchor", F.ceil(F.col("count") / chunk).cast("int").alias("n"))
        dealt = rows.join(parts, "anchor", "left").selectExpr("anchor", "fp", "home", "coalesce(n, 1) n", "cast(pmod(xxhash64(fp), coalesce(n, 1)) as int) own")
        tasks = dealt.selectExpr("anchor", "fp", "home", "own", "explode(sequence(0, n - 1)) other").selectExpr(
            "anchor", "fp", "home", "least(own, other) i", "greatest(own, other) j"
        )
    dealt = tasks.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    return dealt.mapInArrow(_links, "a long, b long")


def _components(docs: DataFrame, chunk: int, blocks: tuple[tuple[int, int], ...]) -> DataFrame:
    """fp, root, and ``least``: the smallest id of the fingerprint, with the least text key it has; ids
    that are null are no ids."""
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))
    fps = stage(docs.groupBy("fp").agg(F.min(named).alias("least")), "distinct-fingerprints")
    roots = stage(component_roots(links(fps, chunk, blocks)), "roots")
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    blocks: tuple[tuple[int, int], ...] = BLOCKS,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row: the smallest id that links
    of at most 4 differing bits reach."""
    docs = stage(fingerprints(df, id_col, text_col), "fingerprints")
    owned = _components(docs, chunk, blocks)
    least = owned.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    classes = owned.select("fp", "root").join(least, "root").select(F.col("fp").alias("own_fp"), "component_id")
    joined = docs.join(classes, docs["fp"] == classes["own_fp"])
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, chunk: int = CHUNK, blocks: tuple[tuple[int, int], ...] = BLOCKS) -> DataFrame:
    """One row of each component, in the columns of ``docs``, whatever the order of the rows.

    It is the row of the smallest id. Where rows of that id differ, the fingerprint, a hash of the text
    and one of the row decide in turn; a row of equal id in another component stays for that one.
    Documents without an id stay.
    """
    owned = _components(stage(fingerprints(docs), "fingerprints"), chunk, blocks)
    first = F.min(F.when(F.col("least").isNotNull(), F.struct("least.doc_id", "fp", "least.text_key"))).alias("first")
    kept = owned.groupBy("root").agg(first).filter("first is not null")
    kept = kept.selectExpr("first.doc_id _kept_id", "first.text_key _kept_key").distinct()
    same = (docs["doc_id"] == kept["_kept_id"]) & (F.xxhash64(docs["text"]) == kept["_kept_key"])
    rows = docs.join(kept, same).select(*[docs[c] for c in docs.columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = rows.groupBy("doc_id", "text").agg(F.min_by(whole, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
    return named.select("_row.*").unionByName(docs.filter("doc_id is null"))
