"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND.

Index: items are cut into segments of at most ``SEGMENT`` words; each segment is an entry. The impact
of a term on an entry is its BM25 weight as a share of the entry's whole weight, so that one threshold
serves entries of all lengths. Entries stand in blocks of ``BLOCK``; every term has its
largest impact for each block.

Queries: every text is cut into passages of 2 * ``SEGMENT`` words that overlap by half, so that some
passage holds any copied segment whole. For each passage, blocks whose bound (the sum of the block
maxima of its terms) stays below ``THRESHOLD`` are passed over, and so are blocks that fall below it
when the terms frequent among entries count as in each entry. In the others block-max WAND finds all
entries that reach it. Bounds are computed for all passages of a piece at once.

Verification: an item is a question, the first two thirds of its words, and an answer, the rest. A
document is contaminated by an item if, in the passages found, at least ``OVERLAP`` of the five-word
shingles of the question and of those of the answer occur. A part of fewer words is one shingle.

Words are lower-cased runs without white space, less the ASCII punctuation at their ends.

The index of at most about ``SHARD_BYTES`` of items is sent to the tasks; more items are dealt to as
many indexes as needed, each with a pass of its own. Document frequencies are those of all items.

Defined cases: null or wordless items and texts match nothing; items of equal text each match; items
of equal id count as one in the result. A text of over ``PIECE_BYTES`` is judged in parts, which overlap
by more than twice the longest item: question and answer must then be found in one part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.llm.words import PIECE_BYTES, Words, find_words, is_long, long_parts, pieces, word_hashes

SEGMENT = 64
BLOCK = 8
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
K1, B = 1.2, 0.75
COMMON = 0.05
SHARD_BYTES = 2 << 20

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
FOUND = "doc_id long, item_id long, word long, score double, question_overlap double, answer_overlap double"


def normal_words(column: pa.Array) -> Words:
    words = find_words(pc.utf8_lower(column.fill_null("")))
    starts, ends = words.starts.copy(), words.ends.copy()
    while len(starts) and (more := (starts < ends) & _PUNCTUATION[words.data[np.minimum(starts, len(words.data) - 1)]]).any():
        starts += more
    while len(ends) and (more := (starts < ends) & _PUNCTUATION[words.data[ends - 1]]).any():
        ends -= more
    some = starts < ends
    first = np.concatenate([[0], np.cumsum(some)])[words.first]
    return Words(words.data, starts[some], ends[some], first)


class Index:
    """Entries of a shard of items, in blocks."""

    def __init__(self, items: Iterable[tuple[int | None, bytes]], frequency: dict[int, int], entries_total: int, mean_length: float) -> None:
        self.items: list[tuple[int | None, np.ndarray]] = []  # id and word hashes
        entries = []  # item number, hashes of a segment
        for item_id, packed in items:
            hashes = np.frombuffer(packed, np.uint64)
            if len(hashes):
                entries += [(len(self.items), part) for part in segments(hashes)]
                self.items.append((item_id, hashes))
        entries.sort(key=lambda x: len(x[1]))  # alike lengths have alike impacts
        self.item_of = np.array([e[0] for e in entries], int)
        self.vocabulary = np.unique(np.concatenate([e[1] for e in entries])) if entries else np.zeros(0, np.uint64)
        self.blocks = -(-len(entries) // BLOCK)
        term, entry, impact = [], [], []
        for number, (_, hashes) in enumerate(entries):
            kinds, tf = np.unique(hashes, return_counts=True)
            df = np.array([frequency[int(x)] for x in kinds])
            weight = np.log(1 + (entries_total - df + 0.5) / (df + 0.5))
            weight *= tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / mean_length))
            term.append(np.searchsorted(self.vocabulary, kinds))
            entry.append(np.full(len(kinds), number))
            impact.append(weight / weight.sum())
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        term, entry, impact = join(term, int), join(entry, int), join(impact, float)
        order = np.lexsort((entry, term))
        self.entry, self.impact = entry[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.vocabulary) + 1))
        # Largest impact of each term in each block it has postings in.
        pair = term[order] * max(1, self.blocks) + self.entry // BLOCK
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        begin = np.flatnonzero(new)
        self.block_of = (self.entry // BLOCK)[begin]
        self.block_max = np.maximum.reduceat(self.impact, begin) if len(begin) else np.zeros(0)
        self.block_first = np.searchsorted(term[order][begin], np.arange(len(self.vocabulary) + 1))
        frequent = np.diff(self.first) > max(1.0, COMMON * len(entries))
        self.common = np.flatnonzero(frequent)  # at most 1 / COMMON times the mean length of an entry
        self.common_number = np.where(frequent, np.cumsum(frequent) - 1, -1)
        self.common_max = np.zeros((len(self.common), self.blocks), np.float32)
        self.common_impact = np.zeros((len(self.common), self.blocks * BLOCK), np.float32)
        for row, t in enumerate(self.common):
            at = slice(self.block_first[t], self.block_first[t + 1])
            self.common_max[row, self.block_of[at]] = self.block_max[at]
            at = slice(self.first[t], self.first[t + 1])
            self.common_impact[row, self.entry[at]] = self.impact[at]

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def open_blocks(self, passage: np.ndarray, term: np.ndarray, passages: int) -> tuple[np.ndarray, np.ndarray]:
        """Passages and blocks whose bound reaches the threshold, from distinct terms of passages."""
        number = self.common_number[term]
        own = number >= 0
        holds = np.zeros((passages, len(self.common)), np.float32)
        holds[passage[own], number[own]] = 1
        rare, who = term[~own], passage[~own]
        counts = self.block_first[rare + 1] - self.block_first[rare]
        at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts - self.block_first[rare], counts)
        cell = np.repeat(who, counts) * self.blocks + self.block_of[at]
        bound = np.bincount(cell, self.block_max[at], passages * self.blocks).reshape(passages, self.blocks)
        rows, blocks = np.nonzero(bound + holds @ self.common_max >= THRESHOLD - 1e-4)
        stays = np.zeros(len(rows), bool)
        for block in np.unique(blocks):
            own = np.flatnonzero(blocks == block)
            frequent = holds[rows[own]] @ self.common_impact[:, block * BLOCK : (block + 1) * BLOCK]
            stays[own] = bound[rows[own], block] + frequent.max(axis=1) >= THRESHOLD - 1e-4
        return rows[stays], blocks[stays]

    def wand(self, terms: list[int], blocks: set[int], threshold: float = THRESHOLD) -> dict[int, float]:
        """All entries whose score for a set of terms reaches the threshold, with the score. Cursors
        skip blocks outside ``blocks``."""
        lists = []
        for t in terms:
            low, high = self.first[t], self.first[t + 1]
            maxima = dict(zip(self.block_of[self.block_first[t] : self.block_first[t + 1]].tolist(), self.block_max[self.block_first[t] : self.block_first[t + 1]].tolist(), strict=True))
            entries = self.entry[low:high].tolist()
            lists.append([entries, self.impact[low:high].tolist(), maxima, max(maxima.values()), 0])
        found = {}
        threshold -= 1e-9
        while True:
            lists = [x for x in lists if x[4] < len(x[0])]
            lists.sort(key=lambda x: x[0][x[4]])
            total, pivot = 0.0, None
            for place, x in enumerate(lists):
                total += x[3]
                if total >= threshold:
                    pivot = place
                    break
            if pivot is None:
                return found
            entry = lists[pivot][0][lists[pivot][4]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][4]] == entry:
                pivot += 1
            block = entry // BLOCK
            ahead = lists[: pivot + 1]
            if block not in blocks or sum(x[2].get(block, 0.0) for x in ahead) < threshold:
                # Nothing in this block can reach it with these lists: on to its end, or to the next list.
                goal = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    goal = min(goal, lists[pivot + 1][0][lists[pivot + 1][4]])
                goal = max(goal, entry + 1)
            elif lists[0][0][lists[0][4]] == entry:
                score = sum(x[1][x[4]] for x in ahead)
                if score >= threshold:
                    found[entry] = score
                goal = entry + 1
            else:
                goal = entry
            for x in ahead:
                while x[4] < len(x[0]) and x[0][x[4]] < goal:
                    x[4] += 1


def segments(hashes: np.ndarray) -> list[np.ndarray]:
    return np.array_split(hashes, -(-len(hashes) // SEGMENT))


def shingles(hashes: np.ndarray) -> set[bytes]:
    width = min(SHINGLE, len(hashes))
    return {hashes[i : i + width].tobytes() for i in range(len(hashes) - width + 1)} if width else set()


def parts_of(hashes: np.ndarray) -> tuple[set[bytes], set[bytes]]:
    """The shingles of the question and of the answer."""
    cut = -(-2 * len(hashes) // 3)
    return shingles(hashes[:cut]), shingles(hashes[cut:])


def overlap(part: set[bytes], text: bytes, sizes: dict[int, set[bytes]], hashes: np.ndarray) -> float:
    """The share of shingles that the text has."""
    if not part:
        return 1.0
    width = len(next(iter(part))) // 8
    if width not in sizes:
        sizes[width] = {text[8 * i : 8 * (i + width)] for i in range(len(hashes) - width + 1)}
    return len(part & sizes[width]) / len(part)


def search(index: Index, words: Words) -> Iterator[tuple[int, int, int, float, float, float]]:
    """Text number, item id, first word, score and overlaps of every contamination of a piece."""
    counts = words.counts
    if not index.blocks or not len(words.starts):
        return
    hashes = word_hashes(words)
    term = index.terms(hashes)
    chunks = np.maximum(1, -(-counts // SEGMENT))
    passages = np.maximum(1, chunks - 1)  # chunk i and i + 1
    base = np.concatenate([[0], np.cumsum(passages)])
    text = words.text_of_word()
    chunk = (np.arange(len(text)) - words.first[text]) // SEGMENT
    known = term >= 0
    text, chunk, term = text[known], chunk[known], term[known]
    early, late = chunk >= 1, chunk < passages[text]
    who = np.concatenate([(base[text] + chunk - 1)[early], (base[text] + chunk)[late]])
    pair = np.unique(who * len(index.vocabulary) + np.concatenate([term[early], term[late]]))
    who, term = np.divmod(pair, len(index.vocabulary))
    rows, blocks = index.open_blocks(who, term, int(base[-1]))
    hits = defaultdict(list)
    for passage in np.unique(rows):
        low, high = np.searchsorted(who, [passage, passage + 1])
        number = int(np.searchsorted(base, passage, "right")) - 1
        found = index.wand(term[low:high].tolist(), set(blocks[rows == passage].tolist()))
        for entry, score in found.items():
            hits[number, index.item_of[entry]].append((int(passage - base[number]), score))
    for (number, item), places in hits.items():
        at = words.first[number]
        first, last = min(p for p, _ in places), max(p for p, _ in places)
        own = hashes[at + first * SEGMENT : min(at + (last + 2) * SEGMENT, words.first[number + 1])]
        item_id, item_hashes = index.items[item]
        sizes: dict[int, set[bytes]] = {}
        question, answer = (overlap(part, own.tobytes(), sizes, own) for part in parts_of(item_hashes))
        if question >= OVERLAP and answer >= OVERLAP:
            yield number, item_id, first * SEGMENT, max(s for _, s in places), question, answer


def search_long(index: Index, column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, int, float, float, float]]:
    """The same for a single text, in parts that share twice the words of the longest item and a passage.
    What parts have in common may be found in both."""
    shared = 2 * max((len(hashes) for _, hashes in index.items), default=0) + 2 * SEGMENT
    before, begin, held = 0, 0, None
    for at, part in long_parts(column, shared, limit):
        if held is not None:
            before += int((held < at - begin).sum())
        words = normal_words(part)
        begin, held = at, words.starts
        for number, item, word, *figures in search(index, words):
            yield number, item, before + word, *figures


def _searched(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in pieces(batch):
                text = piece.column("text")
                rows = list(search_long(index, text) if is_long(piece) else search(index, normal_words(text)))
                ids = piece.column("doc_id")
                columns: list[Any] = [ids.take(pa.array([r[0] for r in rows], pa.int64()))]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                columns += [pa.array([r[i + 1] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in FOUND.split(", ")])

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = normal_words(batch.column("text"))
        hashes = word_hashes(words)
        packed = [hashes[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        parts = [[np.unique(x).view(np.int64).tolist() for x in segments(hashes[a:b])] if b > a else [] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        columns = [batch.column("item_id"), pa.array(packed, pa.binary()), pa.array(parts, pa.list_(pa.list_(pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "terms"])


def contaminations(
    df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, item_id, word (where the passages start), score, question_overlap, answer_overlap: one
    row for each document and item of which it holds question and answer."""
    spark = df.sparkSession
    ship(spark)
    named = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    # One item may have null id: it is matched and reported with it.
    cut = named.filter("text is not null").mapInArrow(_item_words, "item_id long, words binary, terms array<array<long>>")
    size = cut.agg(F.sum(F.octet_length("words")), F.sum(F.size("terms"))).first()
    total, entries = size[0] or 0, size[1] or 0
    shards = 1 + total // shard_bytes
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))
    frequency = dealt.selectExpr("explode(terms) segment").selectExpr("explode(segment) term").groupBy("term").agg(F.count("*").alias("df"))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = []
    for shard in range(shards):
        own = dealt.filter(F.col("shard") == shard)
        terms = own.selectExpr("explode(flatten(terms)) term").distinct().join(frequency, "term").toPandas()  # bounded, as the shard is
        known = dict(zip((terms["term"].to_numpy(np.int64).view(np.uint64)).tolist(), terms["df"].tolist(), strict=True))
        index = Index(own.select("item_id", "words").orderBy("item_id", "words").collect(), known, entries, total / 8 / max(1, entries))
        found.append(docs.mapInArrow(_searched(spark.sparkContext.broadcast(index)), FOUND))
    every = reduce(DataFrame.unionAll, found)
    best = [F.max_by(c, "score").alias(c) for c in ("word", "question_overlap", "answer_overlap")]
    return every.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), *best).select("doc_id", "item_id", "word", "score", "question_overlap", "answer_overlap")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold no item, in the columns of ``docs``.

    Rows are judged one by one, by a 64-bit hash of id and text: of rows of equal or null id only those
    that hold an item go.
    """
    key = F.xxhash64("doc_id", "text")
    bad = contaminations(docs.select(key.alias("key"), "text"), items, "key").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_bad"], "left_anti")
