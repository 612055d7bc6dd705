"""Brown class-based bigram language model.

Counts of all words of the training documents are a table. The ``CLUSTERED`` most frequent words (a
parameter of the model, the document end among them) are assigned to ``CLASSES`` classes by exchange:
a word moves to the class that raises the likelihood of the class bigrams most, until few move. Every
other training word is then classed by Spark: its neighbours are counted by class, those that are no
clustered words by a few classes of spelling, and it moves to the class with the largest exchange
gain, all words at once and once. Then

    P(word | previous) = P(class | previous class) * P(word | class)

with class bigrams counted anew from all training tokens, transitions smoothed towards the frequency
of the class, and relative frequencies within a class. Only words not seen in training belong to the
classes of spelling. A word seen once counts a second time as one of its spelling, and an unseen
word is one of as many as the training words of its spelling and one more.

What tasks are sent is bounded: class and count of the ``HEAD`` most frequent words, and the class
tables. Counts and classes of rarer words, which grow with the corpus, are joined to the rare words
of each document, and to both words of a rare pair, by a shuffle. Words are 64-bit hashes throughout.

Defined cases: a null text is empty; an empty text is the end alone. Without training documents the
classes are uniform and the base probability of every token is 1. Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.shipping import ship
from lakelayers.llm.tables import is_remainder
from lakelayers.llm.words import Words, find_words, pieces, word_hashes
from lakelayers.scratch import stage

CLUSTERED = 1000
CLASSES = 48
HEAD = 65_536
ROUNDS = 8
SHAPES = 8
STRENGTH = 20.0
FLUSH_WORDS = 500_000

END = np.uint64(0x5EED0FE4D0000001)
END_SHAPE = 0
_COUNTS = "word long, shape int, n long"

# Twice the number of each last byte: 1 full stop, 2 comma, 3 other symbol, 0 any other byte.
_END_SHAPES = np.full(256, 6, np.int8)
_END_SHAPES[[*range(48, 58), *range(97, 123), *range(128, 256)]] = 0
_END_SHAPES[[46, 44]] = 2, 4


def shapes(words: Words) -> np.ndarray:
    """0 to 7 for each word: how it ends (full stop, comma, other symbol, none) and whether it has a
    byte beyond ASCII."""
    if not len(words.starts):
        return np.zeros(0, np.int8)
    high = words.data >> 7
    before = np.cumsum(high, dtype=np.int32 if len(high) < 1 << 31 else np.int64)
    beyond = before[words.ends - 1] > before[words.starts] - high[words.starts]
    return _END_SHAPES[words.data[words.ends - 1]] + beyond


def tokens(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shapes of all tokens, an end behind the words of each text, and the bounds."""
    words = find_words(piece.column("text"), lower=True)
    n = len(words.counts)
    bounds = words.first + np.arange(n + 1)
    total = int(bounds[-1])
    hashes, kinds = np.full(total, END), np.full(total, END_SHAPE, np.int8)
    place = np.arange(len(words.starts)) + words.text_of_word()
    hashes[place], kinds[place] = word_hashes(words), shapes(words)
    return hashes, kinds, bounds


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task, summed up to half a million distinct ones at a time."""
    held = (np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.int64))

    def batch_of(held) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1].astype(np.int32)), pa.array(held[2])], ["word", "shape", "n"])

    for batch in batches:
        for piece in pieces(batch):
            hashes, kinds, _ = tokens(piece)
            word, at, n = np.unique(hashes, return_index=True, return_counts=True)
            every = np.concatenate([held[0], word])
            word, first, inverse = np.unique(every, return_index=True, return_inverse=True)
            held = (word, np.concatenate([held[1], kinds[at]])[first], np.bincount(inverse, np.concatenate([held[2], n]), len(word)).astype(np.int64))
            if len(word) >= FLUSH_WORDS:
                yield batch_of(held)
                held = tuple(x[:0] for x in held)
    if len(held[0]):
        yield batch_of(held)


class Head(NamedTuple):
    """The most frequent words, sorted by hash."""

    words: np.ndarray
    counts: np.ndarray
    units: np.ndarray  # number among the clustered words, or -1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)


def units_of(head: Head, place: np.ndarray, kinds: np.ndarray, clustered: int) -> np.ndarray:
    """Clustered words are numbered from 0, spelling classes behind them."""
    unit = head.units[place] if len(head.units) else np.full(len(place), -1)
    return np.where((place >= 0) & (unit >= 0), unit, clustered + kinds.astype(np.int64))


def previous_units(unit: np.ndarray, bounds: np.ndarray, end: int) -> np.ndarray:
    before = np.empty_like(unit)
    before[1:] = unit[:-1]
    before[bounds[:-1]] = end
    return before


def _bigrams(shared, clustered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, size = shared.value, clustered + SHAPES
        end = int(units_of(head, head.find(np.array([END])), np.array([END_SHAPE]), clustered)[0])
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                hashes, kinds, bounds = tokens(piece)
                unit = units_of(head, head.find(hashes), kinds, clustered)
                total += np.bincount(previous_units(unit, bounds, end) * size + unit, minlength=size * size)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], ["pair", "n"])

    return run


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, clustered: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit. ``bigrams``: counts of unit pairs, the last units being classes already."""
    size = len(bigrams)
    fixed = size - clustered
    total = classes + fixed
    weight = bigrams.sum(axis=0)
    owner = np.empty(size, int)
    owner[:clustered] = np.argsort(np.argsort(-weight[:clustered], kind="stable"), kind="stable") % classes
    owner[clustered:] = classes + np.arange(fixed)
    member = np.zeros((size, total))
    member[np.arange(size), owner] = 1
    out_of, into = bigrams @ member, bigrams.T @ member  # by unit and class
    table = member.T @ out_of
    for _ in range(rounds):
        moved = 0
        for w in np.argsort(-weight[:clustered], kind="stable"):
            old, own = owner[w], bigrams[w, w]
            right, left = out_of[w].copy(), into[w].copy()
            right[old] -= own
            left[old] -= own
            # The counts without w, and what w adds to the row and column of a class.
            rest = table.copy()
            rest[old] -= right
            rest[:, old] -= left
            rest[old, old] -= own
            row, column = _entropy(rest + right).sum(axis=1), _entropy(rest + left[:, None]).sum(axis=0)
            row0, column0 = _entropy(rest).sum(axis=1), _entropy(rest).sum(axis=0)
            cell = np.diag(rest)
            # The cell of a class with itself is in both its row and its column.
            gain = row - row0 + column - column0
            gain -= _entropy(cell + right) + _entropy(cell + left) - 2 * _entropy(cell)
            gain += _entropy(cell + right + left + own) - _entropy(cell)
            ins, outs = rest.sum(axis=0), rest.sum(axis=1)
            n_in, n_out = left.sum() + own, right.sum() + own
            gain -= _entropy(ins + n_in) - _entropy(ins) + _entropy(outs + n_out) - _entropy(outs)
            new = int(np.argmax(gain[:classes]))
            if new != old and gain[new] > gain[old] + 1e-9:
                owner[w] = new
                moved += 1
                table = rest
                table[new] += right
                table[:, new] += left
                table[new, new] += own
                out_of[:, old] -= bigrams[:, w]
                out_of[:, new] += bigrams[:, w]
                into[:, old] -= bigrams[w]
                into[:, new] += bigrams[w]
        if moved <= clustered // 100:
            break
    return owner


class Model(NamedTuple):
    head: Head
    clustered: int
    tokens: int
    distinct: int
    unit_class: np.ndarray
    transition: np.ndarray  # log10 of P(class | previous class)
    emission: np.ndarray  # log10 of P(word | class) of clustered words; minus log10 of the denominator of spelling classes
    pair: np.ndarray  # counts of class pairs

    @property
    def end(self) -> int:
        return int(units_of(self.head, self.head.find(np.array([END])), np.array([END_SHAPE]), self.clustered)[0])


def fit(train: DataFrame, counts: DataFrame, clustered: int = CLUSTERED, classes: int = CLASSES, head_words: int = HEAD) -> Model:
    """The model of the clustered words, from which the others are classed. ``counts``: the word
    counts of ``train``, a written table."""
    spark = train.sparkSession
    top = counts.orderBy(F.desc("n"), "word").limit(head_words).toPandas()  # a parameter of the model
    word = top["word"].to_numpy(np.int64).view(np.uint64)
    units = np.full(len(word), -1)
    units[:clustered] = np.arange(min(clustered, len(word)))
    order = np.argsort(word)
    head = Head(word[order], top["n"].to_numpy(np.int64)[order], units[order])
    clustered = min(clustered, len(word))
    size = clustered + SHAPES
    bigrams = np.zeros(size * size)
    rows = train.select("text").mapInArrow(_bigrams(spark.sparkContext.broadcast(head), clustered), "pair int, n long")
    pairs = rows.groupBy("pair").agg(F.sum("n").alias("n")).toPandas()  # at most size * size rows
    bigrams[pairs["pair"]] = pairs["n"]
    bigrams = bigrams.reshape(size, size)
    owner = exchange(bigrams, clustered, classes)
    member = np.zeros((size, classes + SHAPES))
    member[np.arange(size), owner] = 1
    pair = member.T @ bigrams @ member
    often = pair.sum(axis=0)
    prior = (often + 1) / (often.sum() + len(often))
    transition = (pair + STRENGTH * prior) / (pair.sum(axis=1, keepdims=True) + STRENGTH)
    sums = counts.agg(F.sum("n"), F.count("*")).first()
    kinds = {r["shape"]: r["distinct"] for r in counts.groupBy("shape").agg(F.count("*").alias("distinct")).collect()}
    own = np.bincount(top["shape"].to_numpy(int)[:clustered], minlength=SHAPES)
    distinct = np.array([kinds.get(s, 0) for s in range(SHAPES)]) - own[:SHAPES]
    unit_counts = bigrams.sum(axis=0)
    emission = np.empty(size)
    emission[:clustered] = np.log10(np.maximum(unit_counts[:clustered], 1) / np.maximum(often[owner[:clustered]], 1))
    emission[clustered:] = -np.log10(unit_counts[clustered:] + distinct + 1)
    return Model(head, clustered, int(sums[0] or 0), int(sums[1]), owner, np.log10(transition), emission, pair)


_CONTEXTS = "word long, shape int, contexts binary"
_CLASSES = "word long, shape int, n long, class int"
_ENTRY = np.dtype([("context", "<u2"), ("n", "<u4")])
FLUSH_CONTEXTS = 1_000_000


def _packed(word: np.ndarray, shape: np.ndarray, context: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One row for each word. The words are sorted."""
    at = np.flatnonzero(np.concatenate([np.ones(min(len(word), 1), bool), word[1:] != word[:-1]]))
    entries = np.empty(len(word), _ENTRY)
    entries["context"], entries["n"] = context, n
    bounds = (np.append(at, len(word)) * _ENTRY.itemsize).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(entries.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(word[at].view(np.int64)), pa.array(shape[at].astype(np.int32)), packed], ["word", "shape", "contexts"])


def _contexts(shared, classes: int):
    """Neighbours of each word that is not clustered: before it by class, after it by class, itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, owner, head_shapes = shared.value
        size = classes + SHAPES
        width = 2 * size + 1
        total = np.zeros(len(head.words) * width, np.int64)
        often, held, entries = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([x for x in often]) if often else np.zeros(0, np.int64)
            if len(keys):
                total[:] += np.bincount(keys, minlength=len(total))
            if held:
                word, shape, context = (np.concatenate(x) for x in zip(*held))
                words, at, place = np.unique(word, return_index=True, return_inverse=True)
                key, n = np.unique(place * width + context, return_counts=True)
                yield from cut(words[key // width], shape[at][key // width], key % width, n)
            often.clear()
            held.clear()

        def cut(word, shape, context, n) -> Iterator[pa.RecordBatch]:
            at = 0
            while at < len(word):
                to = min(at + FLUSH_CONTEXTS, len(word))
                to = int(np.searchsorted(word, word[to - 1], "right"))
                yield _packed(word[at:to], shape[at:to], context[at:to], n[at:to])
                at = to

        def add(word, shape, place, context) -> None:
            known = place >= 0
            often.append(place[known] * width + context[known])
            held.append((word[~known], shape[~known], context[~known]))

        end = head.find(np.array([END]))
        end_unit = head.units[end[0]] if end[0] >= 0 else -1
        end_class = owner[end_unit] if end_unit >= 0 else classes + END_SHAPE
        for batch in batches:
            for piece in pieces(batch):
                hashes, kinds, bounds = tokens(piece)
                place = head.find(hashes)
                unit = np.where(place >= 0, head.units[place], -1) if len(head.units) else np.full(len(place), -1)
                kind = np.where(unit >= 0, owner[unit], classes + kinds.astype(np.int64)) if len(owner) else classes + kinds.astype(np.int64)
                last = [previous_units(x, bounds, e) for x, e in ((hashes, END), (kinds, END_SHAPE), (place, end[0]), (unit, end_unit), (kind, end_class))]
                own = hashes == last[0]
                mine, its = unit < 0, (last[3] < 0) & ~own
                add(hashes[mine], kinds[mine], place[mine], np.where(own, 2 * size, last[4])[mine])
                add(last[0][its], last[1][its], last[2][its], size + kind[its])
                entries += int(mine.sum() + its.sum())
                if entries >= FLUSH_CONTEXTS:
                    yield from flush()
                    entries = 0
        yield from flush()
        key = np.flatnonzero(total)
        yield from cut(head.words[key // width], head_shapes[key // width], key % width, total[key])

    return run


def gains(pair: np.ndarray, old: np.ndarray, before: np.ndarray, after: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    """What the likelihood of the class bigrams gains by each word (a row) in each class (a column).

    ``before`` and ``after``: counts of its neighbours by class, without itself, which ``own`` counts;
    ``pair``: counts of class pairs in which the word still is in the class ``old``.
    """
    every, n = np.arange(len(old)), before.sum(axis=1) + own
    gain = np.zeros((len(old), classes))
    for counts, other, cells in ((after, before, pair.T), (before, after, pair)):
        word, at = np.nonzero(counts)
        for start in range(0, len(word), 20_000):
            w, c = word[start : start + 20_000], at[start : start + 20_000]
            x = counts[w, c][:, None]
            rest = cells[c, :classes] - np.where((c == old[w])[:, None], other[w, :classes], 0)
            mine = np.flatnonzero(old[w] < classes)
            same = (c[mine] == old[w[mine]]) * own[w[mine]]
            rest[mine, old[w[mine]]] -= x[mine, 0] + same
            part = _entropy(rest + x) - _entropy(rest)
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            gain[w[first]] += np.add.reduceat(part, first)
    diagonal, often = np.tile(np.diag(pair)[:classes], (len(old), 1)), np.tile(pair.sum(axis=0)[:classes], (len(old), 1))
    mine = np.flatnonzero(old < classes)
    diagonal[mine, old[mine]] -= before[mine, old[mine]] + after[mine, old[mine]] + own[mine]
    often[mine, old[mine]] -= n[mine]
    left, right = before[:, :classes], after[:, :classes]
    gain -= _entropy(diagonal + right) + _entropy(diagonal + left) - 2 * _entropy(diagonal)
    gain += _entropy(diagonal + right + left + own[every, None]) - _entropy(diagonal)
    return gain - 2 * (_entropy(often + n[:, None]) - _entropy(often))


def _assigned(shared, classes: int):
    """The class of each word, from its rows, which follow one another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value
        size = classes + SHAPES
        width = 2 * size + 1

        def classed(table: pa.Table) -> pa.RecordBatch:
            column = table.column("contexts").combine_chunks().cast(pa.large_binary())
            bounds = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
            entries = np.frombuffer(column.buffers()[2], _ENTRY, (bounds[-1] - bounds[0]) // _ENTRY.itemsize, bounds[0])
            word, shape = table.column("word").to_numpy(), table.column("shape").to_numpy()
            new = np.concatenate([[True], word[1:] != word[:-1]])
            at, number = np.flatnonzero(new), np.repeat(np.cumsum(new) - 1, np.diff(bounds) // _ENTRY.itemsize)
            found = np.bincount(number * width + entries["context"], entries["n"], len(at) * width).reshape(len(at), width)
            before, after, own = found[:, :size], found[:, size : 2 * size], found[:, -1]
            n = before.sum(axis=1) + own
            best = gains(pair, classes + shape[at], before, after, own, classes).argmax(axis=1)
            columns = [pa.array(word[at]), pa.array(shape[at].astype(np.int32)), pa.array(n.astype(np.int64)), pa.array(best.astype(np.int32))]
            return pa.RecordBatch.from_arrays(columns, ["word", "shape", "n", "class"])

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            word = held.column("word").to_numpy()
            whole = int(np.searchsorted(word, word[-1])) if len(word) else 0
            for at in _blocks(word[:whole]):
                yield classed(held.slice(*at))
            held = held.slice(whole)
        if held is not None and held.num_rows:
            yield classed(held)

    return run


def _blocks(word: np.ndarray, limit: int = 8192) -> Iterator[tuple[int, int]]:
    """Offset and length of runs of whole words."""
    at = 0
    while at < len(word):
        to = int(np.searchsorted(word, word[min(at + limit, len(word)) - 1], "right"))
        yield at, to - at
        at = to


class Lexicon(NamedTuple):
    """The most frequent words, sorted by hash, and the document end."""

    words: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    classes: int

    find = Head.find

    def codes_of(self, place: np.ndarray) -> np.ndarray:
        """Class of each word, with its spelling if it was seen once, or -1."""
        return np.where(place >= 0, self.codes[place], -1) if len(self.codes) else np.full(len(place), -1)

    @property
    def end(self) -> int:
        """Without training documents the end is an unseen word."""
        code = int(self.codes_of(self.find(np.array([END])))[0])
        return code if code >= 0 else self.classes + END_SHAPE

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of words."""
        place = self.find(hashes)
        code = self.codes_of(place)
        return place, np.where(hashes == END, self.end, code)


def code_of(kind, shape, n, size: int):
    """The number of a class, and behind those the numbers of classes and spellings of words seen once."""
    return kind + size * (shape + 1) * (n == 1)


def _pairs(shared):
    """Class pairs of neighbours that both are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        size = (lexicon.classes + SHAPES) * (SHAPES + 1)
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                hashes, _, bounds = tokens(piece)
                code = lexicon.known(hashes)[1]
                before = previous_units(code, bounds, lexicon.end)
                both = (code >= 0) & (before >= 0)
                total += np.bincount(before[both] * size + code[both], minlength=size * size)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], ["pair", "n"])

    return run


_RARE = "word long, row_key long, about long"
_RARE_PAIRS = "word long, other long, row_key long, about long"


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct rows in their order, and how often each is there."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in columns], axis=0)
    at = np.flatnonzero(new)
    return order[at], np.diff(at, append=len(order))


def _rare(shared):
    """The words of each text that are not among the most frequent, and how often it has them.
    ``about``: that number, whether the text is for training, spelling, and codes of the neighbours
    before and behind, plus one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        for batch in batches:
            for piece in pieces(batch):
                hashes, kinds, bounds = tokens(piece)
                code = lexicon.known(hashes)[1]
                before = previous_units(code, bounds, lexicon.end)
                behind = np.append(code[1:], -1)
                behind[bounds[1:] - 1] = -1
                at = np.flatnonzero(code < 0)
                text = np.repeat(np.arange(piece.num_rows), np.diff(bounds))[at]
                train = piece.column("train").to_numpy(zero_copy_only=False)[text].astype(np.int64)
                about = ((train * SHAPES + kinds[at]) << 16 | before[at] + 1) << 16 | behind[at] + 1
                one, n = _distinct([about, hashes[at], text])
                keys = piece.column("row_key").to_numpy()
                columns = [pa.array(hashes[at][one].view(np.int64)), pa.array(keys[text[one]]), pa.array(n << 36 | about[one])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "row_key", "about"])

    return run


def _rare_pairs(shared):
    """Pairs of neighbours that both are rare. ``about``: how often the text has the pair, whether
    it is for training, and the spelling of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        for batch in batches:
            for piece in pieces(batch):
                hashes, kinds, bounds = tokens(piece)
                rare = lexicon.known(hashes)[1] < 0
                first = np.zeros(len(rare), bool)
                first[bounds[:-1]] = True
                at = np.flatnonzero(rare & np.append(False, rare[:-1])[: len(rare)] & ~first)
                text = np.repeat(np.arange(piece.num_rows), np.diff(bounds))[at]
                train = piece.column("train").to_numpy(zero_copy_only=False)[text].astype(np.int64)
                about = (train * SHAPES + kinds[at - 1]) * SHAPES + kinds[at]
                one, n = _distinct([about, hashes[at - 1], hashes[at], text])
                keys = piece.column("row_key").to_numpy()
                columns = [hashes[at - 1][one].view(np.int64), hashes[at][one].view(np.int64), keys[text[one]], n << 8 | about[one]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["word", "other", "row_key", "about"])

    return run


class Classes(NamedTuple):
    """The model of all training words."""

    lexicon: Lexicon
    transition: np.ndarray  # log10 of P(class | previous class)
    often: np.ndarray  # log10 of the tokens of each class; of spelling classes, of the words an unseen one is among


def expanded(pair: np.ndarray, classes: int) -> np.ndarray:
    """Counts of class pairs from counts of code pairs."""
    size = classes + SHAPES
    code = np.arange(len(pair))
    member = np.zeros((len(pair), size))
    member[code, code % size] = 1
    once = code[code >= size]
    member[once, classes + once // size - 1] = 1
    return member.T @ pair @ member


_SCORED = "row_key long, doc_id long, n_tokens long, n_known long, base double, score double"


def _scored(shared):
    """What is known of each text without its rare words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Classes = shared.value
        lexicon = model.lexicon
        size = lexicon.classes + SHAPES
        lead, count = np.log10(lexicon.counts + 1.0), np.log10(np.maximum(lexicon.counts, 1.0))
        for batch in batches:
            for piece in pieces(batch):
                hashes, _, bounds = tokens(piece)
                place, code = lexicon.known(hashes)
                before = previous_units(code, bounds, lexicon.end)
                own = np.where(place >= 0, lead[place], 0.0) if len(lead) else np.zeros(len(place))
                chance = np.where((code >= 0) & (before >= 0), model.transition[before % size, code % size], 0.0)
                chance += np.where(code >= 0, (np.where(place >= 0, count[place], 0.0) if len(count) else 0.0) - model.often[code % size], 0.0)
                starts = bounds[:-1]
                sums = [np.add.reduceat(x, starts) if len(starts) else x[:0] for x in ((place >= 0).astype(np.int64), own, chance)]
                columns = [piece.column("row_key"), piece.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), *map(pa.array, sums)]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _SCORED.split(", ")])

    return run


_EXTRA = "row_key long, rare_known long, rare_log double, rare_score double"


def _extra(shared):
    """What a rare word or a rare pair adds to its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Classes = shared.value
        size = model.lexicon.classes + SHAPES
        for batch in batches:
            k, n, before, code, behind = (batch.column(x).to_numpy() for x in ("k", "n", "before", "code", "behind"))
            kind, word = code % size, n >= 0
            score = np.where(word, np.log10(np.maximum(n, 1)) - model.often[kind], 0.0)
            score += np.where(before >= 0, model.transition[before % size, kind], 0.0) + np.where(behind >= 0, model.transition[kind, behind % size], 0.0)
            columns = [batch.column("row_key"), pa.array(np.where(n > 0, k, 0)), pa.array(k * np.log10(np.maximum(n, 0) + 1.0)), pa.array(k * score)]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _EXTRA.split(", ")])

    return run


def classify(train: DataFrame, counts: DataFrame, model: Model, classes: int = CLASSES) -> DataFrame:
    """``word, shape, n, class`` of every training word that is not clustered, a written table."""
    spark = train.sparkSession
    place = spark.createDataFrame([(int(w),) for w in model.head.words.view(np.int64)], "word long")
    shape = {r["word"]: r["shape"] for r in counts.join(F.broadcast(place), "word").select("word", "shape").collect()}  # as many as the head
    kinds = np.array([shape[w] for w in model.head.words.view(np.int64).tolist()], np.int8)
    shared = spark.sparkContext.broadcast((model.head, model.unit_class[: model.clustered], kinds))
    contexts = train.mapInArrow(_contexts(shared, classes), _CONTEXTS)
    together = contexts.repartition("word").sortWithinPartitions("word")
    return stage(together.mapInArrow(_assigned(spark.sparkContext.broadcast(model.pair), classes), _CLASSES), "word-classes")


def lexicon_of(classed: DataFrame, model: Model, classes: int = CLASSES) -> Lexicon:
    spark = classed.sparkSession
    size = classes + SHAPES
    end = np.array([END]).view(np.int64)
    wanted = spark.createDataFrame([(int(w),) for w in np.union1d(model.head.words.view(np.int64), end)], "word long")
    found = classed.join(F.broadcast(wanted), "word").toPandas()  # as many as the head
    word, n, kind, shape = (found[c].to_numpy(np.int64) for c in ("word", "n", "class", "shape"))
    once = np.where(word == end[0], 0, n)
    codes = code_of(kind, shape, once, size)
    seeds = np.flatnonzero(model.head.units >= 0)
    # A clustered word seen once is among those of a small corpus: it has no second count.
    word = np.concatenate([word.view(np.uint64), model.head.words[seeds]])
    n, codes = np.concatenate([n, model.head.counts[seeds]]), np.concatenate([codes, model.unit_class[model.head.units[seeds]]])
    order = np.argsort(word)
    return Lexicon(word[order], n[order], codes[order], classes)


def held_out(id_column: Column) -> Column:
    return is_remainder(id_column, 7, 2)


def rare_rows(keyed: DataFrame, classed: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``row_key, train, k, n, before, code, behind`` of rare words, with their count and the codes of
    frequent neighbours (-1 for others), and of rare pairs, with ``n`` -1. A written table."""
    spark = keyed.sparkSession
    size = lexicon.classes + SHAPES
    shared = spark.sparkContext.broadcast(lexicon)
    code = f"CASE WHEN n IS NULL THEN {lexicon.classes} + shape WHEN n = 1 THEN class + {size} * (shape + 1) ELSE class END"

    def coded(rows: DataFrame, word: str) -> DataFrame:
        looked_up = rows.join(classed.select(F.col("word").alias(word), "n", "class"), word, "left")
        return looked_up.withColumn("code", F.expr(code)).withColumn("n", F.coalesce("n", F.lit(0)))

    words = keyed.mapInArrow(_rare(shared), _RARE).withColumn("shape", F.expr("(about >> 32) & 7"))
    words = coded(words, "word").selectExpr(
        "row_key", "((about >> 35) & 1) = 1 train", "about >> 36 k", "n", "int((about >> 16) & 65535) - 1 before", "int(code) code", "int(about & 65535) - 1 behind"
    )
    pairs = keyed.mapInArrow(_rare_pairs(shared), _RARE_PAIRS).withColumn("shape", F.expr("(about >> 3) & 7"))
    pairs = coded(pairs, "word").selectExpr("other", "row_key", "about", "code before", "about & 7 shape")
    pairs = coded(pairs, "other").selectExpr("row_key", "((about >> 6) & 1) = 1 train", "about >> 8 k", "-1L n", "int(before) before", "int(code) code", "-1 behind")
    return stage(words.unionByName(pairs), "rare-words")


def fit_all(train: DataFrame, counts: DataFrame, classed: DataFrame, rare: DataFrame, seed: Model, lexicon: Lexicon) -> Classes:
    spark, classes = train.sparkSession, lexicon.classes
    size = classes + SHAPES
    codes = size * (SHAPES + 1)
    pair = np.zeros((codes, codes))
    local = train.mapInArrow(_pairs(spark.sparkContext.broadcast(lexicon)), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = local.toPandas()  # at most codes * codes rows
    np.add.at(pair, (found["pair"].to_numpy(int) // codes, found["pair"].to_numpy(int) % codes), found["n"].to_numpy(float))
    ends = F.explode(F.array(F.struct(F.col("before").alias("a"), F.col("code").alias("b")), F.struct(F.col("code").alias("a"), F.col("behind").alias("b"))))
    # Summed before it is taken apart; at most codes ** 2 pairs come to the driver.
    summed = rare.filter("train").groupBy("before", "code", "behind").agg(F.sum("k").alias("k"))
    summed = summed.select(ends.alias("e"), "k").filter("e.a >= 0 AND e.b >= 0").groupBy("e.a", "e.b").agg(F.sum("k").alias("k")).toPandas()
    np.add.at(pair, (summed["a"].to_numpy(int), summed["b"].to_numpy(int)), summed["k"].to_numpy(float))
    pair = expanded(pair, classes)
    often = pair.sum(axis=0)
    prior = (often + 1) / (often.sum() + len(often))
    transition = (pair + STRENGTH * prior) / (pair.sum(axis=1, keepdims=True) + STRENGTH)
    tokens_of = np.zeros(size)
    for r in classed.groupBy("class").agg(F.sum("n").alias("n")).collect():
        tokens_of[r["class"]] += r["n"]
    seeds = seed.head.units >= 0
    np.add.at(tokens_of, seed.unit_class[seed.head.units[seeds]], seed.head.counts[seeds])
    for r in counts.groupBy("shape").agg(F.count("*").alias("distinct")).collect():
        tokens_of[classes + r["shape"]] = r["distinct"]
    tokens_of[classes:] += 1
    return Classes(lexicon, np.log10(transition), np.log10(np.maximum(tokens_of, 1)))


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", clustered: int = CLUSTERED, classes: int = CLASSES, head_words: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of every
    row; learns from the rows that are not held out."""
    spark = df.sparkSession
    ship(spark)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    train = docs.filter(~held_out(F.col("doc_id"))).select("text")
    summed = train.mapInArrow(_counted, _COUNTS).groupBy("word").agg(F.min("shape").alias("shape"), F.sum("n").alias("n"))
    counts = stage(summed, "word-counts")
    model = fit(train, counts, clustered, classes, head_words)
    classed = classify(train, counts, model, classes)
    lexicon = lexicon_of(classed, model, classes)
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    rare = rare_rows(keyed.withColumn("train", ~held_out(F.col("doc_id"))).select("row_key", "text", "train"), classed, lexicon)
    model_of_all = fit_all(train, counts, classed, rare, model, lexicon)
    shared = spark.sparkContext.broadcast(model_of_all)
    known = keyed.mapInArrow(_scored(shared), _SCORED)
    extra = rare.select("row_key", "k", "n", "before", "code", "behind").mapInArrow(_extra(shared), _EXTRA)
    found = extra.groupBy("row_key").agg(*[F.sum(c).alias(c) for c in ("rare_known", "rare_log", "rare_score")])
    # Equal rows have equal sums: they are put together for the join and dealt out again.
    one = known.groupBy("row_key").agg(*[F.max(c).alias(c) for c in ("doc_id", "n_tokens", "n_known", "base", "score")], F.count("*").alias("copies"))
    joined = one.join(found, "row_key", "left")
    joined = joined.withColumns({e: F.coalesce(F.col(c) / F.col("copies"), F.lit(0.0)) for e, c in (("extra", "rare_log"), ("more", "rare_score"))})
    whole = float(np.log10(model.tokens + model.distinct + 1))
    scored = joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce(F.expr("rare_known div copies"), F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("extra") - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("score") + F.col("more")).alias("score"),
        F.expr("explode(sequence(1L, copies))").alias("_copy"),
    )
    return scored.drop("_copy").withColumn("perplexity", F.expr("power(10, -score / n_tokens)"))
