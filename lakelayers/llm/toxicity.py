"""Toxicity by weak supervision.

Voters: a word lexicon, lexicons of whole words and word beginnings mined from labelled rows (all whose
presence speaks so clearly for the label that less than one of those tested would by chance), and
patterns (shouting, symbols, repetition, share of lexicon words). A generative label model
takes the voters and the given label as noisy votes. By expectation maximisation it estimates how often
each votes under either class and, for voters that go together within the classes, how often given the
vote of another: the links form a tree of the largest conditional mutual information, of which those
stay that raise the likelihood by more than their parameters cost (BIC). So a copy of another voter adds
no evidence. In each round the evidence of all voters is scaled to the given labels. A logistic regression on counts and patterns is trained on the posterior labels and
calibrated on the given ones.

Mining and training use a sample of about ``SAMPLE_ROWS`` labelled rows at most, drawn by a hash of
the id, one row of each id. The voters are as many as this sample bears out; the driver holds the
sample's votes and two counts for each pair of voters. Scores are computed from whole texts alone.

Defined cases: null and empty texts get the score of a text without any vote. A text of over
``PIECE_BYTES`` is read in parts and has the counts of all its parts. Texts of equal words and marks have equal
scores, whatever stands beside them. Of several labels of an id the largest counts, null labels do not;
an id without a row teaches nothing. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.decontaminate import normal_words
from lakelayers.llm.shipping import ship
from lakelayers.llm.tables import is_remainder
from lakelayers.llm.words import Words, find_words, is_long, long_parts, mixed, pieces, text_bytes, word_hashes
from lakelayers.scratch import stage

SAMPLE_ROWS = 20_000
LEAST_ROWS = 5
BEGINNINGS = (5, 6, 7, 8)
THRESHOLD = 0.3
ROUNDS = 15
RELINKED = (0, 5)
STRENGTH = 5.0
PATTERN_VOTERS = 7

LEXICON = (
    "idiot", "idiots", "stupid", "moron", "morons", "loser", "losers", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "clowns",
    "dumb", "fool", "hate", "garbage", "filth", "vermin", "imbecile", "jerk",
)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and their beginnings, and the number of the word each belongs to."""
    hashes, owner = [word_hashes(words)], [np.arange(len(words.starts))]
    lengths = words.ends - words.starts
    for size in BEGINNINGS:
        longer = np.flatnonzero(lengths > size)
        part = Words(words.data, words.starts[longer], words.starts[longer] + size, np.array([0, len(longer)]))
        hashes.append(mixed(word_hashes(part) + np.uint64(size)))
        owner.append(longer)
    return np.concatenate(hashes), np.concatenate(owner)


class Votes(NamedTuple):
    """Text, voter and count of each pair that occurs, in order, and totals of each text: bytes, capital
    letters, marks, symbols, digits, words, repeated neighbours, lone letters, words with any vote."""

    text: np.ndarray
    voter: np.ndarray
    n: np.ndarray
    totals: np.ndarray


def _mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts of a batch each feature occurs."""

    def of_piece(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        if is_long(piece):
            found = np.zeros(0, np.uint64)
            for _, part in long_parts(piece.column("text"), 0):
                found = np.union1d(found, features(normal_words(part))[0])
            return found, np.zeros(len(found), int)
        words = normal_words(piece.column("text"))
        found, owner = features(words)
        text = words.text_of_word()[owner]
        order = np.lexsort((found, text))
        text, found = text[order], found[order]
        new = np.ones(len(found), bool)
        new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
        return found[new], text[new]

    for batch in batches:
        seen, marks = [np.zeros(0, np.uint64)], [np.zeros(0, int)]
        for piece in pieces(batch):
            found, text = of_piece(piece)
            seen.append(found)
            marks.append(piece.column("toxic").to_numpy()[text])
        found, marks = np.concatenate(seen), np.concatenate(marks)
        kinds, inverse = np.unique(found, return_inverse=True)
        toxic = np.bincount(inverse, marks, len(kinds)).astype(np.int64)
        columns = [pa.array(kinds.view(np.int64)), pa.array(toxic), pa.array(np.bincount(inverse, minlength=len(kinds)) - toxic)]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "other"])


def lexicon_hashes() -> np.ndarray:
    return np.unique(word_hashes(find_words(pa.array(LEXICON))))


def _votes(column: pa.Array, voters: np.ndarray, gate: np.ndarray) -> tuple[Votes, np.ndarray]:
    """Votes of short texts, and the hashes of their words."""
    words = normal_words(column)
    found, owner = features(words)
    hashes, texts = found[: len(words.starts)], len(column)
    maybe = np.flatnonzero(gate[found >> np.uint64(48)])
    found, owner = found[maybe], owner[maybe]
    place = np.minimum(np.searchsorted(voters, found), max(0, len(voters) - 1))
    own = voters[place] == found if len(voters) else np.zeros(len(found), bool)
    text_of = words.text_of_word()
    cell, n = np.unique(text_of[owner[own]] * max(1, len(voters)) + place[own], return_counts=True)
    data, bounds = text_bytes(column)

    def sums(test: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(test)])[at])

    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[words.first[:-1][words.counts > 0]] = False
    byte_tests = [(data >= 65) & (data <= 90), (data == 33) | (data == 63), np.isin(data, np.frombuffer(b"#*$%&|<>@", np.uint8)), (data >= 48) & (data <= 57)]
    totals = [np.diff(bounds), *(sums(x, bounds) for x in byte_tests), words.counts]
    totals += [sums(again, words.first), sums(words.ends - words.starts == 1, words.first)]
    totals.append(np.bincount(text_of[np.unique(owner[own])], minlength=texts))  # words, not features, with any vote
    return Votes(cell // max(1, len(voters)), cell % max(1, len(voters)), n, np.stack(totals, axis=1).astype(float)), hashes


def counts_of(piece: pa.RecordBatch, voters: np.ndarray, gate: np.ndarray, limit: int | None = None) -> Votes:
    """How often each text has each voter's feature. A single long text is read in parts of ``limit`` bytes."""
    column = piece.column("text")
    if limit is None and not is_long(piece):
        return _votes(column, voters, gate)[0]
    counts, totals, last = np.zeros(len(voters), int), np.zeros((1, 9)), None
    for _, part in long_parts(column, 0, *([limit] if limit else [])):
        votes, hashes = _votes(part, voters, gate)
        counts[votes.voter] += votes.n
        totals += votes.totals
        if len(hashes):
            totals[0, 6] += last == hashes[0]
            last = hashes[-1]
    voter = np.flatnonzero(counts)
    return Votes(np.zeros(len(voter), int), voter, counts[voter], totals)


def gate_of(voters: np.ndarray) -> np.ndarray:
    gate = np.zeros(1 << 16, bool)
    gate[voters >> np.uint64(48)] = True
    return gate


def _sampled(voters: np.ndarray):
    gate = gate_of(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                votes = counts_of(piece, voters, gate)
                bounds = np.searchsorted(votes.text, np.arange(piece.num_rows + 1))
                cut = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                packed = [[x[c].astype(np.int32).tobytes() for c in cut] for x in (votes.voter, votes.n)]
                columns = [piece.column("doc_id"), piece.column("toxic"), *(pa.array(x, pa.binary()) for x in packed), pa.array([x.tobytes() for x in votes.totals], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "voter", "n", "totals"])

    return run


def patterns(totals: np.ndarray) -> np.ndarray:
    """Shares of capital letters, marks, symbols, digits, repeated neighbours, lone letters, and the
    logarithm of the length."""
    size, words = np.maximum(totals[:, :1], 1), np.maximum(totals[:, 5:6], 1)
    return np.concatenate([totals[:, 1:5] / size, totals[:, 6:8] / words, np.log1p(totals[:, 5:6]) / 10], axis=1)


def dense_inputs(totals: np.ndarray) -> np.ndarray:
    """What the classifier sees beside the counts: their sum and density, and patterns."""
    hits, length = totals[:, 8:], totals[:, 5:6]
    extra = [np.log1p(hits), hits > 0, hits > 1, hits > 3, hits / np.sqrt(length + 1), hits / (length + 10)]
    return np.concatenate([*extra, patterns(totals)], axis=1)


def ballots(votes: Votes, voters: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and voter of each vote, in order; pattern voters are numbered behind the others."""
    hits, shape = votes.totals[:, 8], patterns(votes.totals)
    words = votes.totals[:, 5]
    tests = [hits == 0, hits > 0.01 * words, hits > 0.03 * words, shape[:, 0] > 0.3, shape[:, 1] > 0.05, shape[:, 2] > 0.1, shape[:, 4] > 0.2]
    text, voter = np.nonzero(np.stack(tests, axis=1))
    text, voter = np.concatenate([votes.text, text]), np.concatenate([votes.voter, voter + voters])
    order = np.lexsort((voter, text))
    return text[order], voter[order]


class LabelModel(NamedTuple):
    posterior: np.ndarray  # of each text
    parent: np.ndarray  # the voter on which each depends, or -1
    chance: np.ndarray  # of a vote, by class, voter and vote of the parent


def label_model(text: np.ndarray, voter: np.ndarray, size: int, label: np.ndarray) -> LabelModel:
    """Fits ``size`` voters and the label, a voter of its own that depends on the class alone."""
    first = np.searchsorted(text, np.arange(len(label) + 1))
    every = pair_counts(voter, first, np.ones(len(label)), size)
    posterior = np.where(label > 0, 0.9, 0.03)
    for step in range(ROUNDS):
        weight = np.stack([1 - posterior, posterior])
        total = weight.sum(axis=1)
        if step in RELINKED:
            toxic = pair_counts(voter, first, posterior, size)
            parent = linked(np.stack([every - toxic, toxic]), total)
            has, up = parent >= 0, np.maximum(parent, 0)
            keys = text * size + voter
            wanted = text * size + up[voter]
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            given = (has[voter] & (keys[at] == wanted)).astype(int)
        one = np.stack([np.bincount(voter, w[text], size) for w in weight])
        both = np.stack([np.bincount(voter, w[text] * given, size) for w in weight])
        usual = (one + 0.5) / (total[:, None] + 1)
        above = np.where(has, one[:, up], 0)
        chance = np.stack([(one - both + STRENGTH * usual) / (total[:, None] - above + STRENGTH), (both + STRENGTH * usual) / (above + STRENGTH)], axis=2)
        chance = np.clip(chance, 1e-6, 1 - 1e-6)
        for_one, for_none = np.log(chance[1]) - np.log(chance[0]), np.log(1 - chance[1]) - np.log(1 - chance[0])
        # A vote changes what the absence of those that depend on it says.
        below = np.bincount(up[has], (for_none[:, 1] - for_none[:, 0])[has], size)
        evidence = np.bincount(text, (for_one - for_none)[voter, given] + below[voter], len(label)) + for_none[:, 0].sum()
        # What links leave out still counts twice: together the voters say as much as the labels bear out.
        slope, shift = _logistic(lambda w: evidence * w[0] + w[1], lambda r: np.array([evidence @ r, r.sum()]), 1, label.astype(float), penalty=1e-3)
        evidence = evidence * slope + shift
        said = (weight @ label + 0.5) / (total + 1)
        evidence += np.where(label > 0, np.log(said[1] / said[0]), np.log((1 - said[1]) / (1 - said[0])))
        posterior = _sigmoid(evidence)
    return LabelModel(posterior, parent, chance)


def pair_counts(voter: np.ndarray, first: np.ndarray, weight: np.ndarray, size: int, limit: int = 4_000_000) -> np.ndarray:
    """The weight of the texts in which two voters vote, for each two; ``first``: bounds of the texts."""
    counts, total = np.diff(first), np.zeros(size * size)
    pairs = np.cumsum(counts**2)
    at = 0
    while at < len(counts):
        to = max(at + 1, int(np.searchsorted(pairs, (pairs[at - 1] if at else 0) + limit, "right")))
        each = np.repeat(counts[at:to], counts[at:to])  # votes that stand against each vote
        left = np.repeat(voter[first[at] : first[to]], each)
        begin = np.repeat(first[at:to], counts[at:to])
        right = voter[np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begin, each)]
        total += np.bincount(left * size + right, np.repeat(weight[at:to], counts[at:to] ** 2), size * size)
        at = to
    return total.reshape(size, size)


def linked(joint: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The parent of each voter in a tree of the largest mutual information within the classes, -1 where
    the link does not pay. ``joint``: pair counts by class."""
    size, rows = joint.shape[1], total.sum()
    single = np.stack([np.diag(x) for x in joint])
    best, parent, out = np.full(size, -1.0), np.full(size, -1), np.ones(size, bool)
    at = int(np.argmax(single.sum(axis=0))) if size else 0
    for _ in range(size):
        out[at] = False
        shared = np.zeros(size)
        for c in (0, 1):
            both, own, other, every = joint[c, at], single[c, at], single[c], max(total[c], 1e-9)
            for n, a, b in ((both, own, other), (own - both, own, every - other), (other - both, every - own, other), (every - own - other + both, every - own, every - other)):
                n = np.maximum(n, 0)
                shared += n * np.log(np.maximum(n * every, 1e-12) / np.maximum(a * b, 1e-12))
        better = out & (shared > best)
        best[better], parent[better] = shared[better], at
        if out.any():
            at = int(np.argmax(np.where(out, best, -2.0)))
    return np.where(best > np.log(max(rows, 2)), parent, -1)


class Model(NamedTuple):
    """Weights of counts, then of the dense inputs."""

    voters: np.ndarray
    weights: np.ndarray
    bias: float


def margins(votes: Votes, weights: np.ndarray, bias: float) -> np.ndarray:
    counts = weights[: len(weights) - 13]
    return np.bincount(votes.text, np.log1p(votes.n) * counts[votes.voter], len(votes.totals)) + dense_inputs(votes.totals) @ weights[len(counts) :] + bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(votes: Votes, label: np.ndarray, voters: np.ndarray) -> Model:
    posterior = label_model(*ballots(votes, len(voters)), len(voters) + PATTERN_VOTERS, label).posterior
    rows, dense, value = len(label), dense_inputs(votes.totals), np.log1p(votes.n)

    def times(u: np.ndarray) -> np.ndarray:
        return np.bincount(votes.text, value * u[votes.voter], rows) + dense @ u[len(voters) :]

    def turned(r: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(votes.voter, value * r[votes.text], len(voters)), dense.T @ r])

    mean = turned(np.full(rows, 1 / rows))
    square = np.concatenate([np.bincount(votes.voter, value**2, len(voters)), (dense**2).sum(axis=0)]) / rows
    scale = np.sqrt(np.maximum(square - mean**2, 0)) + 0.05
    width = len(mean)
    w = _logistic(
        lambda w: times(w[:-1] / scale) - mean @ (w[:-1] / scale) + w[-1],
        lambda r: np.append((turned(r) - mean * r.sum()) / scale, r.sum()),
        width, posterior, penalty=20.0,
    )
    weights, bias = w[:-1] / scale, w[-1] - mean @ (w[:-1] / scale)
    # Calibration on the given labels.
    margin = times(weights) + bias
    slope, shift = _logistic(lambda w: margin * w[0] + w[1], lambda r: np.array([margin @ r, r.sum()]), 1, label.astype(float), penalty=1e-3)
    return Model(voters, weights * slope, float(bias * slope + shift))


def _logistic(times: Callable, turned: Callable, width: int, goal: np.ndarray, penalty: float) -> np.ndarray:
    """Weights and a bias by Newton's method. ``times`` multiplies the inputs by them, ``turned`` the
    inputs' columns by a number for each row."""
    w, ridge = np.zeros(width + 1), np.full(width + 1, penalty)
    ridge[-1] = 1e-6
    for _ in range(25):
        p = _sigmoid(times(w))
        curve = p * (1 - p) + 1e-6
        step = _solved(lambda v: turned(curve * times(v)) + ridge * v, turned(goal - p) - ridge * w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _solved(product: Callable, goal: np.ndarray, most: int = 200) -> np.ndarray:
    """Conjugate gradients."""
    x, rest = np.zeros_like(goal), goal.copy()
    along, size = rest.copy(), rest @ rest
    least = 1e-16 * size
    for _ in range(most):
        if size <= least or not size:
            break
        image = product(along)
        far = size / (along @ image)
        x += far * along
        rest -= far * image
        size, before = rest @ rest, size
        along = rest + size / before * along
    return x


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """From doc_id and text, and doc_id and toxic."""
    spark = docs.sparkSession
    ship(spark)
    named = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    share = sample_rows / max(1, named.count())
    drawn = named.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1_000_003)) < share * 1_000_003)
    sample = drawn.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # bounded by ``sample_rows``
    rows = docs.join(F.broadcast(sample.withColumnRenamed("doc_id", "_id")), F.expr("doc_id = _id"))
    # Of rows of one id one stands for all, so that the sample keeps its bound.
    rows = rows.groupBy("doc_id").agg(F.min_by(F.struct("text"), F.xxhash64("text")).alias("_row"), F.max("toxic").alias("toxic")).select("doc_id", "_row.text", "toxic")
    size = sample.groupBy("toxic").count().collect()
    toxic = sum(r["count"] for r in size if r["toxic"])
    other = sum(r["count"] for r in size if not r["toxic"])
    if not toxic or not other:
        return None
    found = rows.mapInArrow(_mined, "feature long, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
    odds = F.log((F.col("a") + 0.5) / (F.lit(toxic + 0.5) - F.col("a"))) - F.log((F.col("b") + 0.5) / (F.lit(other + 0.5) - F.col("b")))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    tested = stage(found.filter((F.col("a") >= LEAST_ROWS) & (F.col("a") <= toxic) & (F.col("b") <= other)).withColumn("z", odds / error), "toxicity-features")
    least = NormalDist().inv_cdf(1 - 1 / max(10, tested.count()))
    best = tested.filter((F.col("z") > least) & (F.col("a") * other > 4 * F.col("b") * toxic)).select("feature")
    voters = np.unique(np.concatenate([lexicon_hashes(), np.array([r["feature"] for r in best.collect()], np.int64).view(np.uint64)]))
    found = rows.mapInArrow(_sampled(voters), "doc_id long, toxic int, voter binary, n binary, totals binary").orderBy("doc_id").collect()
    label = np.array([int(bool(r["toxic"])) for r in found])
    if not found or label.min() == label.max():
        return None
    voter, n = (np.concatenate([np.frombuffer(r[c], np.int32) for r in found]).astype(int) for c in ("voter", "n"))
    text = np.repeat(np.arange(len(found)), [len(r["voter"]) // 4 for r in found])
    return train(Votes(text, voter, n, np.stack([np.frombuffer(r["totals"]) for r in found])), label, voters)


def _scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        gate = gate_of(model.voters) if model else None
        for batch in batches:
            for piece in pieces(batch):
                score = np.zeros(piece.num_rows)
                if model:
                    score = _sigmoid(margins(counts_of(piece, model.voters, gate), model.weights, model.bias))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return run


def held_out(id_column: Column) -> Column:
    return is_remainder(id_column, 4, 2)


def score_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; learns from labels that are not held out."""
    ship(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(fit(docs, labels.filter(~held_out(F.col("doc_id")))))
    found = docs.mapInArrow(_scores(shared), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
