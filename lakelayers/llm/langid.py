"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its letter bigrams and trigrams (words in lower case, one
space around each), hashed to ``BUCKETS`` rows. Embeddings and softmax are trained by stochastic
gradient descent in numpy on a sample of about ``SAMPLE_DOCS`` labelled rows at most, the same number
of each language and one of each id; what is collected of a row is its bucket counts. A temperature, fitted on a fifth
of the sample, calibrates the probabilities; a text is rejected below a probability that
all but ``REJECT_SHARE`` of the rightly labelled rows of that fifth exceed.

Prediction reads whole texts and nothing else. Embeddings times softmax weights is one number for
each bucket and language, which the tasks get.

Defined cases: texts that are null or have no letter are ``und``, score 0, rejected. Without labelled
rows every text is. Of languages that tie the first in order of name counts. Repeated rows are judged one
by one. A text of over ``PIECE_BYTES`` is read in parts, between words, and has the counts of all of them.
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
from lakelayers.llm.words import is_long, long_parts, pieces, with_text

BUCKETS = 8192
DIM = 16
SAMPLE_DOCS = 3000
EPOCHS = 12
BATCH = 32
RATE = 2.0
REJECT_SHARE = 0.001
UNKNOWN = "und"

_letters: list[np.ndarray] = []


class Model(NamedTuple):
    langs: list[str]
    scores: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float
    least: float  # a smaller probability is a rejection


def is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(0x11_0000)]))
    return _letters[0][points]


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all texts, and the bounds of each text's."""
    lowered = [f" {(x or '').lower()} " for x in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lowered])])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(is_letter(points), points, np.uint32(32))
    double = np.zeros(len(points), bool)
    double[1:] = (points[1:] == 32) & (points[:-1] == 32)
    double[bounds[:-1]] = False
    points = points[~double]
    bounds = bounds - np.concatenate([[0], np.cumsum(double)])[bounds]
    wide = points.astype(np.uint32)
    two = (wide[:-1] * np.uint32(0x9E3779B1)) ^ (wide[1:] * np.uint32(0x85EBCA77))
    three = (two[:-1] * np.uint32(0xC2B2AE3D)) ^ (wide[2:] * np.uint32(0x27D4EB2F))
    n = len(points)
    found, owner_ok = np.zeros((n, 2), np.uint32), np.zeros((n, 2), bool)
    end = np.repeat(bounds[1:], np.diff(bounds))
    found[: n - 1, 0], found[: n - 2, 1] = two, three
    at = np.arange(n)
    owner_ok[:, 0] = (at + 1 < end) & (np.roll(points, -1) != 32)  # a pair that ends in a letter
    owner_ok[:, 1] = (at + 2 < end) & (np.roll(points, -1) != 32)  # a letter in the middle
    buckets = (found * np.uint32(0x2C1B3C6D) >> np.uint32(32 - int(np.log2(BUCKETS)))).ravel()
    counts = np.concatenate([[0], np.cumsum(owner_ok.sum(axis=1))])
    return buckets[owner_ok.ravel()], counts[bounds]


def bucket_counts(column: pa.Array, limit: int | None = None) -> np.ndarray:
    """How often a single text has each bucket, read in parts of ``limit`` bytes."""
    total = np.zeros(BUCKETS, np.int64)
    for _, part in long_parts(column, 0, *([limit] if limit else [])):
        total += np.bincount(subwords(part.to_pylist())[0], minlength=BUCKETS)
    return total


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(piece: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if is_long(piece):
            total = bucket_counts(piece.column("text"))
            yield np.flatnonzero(total), total[total > 0]
            return
        buckets, bounds = subwords(piece.column("text").to_pylist())
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(buckets[a:b], return_counts=True)

    for batch in batches:
        for piece in pieces(batch):
            rows = [(kinds.astype(np.uint16).tobytes(), (n / max(1, n.sum())).astype(np.float32).tobytes()) for kinds, n in counted(piece)]
            columns = [piece.column("lang"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "buckets", "weights"])


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """From doc_id, text, lang; rows of null lang are left out."""
    ship(labelled.sparkSession)
    named = labelled.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}  # one row a language
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    share = F.lit(1.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / len(langs) / sizes[lang])).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_003)) < share * 1_000_003
    # Rows of one id are drawn together: one of them stands for all, so that the sample keeps its bound.
    one = named.filter(drawn).groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = one.select("lang", "text").mapInArrow(_features, "lang string, buckets binary, weights binary").collect()
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, row in enumerate(rows):
        x[i, np.frombuffer(row["buckets"], np.uint16)] = np.frombuffer(row["weights"], np.float32)
    number = {lang: i for i, lang in enumerate(langs)}
    y = np.array([number[r["lang"]] for r in rows], int)
    # The rows come in any order; sorting makes the model a function of the table.
    order = np.lexsort((x.sum(axis=1), x @ np.arange(BUCKETS, dtype=np.float32), y)) if len(rows) else np.zeros(0, int)
    return _train(x[order], y[order], langs)


def _train(x: np.ndarray, y: np.ndarray, langs: list[str]) -> Model:
    rng = np.random.default_rng(11)
    shuffled = rng.permutation(len(x))
    check, learn = shuffled[: len(x) // 5], shuffled[len(x) // 5 :]
    e = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    x *= 10  # the mean of many small numbers, brought to the size of one embedding
    steps = EPOCHS * max(1, len(learn) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(learn)
        for at in range(0, len(learn), BATCH):
            rate = RATE * (1 - min(step, steps) / (steps + 1)) / BATCH
            part, goal = x[learn[at : at + BATCH]], y[learn[at : at + BATCH]]
            hidden = part @ e
            error = _softmax(hidden @ w + bias)
            error[np.arange(len(goal)), goal] -= 1
            back = error @ w.T
            w -= rate * (hidden.T @ error)
            bias -= rate * error.sum(axis=0)
            used = np.flatnonzero(part.any(axis=0))
            e[used] -= rate * (part[:, used].T @ back)
            step += 1
    logits = x[check] @ e @ w + bias
    temperature, least = 1.0, 0.0
    if len(check):
        grid = np.geomspace(0.05, 20, 60)
        losses = [-np.log(_softmax(logits / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(losses))])
        sure = _softmax(logits / temperature)
        right = sure.argmax(axis=1) == y[check]
        if right.any():
            least = float(min(0.5, np.quantile(sure.max(axis=1)[right], REJECT_SHARE)))
    return Model(langs, (10 * e @ w).astype(np.float32), bias, temperature, least)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _predict(shared, field: str | None):
    """``field``: where in the column row the text stands, if rows are carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for piece in pieces(with_text(batch, field)):
                if is_long(piece):
                    total = bucket_counts(piece.column("text"))
                    counts = np.array([total.sum()])
                else:
                    total = None
                    buckets, bounds = subwords(piece.column("text").to_pylist())
                    counts = np.diff(bounds)
                known = (counts > 0) & bool(model.langs)
                lang, score = np.full(len(counts), UNKNOWN, object), np.zeros(len(counts))
                if known.any():
                    if total is not None:
                        sums = total[None] @ model.scores.astype(np.float64)
                    else:
                        starts = bounds[:-1][known]
                        sums = np.stack([np.add.reduceat(column[buckets].astype(np.float64), starts) for column in model.scores.T], axis=1)
                    chance = _softmax((sums / counts[known][:, None] + model.bias) / model.temperature)
                    lang[known] = np.array(model.langs, object)[chance.argmax(axis=1)]
                    score[known] = chance.max(axis=1)
                rest = [piece.column(c) for c in piece.schema.names if c != "text"]
                names = [c for c in piece.schema.names if c != "text"]
                columns = [*rest, pa.array(lang.tolist(), pa.string()), pa.array(score), pa.array(~known | (score < model.least))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score", "rejected"])

    return run


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row; ``with_rows`` adds row, a struct of all
    columns."""
    ship(df.sparkSession)
    text = F.struct(*[df[c] for c in df.columns]).alias("row") if with_rows else F.col(text_col).alias("text")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text)
    kinds = docs.drop("text").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    shared = df.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(shared, text_col if with_rows else None), kinds)


def held_out(id_column: Column) -> Column:
    return is_remainder(id_column, 5, 0)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learns from the rows that are not held out."""
    labelled = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = fit(labelled.filter(~held_out(F.col("doc_id"))))
    found = predict(df, model, id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame) -> DataFrame:
    """Documents whose language is recognised, in the columns of ``docs``."""
    labelled = docs.select("doc_id", "text", "lang")
    found = predict(docs, fit(labelled.filter(~held_out(F.col("doc_id")))), with_rows=True)
    return found.filter("not rejected").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
