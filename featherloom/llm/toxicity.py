"""Toxicity: linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS = (4, 6, 8)
BITS = 20
CHUNK = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def gram_buckets(text: bytes) -> np.ndarray:
    """Bucket of every n-gram of the ASCII-lower-cased bytes, one order after the other (repeats included)."""
    b = _LOWER[np.frombuffer(text, np.uint8)].astype(np.uint32)
    out, n = [], len(b)
    code = b.copy()
    for order in range(2, max(ORDERS) + 1):
        if n < order:
            break
        code = code[:n - order + 1] * np.uint32(0x01000193) + b[order - 1:]
        if order in ORDERS:
            mixed = (code ^ (code >> np.uint32(15))) * np.uint32(0x9E3779B1) + np.uint32(order * 0x85EBCA6B & 0xFFFFFFFF)
            out.append((mixed ^ (mixed >> np.uint32(13))) >> np.uint32(32 - BITS) if BITS < 32 else mixed)
    return np.concatenate(out).astype(np.int32) if out else np.empty(0, np.int32)


class Distinct:
    """Distinct buckets of a text in linear time; long texts go through piece by piece."""

    def __init__(self) -> None:
        self.last = np.zeros(1 << BITS, np.int32)
        self.seen = np.zeros(1 << BITS, bool)

    def once(self, buckets: np.ndarray) -> np.ndarray:
        at = np.arange(len(buckets), dtype=np.int32)
        self.last[buckets] = at
        return buckets[self.last[buckets] == at]

    def __call__(self, text: bytes) -> np.ndarray:
        if len(text) <= CHUNK:
            return self.once(gram_buckets(text))
        self.seen[:] = False
        for i in range(0, len(text), CHUNK):
            self.seen[gram_buckets(text[i:i + CHUNK + max(ORDERS) - 1])] = True
        return np.flatnonzero(self.seen).astype(np.int32)


@dataclass
class Model:
    weight: np.ndarray  # per bucket: log-count ratio times fitted weight
    square: np.ndarray  # per bucket: squared log-count ratio
    bias: float

    def score(self, buckets: np.ndarray) -> float:
        norm = float(np.sqrt(self.square[buckets].sum(dtype=np.float64))) or 1.0
        z = float(self.weight[buckets].sum(dtype=np.float64)) / norm + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def fit_arrays(rows: list[np.ndarray], labels: np.ndarray, strength: float = 1e-5, steps: int = 120, smoothing: float = 1.0,
               least: int = 3) -> Model:
    """Logistic regression by accelerated gradient steps on distinct-bucket rows scaled by log-count ratios, each row of unit length.

    ``rows`` is used up, so that
    few copies live at once. Both labels weigh the same in all; buckets of fewer than ``least`` rows are left out. Without rows of both labels the model is the constant share of label 1, smoothed.
    """
    size, y = 1 << BITS, labels.astype(np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), prior)
    hits, bad = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for r, one in zip(rows, y):  # a row's buckets are distinct
        hits[r] += 1
        if one:
            bad[r] += 1
    ratio = np.log((smoothing + bad) / (smoothing + y.sum())) - np.log((smoothing + hits - bad) / (smoothing + len(y) - y.sum()))
    ratio[hits < least] = 0
    parts = []  # (buckets, where each row begins, the rows, their lengths in entries and as vectors), a bounded number of entries each
    held: list[tuple[int, np.ndarray]] = []
    for i in range(len(y)):
        r, rows[i] = rows[i][ratio[rows[i]] != 0], None
        if len(r):
            held.append((i, r))
        if held and (i == len(y) - 1 or sum(len(x) for _, x in held) >= CHUNK):
            flat, lens = np.concatenate([x for _, x in held]), np.array([len(x) for _, x in held])
            starts = np.cumsum(lens) - lens
            norm = np.sqrt(np.add.reduceat((ratio * ratio)[flat], starts))
            parts.append((flat, starts, np.array([k for k, _ in held]), lens, norm))
            held = []
    if not parts:
        return Model(np.zeros(size, np.float32), np.zeros(size, np.float32), prior)
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y).mean()) / len(y)

    def scores(w: np.ndarray, b: float) -> np.ndarray:
        z, scaled = np.full(len(y), b), w * ratio
        for flat, starts, at, _, norm in parts:
            z[at] += np.add.reduceat(scaled[flat], starts) / norm
        return z

    def back(g: np.ndarray) -> tuple[np.ndarray, float]:
        total = np.zeros(size)
        for flat, _, at, lens, norm in parts:
            total += np.bincount(flat, np.repeat(g[at] / norm, lens), size)
        return (total * ratio).astype(np.float32), float(g.sum())

    # the loss curves by at most a quarter of the balanced rows' largest eigenvalue, found by power iteration
    w, b = hits.astype(np.float32), 1.0
    for _ in range(8):
        length = float(np.sqrt((w * w).sum(dtype=np.float64) + b * b))
        w, b = back(balance * scores(w / np.float32(length), b / length) / 4)
    rate = 1 / (1.2 * float(np.sqrt((w * w).sum(dtype=np.float64) + b * b)) + strength)
    w, b = np.zeros(size, np.float32), 0.0
    look_w, look_b, momentum = w, b, 1.0
    for _ in range(steps):
        grad_w, grad_b = back(balance * (1 / (1 + np.exp(-scores(look_w, look_b))) - y))
        new_w, new_b = look_w - np.float32(rate) * (grad_w + np.float32(strength) * look_w), look_b - rate * grad_b
        old, momentum = momentum, (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        push = np.float32((old - 1) / momentum)
        look_w, look_b = new_w + push * (new_w - w), new_b + float(push) * (new_b - b)
        w, b = new_w, new_b
    return Model((w * ratio).astype(np.float32), (ratio ** 2).astype(np.float32), float(b))


def is_held_out(doc_id: Column) -> Column:
    """Rows never learned from: a fifth, by CRC-32 of the id's text (null id: empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = 4000, **options) -> Model:
    """Model fitted on at most ``sample_rows`` labelled rows outside the held-out fifth, chosen by a hash of doc_id.

    ``docs``: doc_id, text; ``labels``: doc_id and ``label`` (0 or 1; null labels and ids are left out, of several labels the largest
    counts). Features are made where the texts are; the bounded sample meets in one task, only the model comes to the driver.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).cast("double").alias("y"))
    # at most sample_rows ids and labels: a proven bound for the broadcast
    chosen = F.broadcast(known.orderBy(F.xxhash64(F.lit(5), "__id"), "__id").limit(sample_rows))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(chosen, F.col("doc_id") == F.col("__id")).select("doc_id", "text", "y")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distinct = Distinct()
        for b in batches:
            made = [distinct(t.encode()).tobytes() for t in b.column("text").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "y": b.column("y"), "x": pa.array(made, pa.binary())})

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(i, y, np.frombuffer(x, np.int32)) for b in batches for i, y, x in zip(*(b.column(c).to_pylist() for c in ("doc_id", "y", "x")))]
        got.sort(key=lambda r: r[0])
        rows, labels_ = [r[2] for r in got], np.array([r[1] for r in got])
        del got
        m = fit_arrays(rows, labels_, **options)
        yield pa.record_batch({"weight": pa.array([m.weight.tobytes()], pa.binary()), "square": pa.array([m.square.tobytes()], pa.binary()),
                               "bias": pa.array([m.bias])})

    kind = dict(docs.dtypes)["doc_id"]
    one = rows.mapInArrow(features, f"doc_id {kind}, y double, x binary").repartition(1).mapInArrow(train, "weight binary, square binary, bias double")
    got = one.first()
    return Model(np.frombuffer(got["weight"], np.float32), np.frombuffer(got["square"], np.float32), got["bias"]) if got else Model(
        np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (score >= 0.5), of the whole text; null texts are empty.

    A text without n-grams gets the model's bias. Input columns named like the added ones are replaced. Very long texts are read piece by
    piece, so memory per row stays bounded.
    """
    given = docs.drop("score", "predicted")
    names = [*given.columns, "score", "predicted"]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of 2 ** BITS floats, whatever the input

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, distinct = shared.value, Distinct()
        for b in batches:
            s = np.array([m.score(distinct((t or "").encode())) for t in b.column(text).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)

    fields = [*given.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return given.mapInArrow(add, T.StructType(fields))
