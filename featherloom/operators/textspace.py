"""TF-IDF over a bounded vocabulary and its leading components, without a terms x terms matrix.

The driver holds the vocabulary (``terms`` words) and ``terms`` x (block x steps) numbers of the basis; tasks get ``terms`` x block
of them. Both are bounded by parameters, not by the rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featherloom.session import materialize

WORD = re.compile(r"\w{2,}")
_SLICE = 1 << 20  # entries multiplied at once
_BLOCK = 1000  # terms in one row of partial sums
_BUCKETS = 1 << 20  # hashed counts that bound every gram's count from above
_HELD = 1 << 17  # grams counted in a task's memory at a time
_LIKELY = 4  # candidates for each term of the vocabulary: the more, the closer the bound


def _words(b: pa.RecordBatch, stop: frozenset[str]) -> Iterator[list[str]]:
    """Words of two or more characters without the stop words, text by text; neighbours among them are the pairs."""
    for text in b.column(b.schema.get_field_index("__text")):
        yield [w for w in WORD.findall(text.as_py() or "") if w not in stop]


class _Known:
    """Finds known words and pairs among words, exactly, by numbers."""

    def __init__(self, terms: list[str]):
        parts = [t.split(" ") for t in terms]
        self.ids = {w: i for i, w in enumerate(sorted({w for p in parts for w in p}))}
        n = len(self.ids)
        keys = np.array([self.ids[p[0]] if len(p) == 1 else (self.ids[p[0]] + 1) * n + self.ids[p[1]] for p in parts], dtype=np.int64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def find(self, words: list[str]) -> np.ndarray:
        """The number of every known gram that occurs, once per occurrence."""
        ids = np.array(list(map(self.ids.get, words, repeat(-1))), dtype=np.int64)
        a, b = ids[:-1], ids[1:]
        keys = np.concatenate([ids[ids >= 0], ((a + 1) * len(self.ids) + b)[(a >= 0) & (b >= 0)]])
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return self.order[at[self.keys[at] == keys]]


class _Digests(dict):
    """A number for every word, kept for the words a task meets again."""

    def __missing__(self, word: str) -> int:
        if len(self) > _HELD:
            self.clear()
        self[word] = number = zlib.crc32(word.encode())
        return number


def _buckets(words: list[str], digests: _Digests) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the words and of the pairs."""
    h = np.array(list(map(digests.__getitem__, words)), dtype=np.uint64)
    pairs = h[:-1] * np.uint64(0x9E3779B1) + h[1:]
    return (h % np.uint64(_BUCKETS)).astype(np.int64), ((pairs ^ (pairs >> np.uint64(29))) % np.uint64(_BUCKETS)).astype(np.int64)


def _prepared(df: DataFrame, text: str, *others: str) -> DataFrame:
    return df.select(*others, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("__text"))


def _candidates(texts: DataFrame, stop: frozenset[str], terms: int) -> list[str]:
    """Likely frequent grams: every task counts until it holds ``_HELD`` different ones. They only serve to find a bound."""
    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for b in batches:
            for w in _words(b, stop) if len(n) < _HELD else ():
                n.update(w)
                n.update(map(" ".join, zip(w, w[1:])))
                if len(n) >= _HELD:
                    break
        top = n.most_common(terms)
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in top], pa.string()), pa.array([c for _, c in top], pa.int64())], names=["term", "n"])

    found = texts.mapInArrow(some, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return [r["term"] for r in found.orderBy(F.desc("n"), "term").limit(terms).collect()]


def _block_sums(parts: DataFrame, size: int) -> np.ndarray:
    """Elementwise sum of arrays that tasks hand on in blocks (block, part)."""
    sums = parts.groupBy("block").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part")).collect()
    return np.concatenate([np.array(r["part"]) for r in sorted(sums, key=lambda r: r["block"])]) if sums else np.zeros(size)


def _blocks(total: np.ndarray, size: int) -> pa.RecordBatch:
    parts = [total[s:s + size] for s in range(0, len(total), size)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], names=["block", "part"])


def vocabulary(df: DataFrame, text: str, stop_words: list[str], terms: int = 10_000) -> DataFrame:
    """The ``terms`` most frequent words and pairs: term, n (occurrences), docs (rows that hold it). Exact; ties go to the smaller term.

    The first pass counts likely terms exactly and all grams in hashed buckets. The ``terms``-th largest exact count is a lower bound for
    the vocabulary, a bucket's count an upper bound for its grams, so the second pass counts and shuffles only grams whose bucket reaches it.
    """
    stop, texts = frozenset(stop_words), _prepared(df, text)
    context = df.sparkSession.sparkContext
    likely = _candidates(texts, stop, _LIKELY * terms)
    shared = context.broadcast(_Known(likely) if likely else None)
    size = len(likely)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known, digests, met, n = np.zeros(size + _BUCKETS), shared.value, _Digests(), [], 0

        def add() -> None:
            total[:] += np.bincount(np.concatenate(met), minlength=len(total))
            met.clear()

        for b in batches:
            for w in _words(b, stop):
                met += [known.find(w), *[size + h for h in _buckets(w, digests)]] if known else []
                n += len(w)
                if n > _SLICE:
                    add()
                    n = 0
        if met:
            add()
        yield _blocks(total, 1 << 16)

    total = _block_sums(texts.mapInArrow(bounds, "block int, part array<double>"), size + _BUCKETS)
    least = sorted(total[:size])[-terms] if size >= terms else 0
    open_buckets = context.broadcast(np.packbits(total[size:] >= max(least, 1)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, digests = np.unpackbits(open_buckets.value).astype(bool), _Digests()
        n: dict[str, list[int]] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([c[0] for c in n.values()], pa.int64()),
                                              pa.array([c[1] for c in n.values()], pa.int64())], names=["term", "n", "docs"])
            n.clear()
            return out

        for b in batches:
            for w in _words(b, stop):
                one, two = _buckets(w, digests)
                grams = Counter([w[i] for i in np.flatnonzero(keep[one])])
                grams.update([f"{w[i]} {w[i + 1]}" for i in np.flatnonzero(keep[two])])
                for g, c in grams.items():
                    entry = n.setdefault(g, [0, 0])
                    entry[0] += c
                    entry[1] += 1
                if len(n) >= _HELD:
                    yield rows()
        yield rows()

    counts = texts.mapInArrow(counted, "term string, n long, docs long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts.orderBy(F.desc("n"), "term").limit(terms)


def counted(df: DataFrame, key: str, text: str, terms: list[str], stop_words: list[str]) -> DataFrame:
    """Rows (key, at, n): the numbers of the known grams in the text, ascending, and how often each occurs."""
    shared, stop = df.sparkSession.sparkContext.broadcast(_Known(terms)), frozenset(stop_words)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            found = [np.unique(known.find(w), return_counts=True) for w in _words(b, stop)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(key)), pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                                              pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32()))], names=[key, "at", "n"])

    return _prepared(df, text, key).mapInArrow(vectors, f"{df.select(key).schema.simpleString()[7:-1]}, at array<int>, n array<int>")


def _entries(b: pa.RecordBatch, weight: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of a batch with at most ``_SLICE`` entries (or one row): rows, row of each entry, place, value.

    Values are counts times the terms' weights, scaled to rows of length 1.
    """
    at, count = b.column(b.schema.get_field_index("at")), b.column(b.schema.get_field_index("n"))
    size = at.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    i, c = at.flatten().to_numpy(zero_copy_only=False), count.flatten().to_numpy(zero_copy_only=False)
    lo = 0
    while lo < len(size):
        start = ends[lo] - size[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, start + _SLICE, side="right")))
        cut, rows = slice(start, ends[hi - 1]), np.repeat(np.arange(hi - lo), size[lo:hi])
        v = c[cut] * weight[i[cut]]
        norm = np.sqrt(np.bincount(rows, v * v, minlength=hi - lo))
        yield hi - lo, rows, i[cut], v / norm[rows]
        lo = hi


def _times(rows: np.ndarray, i: np.ndarray, v: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(rows, v * q[i, j], minlength=n) for j in range(q.shape[1])], axis=1)


def _summed(df: DataFrame, weight: Broadcast, width: int, add) -> np.ndarray:
    """Sum over all rows of ``add(total, rows, at, value, n)``, a terms x ``width`` matrix; tasks hand on one row per 1000 terms."""
    terms = len(weight.value)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width))
        for b in batches:
            for n, rows, i, v in _entries(b, weight.value):
                add(total, rows, i, v, n)
        yield _blocks(total.ravel(), _BLOCK * width)

    return _block_sums(df.select("at", "n").mapInArrow(partial, "block int, part array<double>"), terms * width).reshape(terms, width)


@dataclass
class Components:
    """Leading components of centred sparse rows: term weights, loadings (terms x k), column means, singular values, passes over the rows."""

    weight: np.ndarray
    loadings: np.ndarray
    mean: np.ndarray
    singular: np.ndarray
    passes: int


def leading_components(df: DataFrame, weight: np.ndarray, k: int, rows: int, extra: int = 4, steps: int = 40, tolerance: float = 1e-8, seed: int = 1) -> Components:
    """The ``k`` leading principal components of the sparse rows (``at``, ``n``, as :func:`counted` gives them) by block Lanczos iteration.

    Every step multiplies rows'rows with ``k + extra`` vectors in one pass; the basis keeps all blocks, so flat spectra converge too.
    Ends when every wanted pair has a residual below ``tolerance`` of the largest eigenvalue, or after ``steps`` steps.
    """
    terms, shared = len(weight), df.sparkSession.sparkContext.broadcast(weight)
    width = min(k + extra, terms)
    mean = _summed(df, shared, 1, lambda t, r, i, v, n: t.__iadd__(np.bincount(i, v, minlength=terms)[:, None]))[:, 0] / max(rows, 1)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((terms, width)))[0]
    basis, products = np.zeros((terms, 0)), np.zeros((terms, 0))
    for step in range(steps):
        def add(total, r, i, v, n, q=q):
            z = _times(r, i, v, n, q)
            for j in range(q.shape[1]):
                total[:, j] += np.bincount(i, v * z[r, j], minlength=terms)

        y = _summed(df, shared, q.shape[1], add) - rows * np.outer(mean, mean @ q)
        basis, products = np.hstack([basis, q]), np.hstack([products, y])
        small = basis.T @ products
        value, vector = np.linalg.eigh((small + small.T) / 2)
        value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
        v = basis @ vector
        residual = np.linalg.norm(products @ vector - v * value, axis=0)
        if np.all(residual <= tolerance * max(value[0], 1e-300)):
            break
        for _ in range(2):  # twice, as once leaves rounding errors in the old directions
            y = y - basis @ (basis.T @ y)
        left, size, _ = np.linalg.svd(y, full_matrices=False)
        q = left[:, size > 1e-12 * max(value[0], 1e-300)][:, :terms - basis.shape[1]]
        if q.shape[1] == 0:
            break
    signs = np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return Components(weight, v * np.where(signs == 0, 1, signs), mean, np.sqrt(np.maximum(value, 0)), step + 2)


def scores(df: DataFrame, found: Components, out: str = "components") -> DataFrame:
    """Rows with their values on the components instead of the sparse vector."""
    others = [c for c in df.columns if c not in ("at", "n")]
    shared = df.sparkSession.sparkContext.broadcast((found.weight, found.loadings, found.mean @ found.loadings))
    schema = f"{df.select(*others).schema.simpleString()[7:-1]}, {out}:array<double>"

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, loadings, shift = shared.value
        for b in batches:
            z = [row for n, rows, i, v in _entries(b, weight) for row in _times(rows, i, v, n, loadings) - shift]
            kept = [b.column(b.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(z, pa.list_(pa.float64()))], names=[*others, out])

    return df.mapInArrow(project, schema)


def text_components(df: DataFrame, key: str, text: str, k: int, stop_words: list[str], terms: int = 10_000) -> tuple[DataFrame, Components]:
    """Components of the TF-IDF vectors of words and pairs: rows (key, components) and what was found.

    Weights are log((1 + rows) / (1 + docs)) + 1, vectors have length 1. A row without a known gram is the zero vector.
    """
    known = vocabulary(df, text, stop_words, terms).collect()  # at most ``terms`` rows
    if not known:
        empty = Components(np.zeros(0), np.zeros((0, k)), np.zeros(0), np.zeros(k), 0)
        return df.select(key, F.array_repeat(F.lit(0.0), k).alias("components")), empty
    rows = materialize(counted(df, key, text, [r["term"] for r in known], stop_words), "vectors")
    n = rows.count()
    weight = np.log((1 + n) / (1 + np.array([r["docs"] for r in known]))) + 1
    found = leading_components(rows, weight, min(k, len(known)), n)
    return scores(rows, found), found
