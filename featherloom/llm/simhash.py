"""SimHash near-duplicates through an embedding of fingerprints into bit counts per segment."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.llm.common import partitions
from featherloom.llm.components import star_roots
from featherloom.session import materialize

SHINGLE, SEED, DISTANCE = 4, 42, 4
GROUPS = 8  # of 4 segments of 2 bits each
_STEP = 1 << 15


def fingerprint(text: bytes) -> int:
    """Unsigned 64-bit SimHash: a bit is set if it is set in over half of the shingles' XXH64. No words: 0."""
    words = text.lower().split()  # bytes: only A-Z change, and only space and 0x09 to 0x0D split
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1, out=starts[1:])
    digest, m = xxhash.xxh64_intdigest, n - SHINGLE + 1
    ones = np.zeros(64, np.int64)
    for i in range(0, m, _STEP):
        j = min(i + _STEP, m)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:j].tolist(), (starts[i + SHINGLE:j + SHINGLE] - 1).tolist())], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without ``text`` plus ``fp``, the fingerprint of the whole text as a signed long; null texts have no words."""
    fields = [f for f in docs.schema.fields if f.name not in (text, "fp")]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint((t or "").encode()) for t in b.column(text).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(fp)], names=[*names, "fp"])

    return docs.mapInArrow(run, T.StructType([*fields, T.StructField("fp", T.LongType())]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embed(fp: Column) -> Column:
    """The 32 bit counts (0 to 2) of the 2-bit segments, two bits each, in one long."""
    other, odd = F.shiftrightunsigned(fp, 1), F.lit(0x5555555555555555)
    return fp.bitwiseXOR(other).bitwiseAND(odd).bitwiseOR(F.shiftleft(fp.bitwiseAND(other).bitwiseAND(odd), 1))


def embed_words(fp: np.ndarray) -> np.ndarray:
    return fp - ((fp >> np.uint64(1)) & np.uint64(0x5555555555555555))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of embedded words: the sum over segments of the difference of counts."""
    low = np.uint64(0x3333333333333333)
    total = np.zeros(len(a), np.int64)
    for shift in (np.uint64(0), np.uint64(2)):
        x, y = ((a >> shift) & low).view(np.int8).reshape(-1, 8), ((b >> shift) & low).view(np.int8).reshape(-1, 8)
        total += (np.abs((x & 15) - (y & 15)) + np.abs((x >> 4) - (y >> 4))).sum(axis=1, dtype=np.int64)
    return total


def cell_masks() -> list[int]:
    """One mask of the embedded word per choice of GROUPS - DISTANCE of the groups."""
    width = 64 // GROUPS
    group = [((1 << width) - 1) << (width * g) for g in range(GROUPS)]
    return [_signed(sum(group[g] for g in s)) for s in itertools.combinations(range(GROUPS), GROUPS - DISTANCE)]


def _spanning(fp: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, run by run, all fingerprints at most DISTANCE apart; ``run`` numbers the rows' cells in order."""
    v, n = embed_words(fp), len(fp)
    near, rows = [], np.arange(len(fp))
    for k in range(1, n):
        rows = rows[:np.searchsorted(rows, n - k)]
        rows = rows[run[rows] == run[rows + k]]
        if not len(rows):
            break
        at = rows[manhattan(v[rows], v[rows + k]) <= DISTANCE]  # a lower bound, so no true link is lost
        at = at[np.bitwise_count(fp[at] ^ fp[at + k]) <= DISTANCE]
        near.append(np.stack([at, at + k]))
    i, j = np.concatenate(near, axis=1) if near else np.empty((2, 0), np.int64)
    label = np.arange(n)
    while len(i):
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == old).all():
            break
    other = np.flatnonzero(label != np.arange(n))
    return fp[label[other]], fp[other]


def _batch(kind: int, cell: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"kind": pa.array(np.full(len(a), kind, np.int32)), "s": pa.array(cell.astype(np.int32)), "key": pa.array(key.view(np.int64)),
                            "a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


LINK, OPEN, HOT = 0, 1, 2


def _cells(rows: DataFrame, most: int, closed: bool) -> DataFrame:
    """Links (kind LINK: a, b) inside cells of rows (s, key, fp) sorted by cell within partitions.

    Cells of more than ``most`` rows give their members as HOT. Unless ``closed``, the first and the last cell of a partition may go on
    in another one and give their rows as OPEN. A task holds one batch and the rows of one unfinished cell, ``most`` at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.uint64)
        held = (np.empty(0, np.int32), empty, empty)  # the unfinished last cell
        first: tuple | None = None
        flowing = None  # the cell whose rows go out as they come, because it is too long to hold, with the kind they get

        def finish(s: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            start = np.flatnonzero(np.r_[True, (s[1:] != s[:-1]) | (key[1:] != key[:-1])])
            size = np.diff(np.r_[start, len(s)])
            number = np.repeat(np.arange(len(start)), size)
            big = (size > most)[number]
            if big.any():
                yield _batch(HOT, s[big], key[big], fp[big], fp[big])
            small = (~big) & (size > 1)[number]
            if small.any():
                a, b = _spanning(fp[small], number[small])
                if len(a):
                    yield _batch(LINK, np.zeros(len(a)), a, a, b)

        for batch in batches:
            if not batch.num_rows:
                continue
            s, key, fp = (batch.column(c).to_numpy() for c in ("s", "key", "fp"))
            s, key, fp = (np.r_[h, x] for h, x in zip(held, (s, key.view(np.uint64), fp.view(np.uint64))))
            if first is None:
                first = (s[0], key[0])
            if flowing:
                cut = int(np.argmax(np.r_[(s != flowing[0]) | (key != flowing[1]), True]))
                if cut:
                    yield _batch(flowing[2], s[:cut], key[:cut], fp[:cut], fp[:cut])
                s, key, fp = s[cut:], key[cut:], fp[cut:]
                if not len(s):
                    held = (s, key, fp)
                    continue
                flowing = None
            if not closed and (s[0], key[0]) == first:
                cut = int(np.argmax(np.r_[(s != s[0]) | (key != key[0]), True]))
                yield _batch(OPEN, s[:cut], key[:cut], fp[:cut], fp[:cut])
                if cut == len(s):
                    flowing, held = (*first, OPEN), (s[:0], key[:0], fp[:0])
                    continue
                s, key, fp = s[cut:], key[cut:], fp[cut:]
            last = int(np.argmax((s == s[-1]) & (key == key[-1])))
            yield from finish(s[:last], key[:last], fp[:last]) if last else ()
            s, key, fp = s[last:], key[last:], fp[last:]
            if closed and len(s) > most:
                yield _batch(HOT, s, key, fp, fp)
                flowing, s, key, fp = (s[0], key[0], HOT), s[:0], key[:0], fp[:0]
            elif not closed and len(s) > most:
                yield _batch(OPEN, s, key, fp, fp)
                flowing, s, key, fp = (s[0], key[0], OPEN), s[:0], key[:0], fp[:0]
            held = (s, key, fp)
        if len(held[0]):
            if closed:
                yield from finish(*held)
            else:
                yield _batch(OPEN, held[0], held[1], held[2], held[2])

    return rows.select("s", "key", "fp").mapInArrow(run, "kind int, s int, key long, a long, b long")


def links(known: DataFrame, most: int = 1024) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``known`` (fp) that connect all pairs at most DISTANCE bits apart.

    Not every pair is written, but every pair ends in one component. Embedding: the bit counts of 32 segments; the Manhattan distance of
    two count vectors never exceeds the Hamming distance. Grid join: a cell is a choice of half of the eight segment groups with the
    counts found there. Vectors within Manhattan distance 4 differ in at most four groups, so they share a cell of at least one choice,
    which stands in for searching neighbouring cells. Inside a cell, rows pass the Manhattan bound and then the exact distance.

    Cells are dealt by ranges, so a huge cell is cut over tasks. A cell at the rim of a range is finished in a second step. Members of
    cells with more than ``most`` fingerprints are linked through midpoints instead: fingerprints at most 4 apart have one that is at
    most 2 from both, so all 2081 words within 2 bits of each are listed and equal ones linked, which is linear in the members, and a
    midpoint has at most 2081 of them.
    """
    masks = F.array(*[F.lit(m) for m in cell_masks()])
    v = embed(F.col("fp"))
    cells = known.select("fp", v.alias("v")).select("fp", "v", F.posexplode(masks).alias("s", "m")).select(
        "s", F.col("v").bitwiseAND(F.col("m")).alias("key"), "fp")
    n = partitions(known.sparkSession)
    dealt = cells.repartitionByRange(n, "s", "key", "fp").sortWithinPartitions("s", "key", "fp")
    found = materialize(_cells(dealt, most, closed=False), "cells")
    rim = found.where(F.col("kind") == OPEN).select("s", "key", F.col("a").alias("fp"))
    size = rim.groupBy(F.col("s").alias("__s"), F.col("key").alias("__k")).agg(F.count("*").alias("n"))
    rim = rim.join(size, (F.col("s") == F.col("__s")) & (F.col("key") == F.col("__k")))
    closed = _cells(rim.where(F.col("n").between(2, most)).repartition("s", "key").sortWithinPartitions("s", "key", "fp"), most, closed=True)
    hot = found.where(F.col("kind") == HOT).select(F.col("a").alias("fp")).unionByName(rim.where(F.col("n") > most).select("fp")).distinct()
    ball = [0, *[1 << i for i in range(64)], *[(1 << i) | (1 << j) for i, j in itertools.combinations(range(64), 2)]]
    words = F.array(*[F.lit(_signed(x)) for x in ball])
    middles = hot.select("fp", F.explode(words).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("mid"))
    stars = middles.groupBy("mid").agg(F.collect_list("fp").alias("f")).where(F.size("f") > 1).select(
        F.array_min("f").alias("a"), F.explode("f").alias("b"))
    return found.where(F.col("kind") == LINK).select("a", "b").unionByName(closed.where(F.col("kind") == LINK).select("a", "b")).unionByName(
        stars.where("a <> b")).distinct()


def components(rows: DataFrame, most: int = 1024) -> DataFrame:
    """``rows`` (id, fp) plus ``component``: the smallest id that chains of links between fingerprints reach, the row's own included.

    Rows of equal fingerprints are one node, so copies cost no links. Null ids count only where a component has no other.
    """
    nodes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = star_roots(links(nodes.select("fp"), most))
    member = roots.unionByName(roots.select("root").distinct().select(F.col("root").alias("node"), "root"))
    own = member.join(nodes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("least").alias("cid"))
    named = materialize(member.join(own, "root").select("node", "cid"), "members")
    labels = nodes.join(named, F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("__fp"), F.coalesce("cid", "least").alias("component"))
    return rows.join(labels, F.col("fp") == F.col("__fp")).drop("__fp")


def near_duplicates(docs: DataFrame, most: int = 1024) -> DataFrame:
    """doc_id, fp and component (smallest doc_id reachable) for every row of ``docs`` (doc_id, text).

    Null and wordless texts have fingerprint 0 and are linked like any other; repeated rows stay; an empty table gives none.
    """
    rows = materialize(fingerprints(docs.select(F.col("doc_id").alias("id"), "text")), "fingerprints")
    return components(rows, most).withColumnRenamed("id", "doc_id")


def deduplicated(docs: DataFrame, most: int = 1024) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest doc_id (null last, then any one of equal ids)."""
    held = materialize(docs.withColumn("__rid", F.monotonically_increasing_id()), "to-deduplicate")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col("__rid").alias("rid"))
    rows = materialize(fingerprints(held.select(key.alias("id"), "text")), "fingerprints")
    stay = components(rows, most).where(F.col("id") == F.col("component")).select(F.col("id.rid").alias("__stay"))
    return held.join(stay, F.col("__rid") == F.col("__stay"), "left_semi").select(*docs.columns)
