"""Leading eigenvectors of a graph's normalised adjacency matrix, with one exchange of node values per step.

Nodes are dealt into blocks. A block keeps its nodes' vectors and its columns of the matrix, packed as arrays; a step sends each block
the sums that the others hold for its nodes, one message per pair of blocks. The driver sees sums over all nodes only (matrices of at
most 3 x block columns).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featherloom.operators.splits import hash_uniform
from featherloom.session import discard, materialize, scratch_path

BLOCK_NODES = 1 << 16  # nodes of a block: 22 MB of vectors at seven columns
LEAST_NODES = 1 << 13  # smaller blocks are not worth a task
CUT = 10  # steps after which the vectors are written, so that older ones and their shuffle files can go


def normalised(edges: DataFrame, block_nodes: int = BLOCK_NODES) -> tuple[DataFrame, DataFrame, int]:
    """Undirected weighted edges (src, dst, weight) as symmetric entries with w = weight / sqrt(degree x degree), the nodes, the number of blocks.

    Nodes (id, degree, block, slot) are numbered within blocks; entries are (db, ds, sb, ss, w), the places of both ends. Repeated edges
    add up. Edges without a positive weight are left out.
    """
    both = edges.where("weight > 0").select(F.inline(F.when(F.col("src") == F.col("dst"), F.array(F.struct("src", "dst", "weight"))).otherwise(
        F.array(F.struct("src", "dst", "weight"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))))
    both = materialize(both.groupBy("src", "dst").agg(F.sum("weight").alias("weight")), "edges")
    degrees = materialize(both.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("degree")), "degrees")
    n, cores = degrees.count(), edges.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // block_nodes), min(cores, -(-n // LEAST_NODES)))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    slot = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
    nodes = materialize(degrees.withColumn("block", block).withColumn("slot", slot), "places")
    ends = both.join(nodes.select(F.col("id").alias("src"), F.col("degree").alias("a"), F.col("block").alias("sb"), F.col("slot").alias("ss")), "src").join(
        nodes.select(F.col("id").alias("dst"), F.col("degree").alias("b"), F.col("block").alias("db"), F.col("slot").alias("ds")), "dst")
    return ends.select("db", "ds", "sb", "ss", (F.col("weight") / F.sqrt(F.col("a") * F.col("b"))).alias("w")), nodes, blocks


def _packed(df: DataFrame, block: str, order: list[str], blocks: int) -> RDD:
    """(block, [the other columns as arrays]), rows in the given order."""
    names = [c for c in df.columns if c != block]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def full() -> pa.RecordBatch:
            cols = [np.concatenate(x) for x in zip(*parts)]
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([pickle.dumps(cols)], pa.binary())], names=["block", "cols"])

        for b in batches:
            keys = b.column(b.schema.get_field_index(block)).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)] if len(keys) else []
            for lo, hi in zip(edges, edges[1:]):
                if keys[lo] != now and parts:
                    yield full()
                    parts = []
                now = int(keys[lo])
                cols = [b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in names]
                parts.append([(c.flatten() if pa.types.is_list(c.type) else c).to_numpy() for c in cols])
        if parts:
            yield full()

    dealt = df.repartition(blocks, block).sortWithinPartitions(block, *order)
    return dealt.mapInArrow(pack, "block int, cols binary").rdd.map(lambda r: (r["block"], pickle.loads(r["cols"])))


def _dealt(pairs: RDD, count: int) -> RDD:
    """(block, [values sent to it])."""
    def met(pairs: Iterator[tuple]) -> Iterator[tuple]:
        blocks = {}
        for b, value in pairs:
            blocks.setdefault(b, []).append(value)
        return iter(blocks.items())

    return pairs.partitionBy(count, lambda b: b).mapPartitions(met)


def _started(entries: DataFrame, nodes: DataFrame, start: list, count: int) -> RDD:
    """(block, (columns of the matrix, start vectors, None)); the columns are cut by target block: (target, rows, first entries, columns, weights)."""
    def columns(cols: list[np.ndarray]) -> list[tuple]:
        ds, sb, ss, w = cols
        edges = [0, *(np.flatnonzero(np.diff(sb)) + 1).tolist(), len(sb)]
        out = []
        for lo, hi in zip(edges, edges[1:]):
            first = np.r_[0, np.flatnonzero(np.diff(ss[lo:hi])) + 1]
            out.append((int(sb[lo]), ss[lo:hi][first].astype("int32"), first, ds[lo:hi].astype("int32"), w[lo:hi].copy()))
        return out

    vectors = _packed(nodes.select("block", F.array(*start).alias("s"), "slot"), "block", ["slot"], count)
    vectors = vectors.mapValues(lambda cols: ("s", cols[0].reshape(len(cols[1]), -1)))
    graph = _packed(entries, "db", ["sb", "ss", "ds"], count).mapValues(lambda cols: ("columns", columns(cols)))
    return _dealt(vectors.union(graph), count).mapValues(dict).mapValues(lambda v: (v["columns"], v["s"], None))


def _multiplied(state: RDD, turn: Callable, count: int) -> RDD:
    """The blocks after one step: ``turn`` gives the vectors to multiply, and the new s and a without the products, which come second in a."""
    def sent(block: tuple) -> Iterator[tuple]:
        b, (columns, s, a) = block
        x, keep = turn(s, a)
        yield b, (-1, columns, keep, x.shape)
        for target, rows, first, cols, w in columns:
            yield target, (b, rows, np.add.reduceat(x[cols] * w[:, None], first, axis=0))

    def added(met: list) -> tuple:
        (_, columns, keep, shape), *parts = sorted(met, key=lambda m: m[0])  # one order, so that reruns agree
        product = np.zeros(shape)
        for _, rows, part in parts:
            product[rows] += part
        return columns, np.hstack(keep[0]), np.hstack([keep[1][0], product, *keep[1][1:]] if keep[1] else [product])

    return _dealt(state.flatMap(sent), count).mapValues(added)


def _products(state: RDD) -> tuple[np.ndarray, np.ndarray]:
    """s's and s'as summed over all nodes; a task hands on one pair of matrices."""
    def partial(blocks: Iterator[tuple]) -> Iterator[np.ndarray]:
        parts = [np.stack([s.T @ s, s.T @ a]) for _, (_, s, a) in blocks]
        if parts:
            yield sum(parts)

    gram, image = sum(state.mapPartitions(partial).collect())
    return gram, (image + image.T) / 2


def _ritz(gram: np.ndarray, image: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest Ritz values and their coefficients; directions that add nothing to the others are left out."""
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
    g, h = gram * np.outer(scale, scale), image * np.outer(scale, scale)
    size, axes = np.linalg.eigh(g)
    keep = size > 1e-10
    to = axes[:, keep] / np.sqrt(size[keep])
    value, vector = np.linalg.eigh(to.T @ h @ to)
    return value[::-1][:width], scale[:, None] * (to @ vector[:, ::-1][:, :width])


def _turned(coefficients: np.ndarray, values: np.ndarray, x: int) -> Callable:
    """The residuals of the new vectors, to be multiplied; then new vectors, residuals and the part of the step that left the old vectors."""
    step = coefficients.copy()
    step[:x] = 0

    def turn(s: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, tuple]:
        new, image = s @ coefficients, a @ coefficients
        r = image - new * values
        last = ([s @ step], [a @ step]) if x else ([], [])
        return r, ([new, r, *last[0]], [image, *last[1]])

    return turn


def leading_eigenvectors(
    edges: DataFrame, k: int, extra: int = 3, steps: int = 5000, tolerance: float = 1e-5, seed: int = 1, block_nodes: int = BLOCK_NODES,
) -> tuple[DataFrame, np.ndarray]:
    """The ``k`` largest eigenvalues of the normalised adjacency matrix and their vectors: rows (id, degree, vector).

    Locally optimal block iteration: every step takes the best vectors in the span of the old ones, their residuals and the last step.
    Ends when every wanted residual's norm is below ``tolerance``; the eigenvalues' error is of the order of its square over the gap.
    Fails if ``steps`` steps do not get there. A graph without edges gives no rows and no values.
    """
    entries, nodes, count = normalised(edges, block_nodes)
    n = nodes.count()
    width = min(k + extra, n)
    if n == 0:
        return nodes.select("id", "degree", F.array().cast("array<double>").alias("vector")), np.zeros(0)
    spark = edges.sparkSession
    sc = spark.sparkContext
    path = None

    def cut(state: RDD) -> RDD:
        """``state`` from a file in the shared folder; the one before is dropped."""
        nonlocal path
        old, path = path, scratch_path(spark, "vectors")
        state.saveAsPickleFile(path, 1)
        if old:
            discard(spark, old)
        return sc.pickleFile(path)

    def kept(state: RDD) -> RDD:
        return state.persist(StorageLevel.MEMORY_AND_DISK)

    # the vector of the largest eigenvalue of a connected graph is known: sqrt(degree)
    start = [F.sqrt("degree"), *[hash_uniform(["id"], seed + j) - 0.5 for j in range(1, width)]]
    state = kept(_multiplied(cut(_started(entries, nodes, start, count)), lambda s, a: (s, ([s], [])), count))
    values, coefficients = _ritz(*_products(state), width)
    for step in range(steps):
        x = 0 if step == 0 else width
        width = len(values)
        now = kept(_multiplied(state, _turned(coefficients, values, x), count))
        gram, image = _products(now)
        state.unpersist()
        state = now
        if np.sqrt(np.diag(gram)[width:width + min(k, width)]).max() < tolerance:
            break
        values, coefficients = _ritz(gram, image, width)
        if step % CUT == CUT - 1:
            state = cut(now)
            now.unpersist()
            del now
            sc._jvm.System.gc()  # Spark drops shuffle files once the driver has collected what refers to them
    else:
        raise ArithmeticError(f"no {k} eigenvectors within {tolerance} after {steps} steps")
    wanted = min(k, width)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = np.frombuffer(data).reshape(-1, wanted)
                for at in range(0, len(m), 10_000):
                    part = m[at:at + 10_000]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * wanted), pa.array(part.ravel()))
                    places = pa.array(np.arange(at, at + len(part), dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int32)), places, lists], names=["block", "slot", "vector"])

    blocks = state.map(lambda block: (block[0], bytearray(np.ascontiguousarray(block[1][1][:, :wanted]).tobytes())))
    rows = spark.createDataFrame(blocks, "block int, data binary").mapInArrow(unpacked, "block int, slot int, vector array<double>")
    rows = materialize(rows, "vectors")
    state.unpersist()
    discard(spark, path)
    return nodes.join(rows, ["block", "slot"]).select("id", "degree", "vector"), values[:wanted]
