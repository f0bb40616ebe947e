"""Removal of repeated byte strings by blockwise suffix sorting with a difference-cover sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featherloom.llm.common import partitions, shuffles_dropped, small_batches
from featherloom.session import materialize, scratch_path

# a perfect difference set: every residue modulo 31 is the difference of two of its members
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
LENGTH = 50
SAMPLE = LENGTH - PERIOD + 1  # a sampled suffix is ranked by so many bytes
NULL_ID = np.iinfo(np.int64).max
BUCKET_BYTES = 1 << 23  # of text to a bucket, at most
_STRIDE = 1 << 16
_CHUNK = 1 << 18  # suffixes ranked at a time
# Parquet holds whole row groups and pages in buffers and looks at their size after 100 rows only; a reader's batch never passes a row group.
_LARGE_ROWS = {"compression": "zstd", "parquet.block.row.count.limit": 2, "parquet.page.size.row.check.min": 1}
_rng = np.random.default_rng(20240601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def prefix_ranks(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each place of the sorted array ``at`` a 64-bit word that stands for the ``length`` bytes there (all inside ``data``).

    Equal strings have equal words. Words of powers of two bytes are doubled; the length is put together from its binary digits.
    """
    out = np.empty(len(at), np.uint64)
    for lo in range(0, len(data), _STRIDE):
        i, j = np.searchsorted(at, [lo, lo + _STRIDE])
        if i == j:
            continue
        here = at[i:j] - lo
        word, size, level = _BYTE[data[lo:lo + _STRIDE + length]], 1, 0
        total, done = None, 0
        while True:
            if length & size:
                part = word[here + done]
                total = part if total is None else _mix(total * _ODD[level] + part)
                done += size
            if size * 2 > length:
                break
            word = _mix(word[:-size] * _ODD[level] + word[size:])
            size, level = size * 2, level + 1
        out[i:j] = total
    return out


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values in as few bytes each as the largest needs, that number first."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    out = np.zeros((len(rows), 8), np.uint8)
    out[:, :width] = rows
    return out.reshape(-1).view("<u8")


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ..., counts[i] of them, for every i."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def _sample(lens: np.ndarray) -> np.ndarray:
    """Places, in the concatenated texts, of the cover's suffixes that have SAMPLE bytes left in their text."""
    begin = np.cumsum(lens) - lens
    rounds = (lens + PERIOD - 1) // PERIOD
    base = _places(np.zeros(len(lens), np.int64), rounds) * PERIOD
    own = (base[:, None] + COVER).ravel()
    width = rounds * len(COVER)
    keep = own + SAMPLE <= np.repeat(lens, width)
    return (own + np.repeat(begin, width))[keep]


def _by_bucket(keys: np.ndarray, shift: int, buckets: int, low: int) -> np.ndarray:
    """Bounds of the buckets in sorted keys: bucket = top 32 of the key's bits below ``low`` scaled to the number of buckets."""
    top = ((keys - np.uint64(low)) >> np.uint64(shift)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(top, np.arange(buckets + 1))


def _buckets(spark: SparkSession, text_bytes: int) -> int:
    """A task holds the ranks of one bucket, so their number follows the text however few partitions are set."""
    return max(2 * partitions(spark), -(-text_bytes // BUCKET_BYTES))


def _covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the runs; runs are not empty and do not overlap."""
    step = np.zeros(size + 1, np.int8)
    step[start] += 1
    step[end] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def _concat(rows: list[dict] | None, n: int) -> np.ndarray:
    """Flags of sorted keys from the packed flags of their buckets."""
    got = sorted(rows or [], key=lambda r: r["bucket"])
    flags = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]) for r in got]
    out = np.concatenate(flags).astype(bool) if flags else np.zeros(0, bool)
    if len(out) != n:
        raise ValueError(f"{len(out)} flags for {n} keys")
    return out


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df``, whose rows take megabytes, written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**_LARGE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, ids, lens, body): documents packed in the order of their ids, about ``block_bytes`` of text a row, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            rows = sorted(held, key=lambda r: r[0])
            return pa.record_batch({
                "block": pa.array([(task << 32) + made]), "ids": pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                "lens": pa.array([[len(r[1]) for r in rows]], pa.list_(pa.int64())), "body": pa.array([b"".join(r[1] for r in rows)], pa.binary())})

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held.append((NULL_ID if i is None else i, (text or "").encode()))
                size += len(held[-1][1])
                if size >= block_bytes:
                    yield block()
                    made, held, size = made + 1, [], 0
        if held:
            yield block()

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "block long, ids array<long>, lens array<long>, body binary")
    return _stored(made, "suffix-blocks")


def _each(rows: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in rows:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _row_by_row(work: Callable[[dict], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow. What ``work`` needed for a row is free before the next one comes."""
    return lambda batches: (work(row) for row in _each(batches))


def _block_arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array(row["ids"], np.int64), np.array(row["lens"], np.int64), np.frombuffer(row["body"], np.uint8)


def _flags_by_block(flags: DataFrame) -> DataFrame:
    """One row per block; a block has at most one row per bucket."""
    return flags.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias("flags"))


def _emit(block: int, keys: np.ndarray, bounds: np.ndarray, extra: dict[str, list]) -> pa.RecordBatch:
    full = [b for b in range(len(bounds) - 1) if bounds[b + 1] > bounds[b]]
    deltas = [pack(np.r_[keys[bounds[b]], np.diff(keys[bounds[b]:bounds[b + 1]])]) for b in full]
    return pa.record_batch({"bucket": pa.array(full, pa.int32()), "block": pa.array([block] * len(full), pa.int64()),
                            "keys": pa.array(deltas, pa.binary()), **{k: pa.array([v[b] for b in full], pa.binary()) for k, v in extra.items()}})


def _sample_keys(lens: np.ndarray, body: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    at = _sample(lens)
    return at, prefix_ranks(body, at, SAMPLE) >> np.uint64(64 - bits)


def _tied_samples(blocks: DataFrame, bits: int, buckets: int) -> DataFrame:
    """(bucket, block, n, bits): for every block, which of its sorted distinct sample ranks stand at two places or more of the corpus."""

    def out(row: dict) -> pa.RecordBatch:
        _, lens, body = _block_arrays(row)
        _, keys = _sample_keys(lens, body, bits)
        keys, counts = np.unique(keys, return_counts=True)
        bounds = _by_bucket(keys, bits - 32, buckets, 0)
        twice = [np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(bounds, bounds[1:])]
        return _emit(row["block"], keys, bounds, {"twice": twice})

    def meet(rows: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(k), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
        sizes = [len(p) for p in parts]
        tied = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(rows.column("twice").to_pylist(), sizes)]).astype(bool)
        keys = np.concatenate(parts)
        del parts
        order = np.argsort(keys)
        s = keys[order]
        same = s[1:] == s[:-1]
        tied[order[1:][same]] = True
        tied[order[:-1][same]] = True
        cuts = np.cumsum([0, *sizes])
        return pa.table({"bucket": rows.column("bucket"), "block": rows.column("block"), "n": pa.array(sizes, pa.int32()),
                         "bits": pa.array([np.packbits(tied[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    sent = blocks.mapInArrow(_row_by_row(out), "bucket int, block long, keys binary, twice binary")
    return sent.groupBy("bucket").applyInArrow(meet, "bucket int, block long, n int, bits binary")


def _regions(blocks: DataFrame, ties: DataFrame, bits: int) -> DataFrame:
    """(block, ids, doc, start, count, body): runs of suffixes that touch a tied sample, with the bytes they need.

    Equal strings of LENGTH bytes at two places have, at some common distance below PERIOD, a sampled suffix at both; so a suffix without a
    tied sample in reach has no equal anywhere.
    """

    def run(row: dict) -> pa.RecordBatch:
        ids, lens, body = _block_arrays(row)
        at, keys = _sample_keys(lens, body, bits)
        known, inverse = np.unique(keys, return_inverse=True)
        seen = np.zeros(len(body) + PERIOD + 1, np.int32)
        seen[at[_concat(row["flags"], len(known))[inverse]] + 1] = 1
        seen = np.cumsum(seen, dtype=np.int32)
        begin = np.cumsum(lens) - lens
        long = begin[lens >= LENGTH]
        good = _covered(len(body), long, long + lens[lens >= LENGTH] - LENGTH + 1) & (seen[PERIOD:-1] > seen[:-PERIOD - 1])
        edges = np.flatnonzero(np.diff(np.r_[False, good, False]))  # no run reaches into the next document: LENGTH - 1 places before it are not good
        start, end = edges[::2], edges[1::2]
        owner = np.searchsorted(begin, start, "right") - 1
        text = b"".join(row["body"][a:z] for a, z in zip(start.tolist(), (end + LENGTH - 1).tolist()))
        return pa.record_batch({"block": pa.array([row["block"]]), "ids": pa.array([row["ids"]], pa.list_(pa.int64())),
                                "doc": pa.array([owner], pa.list_(pa.int64())), "start": pa.array([start - begin[owner]], pa.list_(pa.int64())),
                                "count": pa.array([end - start], pa.list_(pa.int64())), "body": pa.array([text], pa.binary())})

    joined = blocks.join(_flags_by_block(ties), "block", "left")
    return joined.mapInArrow(_row_by_row(run), "block long, ids array<long>, doc array<long>, start array<long>, count array<long>, body binary")


def _of_turn(rank: np.ndarray, turn: int, log_turns: int) -> np.ndarray:
    low, high = turn << (64 - log_turns), ((turn + 1) << (64 - log_turns)) - 1
    return np.flatnonzero((rank >= np.uint64(low)) & (rank <= np.uint64(high)))


class _Suffixes:
    """The suffixes of a block's regions, or those of one turn, with the words that rank their first LENGTH bytes.

    Where all text repeats there is one for every byte, so only word and document are kept of each; places are worked out for a chunk.
    """

    def __init__(self, row: dict, turn: int = 0, log_turns: int = 0):
        body = np.frombuffer(row["body"], np.uint8)
        self.ids = np.array(row["ids"], np.int64)
        doc, self.start, count = (np.array(row[c], np.int64) for c in ("doc", "start", "count"))
        self.first = np.cumsum(count) - count  # number of each run's first suffix
        n, k = int(count.sum()), 0
        docs, ranks = np.empty(n, np.int32), np.empty(n, np.uint64)
        for lo in range(0, n, _CHUNK):
            number = np.arange(lo, min(lo + _CHUNK, n))
            run = self._run(number)
            at = number + run * (LENGTH - 1)  # each run has so many bytes more than suffixes
            rank = prefix_ranks(body[at[0]:at[-1] + LENGTH], at - at[0], LENGTH)
            mine = _of_turn(rank, turn, log_turns)
            docs[k:k + len(mine)] = doc[run[mine]]
            ranks[k:k + len(mine)] = rank[mine]
            k += len(mine)
        self.doc, self.rank = docs[:k], ranks[:k]

    def _run(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, number, "right") - 1

    def place(self, number: np.ndarray) -> np.ndarray:
        """Where in their documents the suffixes of these numbers begin."""
        run = self._run(number)
        return self.start[run] + number - self.first[run]

    def sorted(self, turn: int, log_turns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the turn's suffixes: their numbers in order of rank, where each distinct rank begins, the distinct ranks.

        Documents come in the order of their ids, so the first of equal suffixes is that of the smallest id.
        """
        mine = _of_turn(self.rank, turn, log_turns)
        mine = mine[np.argsort(self.rank[mine], kind="stable")]
        rank = self.rank[mine]
        first = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]]) if len(rank) else np.empty(0, np.int64)
        return mine, first, rank[first]


def _earlier_elsewhere(regions: DataFrame, turn: int, log_turns: int, buckets: int) -> DataFrame:
    """(bucket, block, n, bits): which of a block's distinct suffixes of this turn also start in a document whose id is below all of the block's."""

    def out(row: dict) -> pa.RecordBatch:
        s = _Suffixes(row, turn, log_turns)
        mine, first, keys = s.sorted(turn, log_turns)
        bounds = _by_bucket(keys, 32 - log_turns, buckets, turn << (64 - log_turns))
        least = s.ids[s.doc[mine[first]]]
        lows = [least[a:b].min() if b > a else 0 for a, b in zip(bounds, bounds[1:])]
        docs = [np.int64(low).tobytes() + pack((least[a:b] - low).view(np.uint64)) if b > a else b"" for a, b, low in zip(bounds, bounds[1:], lows)]
        return _emit(row["block"], keys, bounds, {"docs": docs})

    def meet(rows: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(k), dtype=np.uint64) for k in rows.column("keys").to_pylist()]
        cuts = np.cumsum([0, *map(len, parts)])
        keys = np.concatenate(parts)
        del parts
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        del keys
        docs = np.concatenate([unpack(d[8:]).view(np.int64) + np.frombuffer(d, np.int64, 1) for d in rows.column("docs").to_pylist()])[order]
        earlier = np.empty(len(docs), bool)
        earlier[order] = np.repeat(np.minimum.reduceat(docs, first), np.diff(np.r_[first, len(docs)])) < docs
        return pa.table({"bucket": rows.column("bucket"), "block": rows.column("block"), "n": pa.array(np.diff(cuts), pa.int32()),
                         "bits": pa.array([np.packbits(earlier[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())})

    sent = regions.mapInArrow(_row_by_row(out), "bucket int, block long, keys binary, docs binary")
    return sent.groupBy("bucket").applyInArrow(meet, "bucket int, block long, n int, bits binary")


def _removals(regions: DataFrame, flags: DataFrame, log_turns: int) -> DataFrame:
    """(block, doc, start, end): the maximal removed runs of a block, by document number and byte."""

    def mark(s: _Suffixes, bad: np.ndarray, turn: int, got: list[dict] | None) -> None:
        mine, first, keys = s.sorted(turn, log_turns)
        if not len(mine):
            return
        size, ids = np.diff(np.r_[first, len(mine)]), s.ids[s.doc[mine]]
        bad[mine] = np.repeat(_concat(got, len(keys)), size) | (ids > np.repeat(ids[first], size))

    def run(row: dict) -> pa.RecordBatch:
        s, by_turn = _Suffixes(row), {}
        for f in row["flags"] or []:
            by_turn.setdefault(f["turn"], []).append(f)
        bad = np.zeros(len(s.rank), bool)
        for turn in range(1 << log_turns):
            mark(s, bad, turn, by_turn.get(turn))
        fresh = np.zeros(len(bad), bool)
        fresh[s.first] = True
        one, last = (np.flatnonzero(bad & edge) for edge in (np.r_[True, ~bad[:-1] | fresh[1:]], np.r_[~bad[1:] | fresh[1:], True]))
        doc, start, end = s.doc[one], s.place(one), s.place(last) + LENGTH
        cut = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])][:len(doc)]
        return pa.record_batch({"block": pa.array([row["block"]]), "doc": pa.array([doc[cut]], pa.list_(pa.int64())),
                                "start": pa.array([start[cut]], pa.list_(pa.int64())), "end": pa.array([end[np.r_[cut[1:], True][:len(doc)]]], pa.list_(pa.int64()))})

    per_block = flags.groupBy("block").agg(F.collect_list(F.struct("turn", "bucket", "n", "bits")).alias("flags"))
    return regions.join(per_block, "block", "left").mapInArrow(_row_by_row(run), "block long, doc array<long>, start array<long>, end array<long>")


def remove_repeats(docs: DataFrame, block_bytes: int = 1 << 22, log_turns: int = 2) -> DataFrame:
    """Per document: doc_id, n_bytes, starts and ends of the maximal removed byte runs, and ``kept``, the remaining bytes.

    A byte goes if a string of LENGTH bytes that covers it also starts in a document with a smaller doc_id, judged on the input; overlaps
    count, matches never cross documents. ``docs``: doc_id (integer), text. Null texts are empty; a null doc_id is above all others; rows of
    one doc_id never remove each other; an empty table gives none.

    The corpus is cut into blocks. First the suffixes of a difference cover modulo PERIOD are ranked by SAMPLE bytes; the ranks that tie
    somewhere bound where long ties can be, and every other suffix is dropped. The rest is sorted one bucket at a time (2 ** log_turns turns,
    each dealt over many tasks): a block sends its distinct suffixes of the bucket with the smallest doc_id of each and gets back one bit per
    suffix. As only equality to a depth of LENGTH bytes counts, suffixes are ordered by 64-bit words of their prefixes instead of letters. A
    frequent passage is sent once per block and bucket, never once per document. Shuffle files go after each step.

    A task holds one block or one bucket at a time, however many of them its partition has.
    """
    spark = docs.sparkSession
    with shuffles_dropped(spark), small_batches(spark):
        blocks = _blocks(docs, block_bytes)
        total = blocks.select(F.sum(F.octet_length("body").cast("long")).alias("n")).first()["n"] or 1
        buckets = _buckets(spark, total)
        bits = max(32, min(64, total.bit_length() + 10))  # enough that chance ties of samples are rare; they cost time only
        ties = materialize(_tied_samples(blocks, bits, buckets), "suffix-ties")
        regions = _stored(_regions(blocks, ties, bits), "suffix-regions")
        flags = None
        for turn in range(1 << log_turns):
            part = materialize(_earlier_elsewhere(regions, turn, log_turns, buckets).withColumn("turn", F.lit(turn)), "suffix-flags")
            flags = part if flags is None else flags.unionByName(part)
        gone = materialize(_removals(regions, flags, log_turns), "suffix-removals")

    def run(block: pa.Table, cuts: pa.Table) -> pa.Table:
        ids, lens, body = _block_arrays(block.to_pylist()[0])
        cut = next(iter(cuts.to_pylist()), {"doc": [], "start": [], "end": []})
        owner, start, end = (np.array(cut[c], np.int64) for c in ("doc", "start", "end"))
        begin = np.cumsum(lens) - lens
        stay = ~_covered(len(body), begin[owner] + start, begin[owner] + end)
        bounds = np.searchsorted(owner, np.arange(len(lens) + 1))
        rows = range(len(lens))
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=ids == NULL_ID), "n_bytes": pa.array(lens),
            "starts": pa.array([start[bounds[i]:bounds[i + 1]] for i in rows], pa.list_(pa.int64())),
            "ends": pa.array([end[bounds[i]:bounds[i + 1]] for i in rows], pa.list_(pa.int64())),
            "kept": pa.array([body[a:a + n][stay[a:a + n]].tobytes() for a, n in zip(begin, lens)], pa.binary())})

    # cogroups and no join: what runs after this function has returned runs without small_batches, but a group has a stream of its own
    return blocks.groupBy("block").cogroup(gone.groupBy("block")).applyInArrow(
        run, "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")
