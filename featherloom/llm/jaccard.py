"""Exact Jaccard join of shingle sets: size-banded tiles, bitmap bounds, sorted-array intersection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.llm.common import delete_table, partitions, shuffles_dropped, written
from featherloom.llm.components import star_roots

SHINGLE = 5  # words; sets link at 100 * intersection >= 80 * union
SAMPLED = 5  # sixteenths of all shingles that the first round looks at
BAND = 1.26  # sizes in a band differ by less than this factor, so linked sets lie in the same or in neighbouring bands
LEAST_BITS, MOST_BITS = 64, 1 << 15
ROUNDS = 4  # in which each set is checked against its likeliest partner only
HOPS = 6  # over which labels spread between rounds
TILE = 2048  # rows of a tile that one task compares with each other
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles, of the whole sequence if there are fewer words; none without words."""
    words = text.lower().split()  # bytes: only A-Z change, and only space and 0x09 to 0x0D split
    if not words:
        return np.empty(0, np.uint64)
    known: dict[bytes, int] = {}
    h = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))
    length = min(SHINGLE, len(words))
    out = np.full(len(words) - length + 1, length, np.uint64)
    for i in range(length):
        out = (out ^ h[i:i + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def bits_of(band: int) -> int:
    """Bits of the signatures of a band: a power of two, four times the sizes in it or more. Few shingles then share a bit, so that of the pairs
    that cannot link only those at a similarity close to 0.8 pass."""
    return min(MOST_BITS, max(LEAST_BITS, 4 << int(np.ceil((band + 1) * np.log2(BAND)))))


def band_of(n: int) -> int:
    return int(np.floor(np.log(n) / np.log(BAND)))


def signature(tokens: np.ndarray, bits: int) -> bytes:
    """One bit for each hash modulo ``bits``, set if an odd number of the set's shingles falls there.

    Where two signatures differ, the sets differ by a shingle at least, so with d differing bits the intersection has at most
    (|A| + |B| - d) / 2 shingles.
    """
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """Signatures (rows of 64-bit words) narrowed to ``width`` words, as if hashed modulo fewer bits."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def may_link(size_a: np.ndarray, size_b: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can reach 100 * intersection >= 80 * union when at least ``differing`` shingles are in one of them only."""
    return (9 * differing <= size_a + size_b) & (5 * np.minimum(size_a, size_b) >= 4 * np.maximum(size_a, size_b))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Exact, on sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return 100 * both >= 80 * (len(a) + len(b) - both)


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, key, n, the set's 128-bit digest (d1, d2) and its shingles that fall into the sampled sixteenths of the hash range."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, d, sample = [], [], []
            for text in batch.column("text").to_pylist():
                tokens = shingle_set((text or "").encode())
                digest = xxhash.xxh3_128_intdigest(tokens.tobytes()) if len(tokens) else 0
                n.append(len(tokens))
                d.append((digest >> 64, digest & ((1 << 64) - 1)))
                sample.append(tokens[(tokens >> np.uint64(60)) < SAMPLED].view(np.int64))
            d = np.array(d, np.uint64).reshape(-1, 2).view(np.int64)
            ends = np.r_[0, np.cumsum([len(s) for s in sample])].astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *sample]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                                              pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "key", "n", "d1", "d2", "sample"])

    long = T.LongType()
    return docs.mapInArrow(run, T.StructType([
        T.StructField("doc_id", kind), T.StructField("key", T.StringType()), T.StructField("n", long), T.StructField("d1", long), T.StructField("d2", long),
        T.StructField("sample", T.ArrayType(long))]))


def _sets(texts: DataFrame) -> DataFrame:
    """node, n, tokens, band and signature of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set((t or "").encode()) for t in batch.column("text").to_pylist()]
            bands = [band_of(len(s)) for s in sets]
            ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
            flat = pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64))
            yield pa.record_batch({"node": batch.column("node"), "n": pa.array([len(s) for s in sets], pa.int64()),
                                   "tokens": pa.ListArray.from_arrays(pa.array(ends), flat), "band": pa.array(bands, pa.int32()),
                                   "bitmap": pa.array([signature(s, bits_of(b)) for s, b in zip(sets, bands)], pa.binary())})

    return texts.select("node", "text").mapInArrow(run, "node long, n long, tokens array<long>, band int, bitmap binary")


def _needed(n: Column) -> Column:
    """Least intersection that a set of ``n`` shingles has with any set it links with: 0.8 n, rounded up."""
    return F.floor((4 * n + 4) / 5)


def _verified(pairs: DataFrame, sets: DataFrame, bounded: bool) -> DataFrame:
    """The pairs (a, b) that link. Unless ``bounded``, the signatures are looked at before the sets are fetched."""

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, m, n in zip(*(batch.column(c).to_pylist() for c in ("bitmap_a", "bitmap_b", "n_a", "n_b"))):
                x, y = (np.frombuffer(v, "<u8")[None, :] for v in (x, y))
                width = min(x.shape[1], y.shape[1])
                keep.append(bool(may_link(m, n, int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum()))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("tokens_a"), batch.column("tokens_b")):
                keep.append(linked(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    if not bounded:
        pairs = pairs.join(side("a", "n", "bitmap"), "a").join(side("b", "n", "bitmap"), "b").select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(
            near, "a long, b long")
    return pairs.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(exact, "a long, b long")


def _compared(rows: DataFrame, best: bool) -> DataFrame:
    """Pairs (a, b, room) that the signatures leave, of rows sorted by tile (h, tile, i, j) within partitions.

    room: how many more differing shingles, times 9, the pair could have. With ``best`` a set of a tile gives at most one pair (itself first),
    that of most room. Rows of a tile are compared by distance in the sorted order, so a task holds one batch and the rows of one unfinished tile.
    """
    keys, rest = ("h", "tile", "i", "j"), ("node", "label", "n", "guest", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def pairs(c: dict[str, np.ndarray], number: np.ndarray) -> Iterator[pa.RecordBatch]:
            widths = np.array([bits_of(int(t)) // 64 for t in c["tile"]])
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                x = {k: v[at] for k, v in c.items()}
                run_no, n = number[at], len(at)
                words = np.concatenate([fold(np.frombuffer(b, "<u8")[None, :], width) for b in x["bitmap"]])
                found = []
                most, other = np.full(n, -1), np.zeros(n, np.int64)
                first = np.arange(n)
                for k in range(1, n):
                    first = first[:np.searchsorted(first, n - k)]
                    first = first[run_no[first] == run_no[first + k]]
                    if not len(first):
                        break
                    s, t = first, first + k
                    ok = (x["label"][s] != x["label"][t]) & ~(x["guest"][s] & x["guest"][t]) & ((x["i"][s] == x["j"][s]) | (x["block"][s] != x["block"][t]))
                    s, t = s[ok], t[ok]
                    step = max(1, (1 << 21) // int(width))
                    for p in range(0, len(s), step):
                        u, v = s[p:p + step], t[p:p + step]
                        differing = np.bitwise_count(words[u] ^ words[v]).sum(axis=1, dtype=np.int64)
                        ok = may_link(x["n"][u], x["n"][v], differing) & (x["node"][u] != x["node"][v])
                        u, v = u[ok], v[ok]
                        room = x["n"][u] + x["n"][v] - 9 * differing[ok]
                        if not best:
                            found.append(np.stack([x["node"][u], x["node"][v], room]))
                            continue
                        for one, two in ((u, v), (v, u)):  # within a distance k no row is twice on one side
                            more = room > most[one]
                            most[one[more]], other[one[more]] = room[more], x["node"][two[more]]
                if best:
                    found = [np.stack([x["node"], other, most])[:, most >= 0]]
                if found:
                    three = np.concatenate(found, axis=1)
                    if not best:
                        three[:2] = np.sort(three[:2], axis=0)
                        three = np.unique(three, axis=1)
                    if three.shape[1]:
                        yield pa.record_batch({"a": pa.array(three[0]), "b": pa.array(three[1]), "room": pa.array(three[2])})

        for batch in batches:
            if not batch.num_rows:
                continue
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in (*keys, *rest)}
            now["bitmap"] = np.array([*batch.column("bitmap").to_pylist(), None], object)[:-1]
            c = {k: np.concatenate([held[k], v]) for k, v in now.items()} if held else now
            fresh = np.zeros(len(c["h"]), bool)
            for k in keys:
                fresh[1:] |= c[k][1:] != c[k][:-1]
            number = np.cumsum(fresh)
            last = int(np.argmax(number == number[-1]))
            if last:
                yield from pairs({k: v[:last] for k, v in c.items()}, number[:last])
            held = {k: v[last:] for k, v in c.items()}
        if held:
            yield from pairs(held, np.zeros(len(held["h"]), np.int64))

    return rows.select(*keys, *rest, "bitmap").mapInArrow(run, "a long, b long, room long")


def _spread(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b): the smallest node found within HOPS links. Nodes of one label are connected.

    A hop takes the least label of the neighbours only. Their labels already count the node itself, a neighbour of theirs, so a hop reads the
    labels before it once, and the plan grows with the hops, not with their power of two.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    for _ in range(HOPS - 1):
        labels = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("label"))
    return labels


def _candidates(prefixes: DataFrame, labels: DataFrame, sets: DataFrame, best: bool) -> DataFrame:
    """Distinct pairs (a, b) of different labels that share a prefix shingle and that sizes and signatures let pass, with ``best`` at most one per set.

    A tile is a prefix shingle and a band of sizes, home of the sets of that band; those of the next band are its guests. Tiles whose rows all have one label
    are done. A tile of more than TILE rows is cut into blocks by a hash of the set, and every two blocks meet in a tile of their own.
    """
    named = prefixes.join(labels, "node", "left").select("node", "band", F.coalesce("label", "node").alias("label"), F.explode("prefix").alias("h"))
    rows = named.select("h", "node", "label", F.explode(F.array(F.struct(F.col("band").alias("tile"), F.lit(False).alias("guest")),
                                                               F.struct((F.col("band") - 1).alias("tile"), F.lit(True).alias("guest")))).alias("x")).select(
        "h", "x.tile", "node", "label", "x.guest")
    tiles = rows.groupBy("h", "tile").agg(F.count("*").alias("m"), F.min("guest").alias("no_home"), F.min("label").alias("least"), F.max("label").alias("most"))
    tiles = tiles.where("not no_home and least < most").select("h", "tile", F.ceil(F.col("m") / TILE).cast("int").alias("blocks"))
    rows = rows.join(tiles, ["h", "tile"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).join(sets.select("node", "n", "bitmap"), "node")
    n = partitions(prefixes.sparkSession)
    found = _compared(rows.repartition(n, "h", "tile", "i", "j").sortWithinPartitions("h", "tile", "i", "j"), best)
    if best:
        found = found.groupBy("a").agg(F.max(F.struct("room", "b")).alias("x")).select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b"))
    return found.select("a", "b").distinct()


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id (smallest doc_id that links reach, the row's own included) for each row of ``docs``.

    docs: doc_id and text; other columns are not read. Two sets link when 100 * intersection >= 80 * union. Null, empty and wordless texts have
    an empty set and link with nothing, not even with each other. Rows of equal sets are one node, so copies cost no pairs; repeated rows stay. Null
    doc_ids count only where a component has no other. An empty table gives no rows. A text is one row and must fit a task, however long.

    1. A linked set has at most a fifth of its shingles to itself. Five sixteenths of all hashes are counted; sets with more than that many
       shingles found in no other set, among these hashes alone, link with nothing.
    2. The shingles of the rest are counted in full and ordered by frequency, then hash. Linked sets share one of the first 0.2 n + 1 (the prefix).
    3. Each set is checked against one set of its band for each of its two most frequent prefix shingles. Labels spread over the links found.
    4. Tiles: sets of different labels under one prefix shingle and in neighbouring bands are compared by signature; a pair goes on if the
       bit count leaves room for the intersection it needs. Pairs that are left are checked on the sorted sets. In the first ROUNDS rounds a set
       gives its likeliest partner only, which joins large groups without writing their pairs; the last round gives every pair that is left.

    Steps 1, 2 and the last round drop only pairs that cannot link, and sets of one label are connected, so components are exact (up to equal
    64-bit hashes).
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"), "text")
    with shuffles_dropped(spark):
        described, described_at = written(_described(keyed), "jaccard-texts")
        rows, _ = written(described.select("doc_id", "key", "n", "d1", "d2"), "jaccard-rows")
        groups = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min(F.struct("key", "doc_id")).alias("rep"), F.min("doc_id").alias("least"))
        single = described.select("d1", F.explode("sample").alias("h")).groupBy("h").agg(F.min("d1").alias("d1"), F.max("d1").alias("top")).where("d1 = top")
        single = single.groupBy(F.col("d1").alias("__d1")).agg(F.count("*").alias("alone"))
        # two sets of equal d1 would share one count, so they stay
        same = F.count("*").over(Window.partitionBy("d1"))
        alive = (F.col("same") > 1) | (F.coalesce("alone", F.lit(0)) <= F.col("n") - _needed(F.col("n")))
        groups = groups.withColumn("same", same).join(single, F.col("d1") == F.col("__d1"), "left").select("n", "d1", "d2", "rep", "least", alive.alias("alive"))
        nodes, _ = written(groups.withColumn("node", F.monotonically_increasing_id()), "jaccard-nodes")
        delete_table(spark, described_at)
        kept = nodes.where("alive").select("node", F.col("rep.key").alias("__key"), F.col("rep.doc_id").alias("__doc"))
        texts = keyed.join(kept, (F.col("key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__doc")))
        sets, _ = written(_sets(texts), "jaccard-sets")
        shingles = sets.select("node", F.explode("tokens").alias("h"))
        shared = shingles.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
        common = shingles.join(shared, "h").groupBy(F.col("node").alias("__node")).agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("common"))
        # shingles of no other set come first in the order
        left = F.size("common") - _needed(F.col("n")) + 1
        prefixes, _ = written(sets.join(common, F.col("node") == F.col("__node")).where(left > 0).select(
            "node", "band", F.slice(F.col("common.h"), F.lit(1), left.cast("int")).alias("prefix")), "jaccard-prefixes")
        stars = prefixes.select("node", "band", F.explode(F.slice("prefix", F.greatest(F.lit(1), F.size("prefix") - 1), F.lit(2))).alias("h"))
        centre = stars.groupBy("h", "band").agg(F.min("node").alias("a"))
        first = stars.join(centre, ["h", "band"]).where("a < node").select("a", F.col("node").alias("b")).distinct()
        first, _ = written(_verified(first, sets, bounded=False), "jaccard-links")
        links = first
        for r in range(ROUNDS + 1):
            labels, _ = written(_spread(links), "jaccard-labels")
            pairs, _ = written(_candidates(prefixes, labels, sets, best=r < ROUNDS), "jaccard-pairs")
            links, _ = written(links.unionByName(_verified(pairs, sets, bounded=True)), "jaccard-links")
        roots = star_roots(links)
        member = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        least = member.join(nodes.select("node", "least"), "node").groupBy("root").agg(F.min("least").alias("cid"))
        named, _ = written(nodes.join(member.join(least, "root").select("node", "cid"), "node", "left").select(
            F.col("n").alias("__n"), F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), F.coalesce("cid", "least").alias("cid")), "jaccard-members")
    return rows.join(named, (F.col("n") == F.col("__n")) & (F.col("d1") == F.col("__d1")) & (F.col("d2") == F.col("__d2")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cid")).otherwise(F.col("doc_id")).alias("component_id"))
