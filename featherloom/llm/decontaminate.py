"""Benchmark decontamination: pigeonhole pieces found exactly, then Myers' bit-parallel edit distance."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.llm.common import prefix_sums
from featherloom.session import materialize

PIECE = 12  # characters of text per tolerated edit, and so about the length of a piece
_WORDS = re.compile(r"\w+")


def normal(text: str | None) -> str:
    """Lower-cased words joined by single spaces, with one space on either side; a text without words is empty."""
    words = _WORDS.findall((text or "").lower())
    return f" {' '.join(words)} " if words else ""


def budget(length: int, piece: int = PIECE) -> int:
    return max(0, length // piece - 1)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into edits + 1 nearly equal pieces, each with its place: with at most ``edits`` edits one piece stays whole."""
    n, parts = len(item), edits + 1
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of a pattern to any substring of ``text`` and the first place where such a substring ends (Myers).

    ``masks`` has for every character the bit set of its places in the pattern; one Python integer holds a whole column of the table.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, here = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        plus, minus = down | (full & ~(d0 | up)), d0 & up
        if plus & high:
            here += 1
        elif minus & high:
            here -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full  # the match may start anywhere, so nothing enters at the top
        up, down = minus | (full & ~(d0 | plus)), d0 & plus
        if here < best:
            best, end = here, at
    return best, end


class Index:
    """Pieces of a block of items, and what verification needs."""

    def __init__(self, items: list[tuple[object, str | None]], piece: int = PIECE):
        self.items: list[tuple[object, str, int, dict[str, int]]] = []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for key, text in items:
            norm = normal(text)
            if not norm:
                continue
            k = budget(len(norm), piece)
            masks: dict[str, int] = defaultdict(int)
            for i, c in enumerate(norm):
                masks[c] |= 1 << i
            for at, p in pieces(norm, k):
                places[p].append((len(self.items), at))
            self.items.append((key, norm, k, dict(masks)))
        self.automaton = ahocorasick.Automaton()
        for p, where in places.items():
            self.automaton.add_word(p, (len(p), where))
        if places:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple[object, int, int, int]]:
        """(item, distance, edits allowed, end in the normal text) of every item within its budget of some part of the text."""
        body = normal(text)
        if not body or not self.items:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (n, where) in self.automaton.iter(body):
            for item, at in where:
                starts[item].add(end + 1 - n - at)
        found = []
        for item, begin in starts.items():
            key, norm, k, masks = self.items[item]
            m, best = len(norm), (k + 1, 0)
            lo = hi = None
            for s in [*sorted(begin), None]:  # windows that overlap are read once
                if lo is not None and (s is None or s - k > hi):
                    low = max(0, lo)
                    d, e = best_match(masks, m, body[low:hi])
                    best = min(best, (d, low + e))
                    lo = None
                if s is not None:
                    lo, hi = (s - k if lo is None else lo), s + m + k
            if best[0] <= k:
                found.append((key, best[0], k, best[1]))
        return sorted(found, key=lambda f: (str(type(f[0])), f[0] is None, f[0] if f[0] is not None else 0))


def _blocks(items: DataFrame, most_chars: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of at most ``most_chars`` characters plus one item, each small enough to go to every task."""
    sized = items.select("item_id", "text", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("__n"))
    runs = materialize(prefix_sums(sized, [], [F.col("item_id"), F.col("text")], {"__before": "__n"}, "items"), "items")
    last = runs.agg(F.max("__before").alias("m")).first()["m"]
    blocks = 0 if last is None else last // most_chars + 1
    for i in range(blocks):
        rows = runs.where(F.col("__before").between(i * most_chars, (i + 1) * most_chars - 1)).orderBy("__before", "item_id").collect()
        if rows:
            yield [(r["item_id"], r["text"]) for r in rows]


def contaminated(docs: DataFrame, items: DataFrame, piece: int = PIECE, most_chars: int = 2_000_000) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, edits (allowed), end (in the normalised text).

    ``docs``: doc_id, text; ``items``: item_id, text. Both texts are compared as lower-cased words, so case, punctuation and spacing cost
    nothing. An item counts as found if some part of the document is within its edit budget, one edit per ``piece`` characters less one.
    Cut into budget + 1 pieces, at least one piece of it then stands unchanged in the document; all pieces are looked up at once, and every
    place that a hit allows is verified. Items too short for an edit must stand there as whole words. Items without words are never found,
    null texts have none, repeated rows of either table are found each. Items go out in blocks of bounded size, one pass over the documents per block.
    """
    spark = docs.sparkSession
    types = {f.name: f for f in [*docs.select("doc_id").schema.fields, *items.select("item_id").schema.fields]}
    schema = T.StructType([types["doc_id"], types["item_id"], T.StructField("distance", T.IntegerType()), T.StructField("edits", T.IntegerType()),
                           T.StructField("end", T.LongType())])
    kinds = [pa.int32(), pa.int32(), pa.int64()]

    def one(block: list[tuple[object, str | None]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, piece)
            for b in batches:
                rows, at = [], []
                for i, text in enumerate(b.column("text").to_pylist()):
                    hits = index.search(text)
                    rows += hits
                    at += [i] * len(hits)
                cols = [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array([r[0] for r in rows])]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.array([r[j] for r in rows], k) for j, k in zip((1, 2, 3), kinds)]], names=schema.names)

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    found = None
    for block in _blocks(items, most_chars):
        part = one(block)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, items: DataFrame, piece: int = PIECE, most_chars: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows in which an item is found; one pass per block, nothing is shuffled."""
    names, spark = docs.columns, docs.sparkSession

    def keep(block: list[tuple[object, str | None]], rows: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, piece)
            for b in batches:
                stay = [i for i, t in enumerate(b.column(text_at).to_pylist()) if not index.search(t)]
                yield b.take(pa.array(stay, pa.int64()))

        return rows.mapInArrow(run, rows.schema)

    text_at = names.index("text")
    for block in _blocks(items, most_chars):
        docs = keep(block, docs)
    return docs
