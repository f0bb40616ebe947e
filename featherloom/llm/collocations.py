"""Collocations: phrases that occur far more often than their parts suggest, from exact counts in quotient filters."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featherloom.llm.common import delete_table, partitions, shuffles_dropped, written

LONGEST, LEAST, BEST = 5, 100, 2000
WORDS_PER_SHARD = 1 << 20
ENTRIES_PER_BLOCK = 1 << 21
UNKNOWN = "und"
# a byte that UTF-8 never has stands for the end of a piece
_STOP = b"\xff"
_ENDS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d", _STOP * 10)
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so multiplying by it is invertible modulo any power of two


# ---- counting quotient filter

class Permutation:
    """Invertible mixing of keys of ``bits`` bits: two rounds of an odd multiplication and a folding xor."""

    def __init__(self, bits: int):
        if not 0 < bits <= 64:
            raise ValueError(f"a packed phrase takes {bits} bits, more than 64")
        self.mask, self.shift = np.uint64((1 << bits) - 1), np.uint64((bits + 1) // 2)
        self.times, self.back = np.uint64(MULTIPLIER), np.uint64(pow(MULTIPLIER, -1, 1 << 64))

    def __call__(self, key: np.ndarray) -> np.ndarray:
        for _ in range(2):
            key = (key * self.times) & self.mask
            key = key ^ (key >> self.shift)
        return key

    def inverse(self, key: np.ndarray) -> np.ndarray:
        for _ in range(2):
            key = key ^ (key >> self.shift)  # one step undoes the fold, as the shift is at least half of the bits
            key = (key * self.back) & self.mask
        return key


def pack(numbers: np.ndarray, bits: int) -> bytes:
    """``numbers`` in ``bits`` bits each."""
    if not bits or not len(numbers):
        return b""
    return np.packbits(np.unpackbits(numbers.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack(blob: bytes, bits: int, n: int) -> np.ndarray:
    if not bits or not n:
        return np.zeros(n, np.uint64)
    flat = np.unpackbits(np.frombuffer(blob, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    out = np.zeros((n, 64), np.uint8)
    out[:, :bits] = flat
    return np.packbits(out, axis=1, bitorder="little").view("<u8").reshape(-1)


def _varints(numbers: np.ndarray) -> tuple[int, bytes]:
    """Bits a number, and the numbers."""
    bits = int(numbers.max()).bit_length() if len(numbers) else 0
    return bits, pack(numbers, bits)


def write_filter(keys: np.ndarray, counts: np.ndarray, bits: int, first: int, span: int) -> bytes:
    """Sorted permuted ``keys`` in [first, first + span) with their counts as one filter.

    A key splits into quotient (slot) and remainder. Per slot the filter keeps how many remainders it has, then all remainders in full, so
    no key is lost, then how much each count exceeds one: first whether it does, then the excess of those.
    """
    n = len(keys)
    low = keys - np.uint64(first)
    width = max(1, int(span - 1).bit_length())
    slots = max(0, min(width, int(n - 1).bit_length() if n > 1 else 0))
    rest = width - slots
    quotient = (low >> np.uint64(rest)).astype(np.int64) if slots else np.zeros(n, np.int64)
    remainder = low & np.uint64((1 << rest) - 1) if rest else np.zeros(n, np.uint64)
    fill_bits, fill = _varints(np.bincount(quotient, minlength=1 << slots).astype(np.uint64))
    more = counts > 1
    more_bits, excess = _varints((counts[more] - 1).astype(np.uint64))
    head = np.array([n, int(more.sum()), slots, rest, fill_bits, more_bits, len(fill)], "<i8").tobytes()
    return head + fill + pack(remainder, rest) + pack(more.astype(np.uint64), 1) + excess


def read_filter(blob: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    n, n_more, slots, rest, fill_bits, more_bits, at = (int(x) for x in np.frombuffer(blob, "<i8", 7))
    body = blob[56:]
    quotient = np.repeat(np.arange(1 << slots, dtype=np.uint64), unpack(body[:at], fill_bits, 1 << slots).astype(np.int64))
    end = at + (n * rest + 7) // 8
    remainder = unpack(body[at:end], rest, n)
    more = unpack(body[end:end + (n + 7) // 8], 1, n).astype(bool)
    counts = np.ones(n, np.int64)
    counts[more] += unpack(body[end + (n + 7) // 8:], more_bits, n_more).astype(np.int64)
    keys = (quotient << np.uint64(rest)) | remainder if rest < 64 else remainder
    return keys + np.uint64(first), counts


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted key lists with their counts as one; equal keys are added up."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")  # sorted runs: merged, not sorted anew
    k, c = k[order], c[order]
    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.empty(0, np.int64)
    return k[start], np.add.reduceat(c, start) if len(start) else c


def blob(numbers: np.ndarray) -> bytes:
    """Numbers from 0, in as many bits each as the largest takes."""
    bits = int(numbers.max()).bit_length() if len(numbers) else 0
    return np.array([len(numbers), bits], "<i8").tobytes() + pack(numbers, bits)


def unblob(data: bytes) -> np.ndarray:
    n, bits = (int(x) for x in np.frombuffer(data, "<i8", 2))
    return unpack(data[16:], bits, n).astype(np.int64)


# ---- corpus to shards

def tokens(text: bytes) -> list[bytes]:
    """Words, A-Z lower-cased, with _STOP where a piece ends."""
    return text.lower().translate(_ENDS).replace(_STOP, b" " + _STOP + b" ").split()


SEQ, VOCABULARY = 0, 1
SHARDS = "kind int, shard long, lang string, block long, a binary, b binary"


def encode(docs: DataFrame, blocks: int) -> DataFrame:
    """``docs`` (lang, text) as shards: what one task read of a language, up to WORDS_PER_SHARD words and the rest of the text that reached them.

    One row of kind SEQ per shard has its local word numbers from 1, 0 where a piece ends (a). Per block (checksum of the word) one row of kind
    VOCABULARY has the shard's words of that block (a) and their counts (b). Numbers follow the blocks, then the first occurrence.
    """
    most = WORDS_PER_SHARD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), itertools.count()
        books: dict[str, tuple[dict, list]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            book, parts = books.pop(lang)
            del size[lang]
            shard = (task << 32) + next(made)
            words = np.array([*book, b""], object)[:-1]
            block = np.fromiter((zlib.crc32(w) % blocks for w in book), np.int64, len(book))
            order = np.argsort(block, kind="stable")
            number = np.zeros(len(book) + 1, np.int64)
            number[order + 1] = np.arange(1, len(book) + 1)
            seq = number[np.concatenate(parts)]
            counts = np.bincount(seq, minlength=len(book) + 1)[1:]
            words, block = words[order], block[order]
            at = np.r_[np.flatnonzero(np.r_[True, block[1:] != block[:-1]]), len(block)] if len(block) else np.zeros(1, np.int64)
            rows = [(SEQ, -1, blob(seq), b"")] + [
                (VOCABULARY, int(block[i]), _STOP.join(words[i:j]), blob(counts[i:j])) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            kind, block, a, b = zip(*rows)
            return pa.record_batch({"kind": pa.array(kind, pa.int32()), "shard": pa.array([shard] * len(rows), pa.int64()), "lang": pa.array([lang] * len(rows)),
                                    "block": pa.array(block, pa.int64()), "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found = tokens(text.encode()) if text else []
                if not found:
                    continue
                book, parts = books.setdefault(lang, ({}, []))
                number = book.setdefault
                parts.append(np.fromiter((0 if w == _STOP else number(w, len(book) + 1) for w in itertools.chain(found, (_STOP,))), np.int32, len(found) + 1))
                size[lang] = size.get(lang, 0) + len(found)
                if size[lang] >= most or sum(size.values()) >= 2 * most:
                    for full in [lang] if size[lang] >= most else list(size):
                        yield flush(full)
        for lang in list(size):
            yield flush(lang)

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return rows.mapInArrow(run, SHARDS)


FOUND, BACK = 0, 1


def merge_words(shards: DataFrame, blocks: int, least: int) -> DataFrame:
    """Words counted over all shards, block by block; those of at least ``least`` occurrences get ids, unique over all blocks and languages.

    Rows of kind FOUND hold, per block and language, the frequent words (a), ids (b), counts (c) and the number of all words (n). Rows of kind
    BACK hold the ids of a shard's words of the block (b), 0 for rare ones.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = int(rows["block"].iloc[0])
        total: dict[str, dict[bytes, int]] = {}
        read = [(int(s), g, w.split(_STOP), unblob(c)) for s, g, w, c in zip(rows["shard"], rows["lang"], rows["a"], rows["b"])]
        for _, lang, words, counts in read:
            own = total.setdefault(lang, {})
            for w, c in zip(words, counts.tolist()):
                own[w] = own.get(w, 0) + c
        out, ids, rank = [], {}, itertools.count()
        for lang in sorted(total):
            frequent = sorted(w for w, c in total[lang].items() if c >= least)
            ids[lang] = {w: next(rank) * blocks + block + 1 for w in frequent}
            out.append((FOUND, -1, block, lang, _STOP.join(frequent), blob(np.array([*ids[lang].values()], np.int64)),
                        blob(np.array([total[lang][w] for w in frequent], np.int64)), sum(total[lang].values())))
        for shard, lang, words, _ in read:
            get = ids[lang].get
            out.append((BACK, shard, block, lang, b"", blob(np.fromiter((get(w, 0) for w in words), np.int64, len(words))), b"", 0))
        return pd.DataFrame(out, columns=["kind", "shard", "block", "lang", "a", "b", "c", "n"])

    rows = shards.where(F.col("kind") == VOCABULARY).select("block", "shard", "lang", "a", "b")
    return rows.groupBy("block").applyInPandas(run, "kind int, shard long, block long, lang string, a binary, b binary, c binary, n long")


# ---- one pass per phrase length

PART_SEQ, PART_WORDS, PART_STATE = 0, 1, 2  # rows that make up what a shard knows; PART_STATE + k: which of its phrases of k words are frequent
PARTS = "shard long, kind int, block long, a binary, b binary"
FILTER = -1


class Layout:
    """Per phrase length: bits of a packed key, and how its quotients fall into blocks."""

    def __init__(self, bits: int, blocks: int):
        self.bits, self.blocks = bits, max(1, min(blocks, 1 << min(bits, 40)))
        self.span = -(-(1 << bits) // self.blocks)

    def edges(self, keys: np.ndarray) -> np.ndarray:
        """Where in sorted ``keys`` each block starts, and their end."""
        starts = np.array([min(b * self.span, (1 << 64) - 1) for b in range(self.blocks)], np.uint64)
        return np.r_[np.searchsorted(keys, starts), len(keys)]


def _ids(parts: pd.DataFrame, k: int, keys: np.ndarray, layout: Layout) -> np.ndarray:
    """Ids of a shard's sorted phrases of ``k`` words, 0 for rare ones."""
    ids, edges = np.zeros(len(keys), np.int64), layout.edges(keys)
    rows = parts[parts["kind"] == PART_STATE + k]
    for block, mask, named in zip(rows["block"], rows["a"], rows["b"]):
        own = slice(edges[block], edges[block + 1])
        ids[own][unblob(mask).astype(bool)] = unblob(named)
    return ids


def _candidates(parts: pd.DataFrame, k: int, layouts: dict[int, Layout], word_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and permuted keys of all phrases of ``k`` words in a shard whose both parts of k - 1 words are frequent."""
    low = np.uint64((1 << word_bits) - 1)
    if k <= 3:
        rows = parts[parts["kind"] == PART_WORDS].sort_values("block")
        named = np.concatenate([[0], *map(unblob, rows["b"])])
        words = named[unblob(parts["a"][parts["kind"] == PART_SEQ].iloc[0])]
        at = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
        key = Permutation(layouts[2].bits)((words[at].astype(np.uint64) << np.uint64(word_bits)) | words[at + 1].astype(np.uint64))
        if k == 2:
            return at, key
        keys, index = np.unique(key, return_inverse=True)
    else:
        state = parts[parts["kind"] == PART_STATE]
        if not len(state):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at, index = unblob(state["a"].iloc[0]), unblob(state["b"].iloc[0])
        keys = np.frombuffer(state["a"].iloc[1], "<u8") if len(state) > 1 else np.empty(0, np.uint64)
    ids = _ids(parts, k - 1, keys, layouts[k - 1])[index]
    last = (Permutation(layouts[k - 1].bits).inverse(keys) & low)[index]
    j = np.flatnonzero((at[1:] == at[:-1] + 1) & (ids[1:] > 0) & (ids[:-1] > 0))
    return at[j], Permutation(layouts[k].bits)((ids[j].astype(np.uint64) << np.uint64(word_bits)) | last[j + 1])


def count_filters(parts: DataFrame, k: int, layouts: dict[int, Layout], word_bits: int, more: bool) -> DataFrame:
    """Per shard and block of quotients a counting quotient filter (kind FILTER, a) of the shard's candidates of ``k`` words.

    With ``more`` and from three words on also rows of kind PART_STATE, from which the next length is found: positions (a) and the numbers of
    their keys (b), and the keys.
    """
    layout = layouts[k]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        at, key = _candidates(rows.sort_values(["kind", "block"], kind="stable"), k, layouts, word_bits)
        keys, index, counts = np.unique(key, return_inverse=True, return_counts=True)
        edges = layout.edges(keys)
        out = [(shard, FILTER, b, write_filter(keys[edges[b]:edges[b + 1]], counts[edges[b]:edges[b + 1]], layout.bits, b * layout.span, layout.span), b"")
               for b in range(layout.blocks) if edges[b] < edges[b + 1]]
        if more and k > 2 and len(at):
            out += [(shard, PART_STATE, 0, blob(at), blob(index)), (shard, PART_STATE, 1, keys.astype("<u8").tobytes(), b"")]
        return pd.DataFrame(out, columns=["shard", "kind", "block", "a", "b"])

    return parts.groupBy("shard").applyInPandas(run, PARTS)


def merge_filters(filters: DataFrame, layout: Layout, least: int) -> DataFrame:
    """Filters of all shards merged block by block; keys of at least ``least`` occurrences get ids, unique over all blocks.

    Rows of kind FOUND hold a block's keys (a, unpermuted), ids (b) and counts (c). Rows of kind BACK tell a shard which of the keys it sent are
    frequent (a, one bit each) and their ids (b).
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        block = int(rows["block"].iloc[0])
        read = [read_filter(x, block * layout.span) for x in rows["a"]]
        keys, counts = merge_counts([r[0] for r in read], [r[1] for r in read])
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
        ids = np.arange(len(keys), dtype=np.int64) * layout.blocks + block + 1
        out = [(FOUND, -1, block, Permutation(layout.bits).inverse(keys).astype("<u8").tobytes(), blob(ids), blob(counts))]
        for shard, (own, _) in zip(rows["shard"], read):
            if not len(keys):
                break
            place = np.searchsorted(keys, own)
            hit = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == own)
            if hit.any():
                out.append((BACK, int(shard), block, blob(hit.astype(np.int64)), blob(ids[place[hit]]), b""))
        return pd.DataFrame(out, columns=["kind", "shard", "block", "a", "b", "c"])

    return filters.where(F.col("kind") == FILTER).select("shard", "block", "a").groupBy("block").applyInPandas(
        run, "kind int, shard long, block long, a binary, b binary, c binary")


def _phrase_rows(found: DataFrame, word_bits: int) -> DataFrame:
    """(id, first, word, f) of the rows of kind FOUND: the id of all words but the last, the id of the last, and the count."""
    low = np.uint64((1 << word_bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in "abc")):
                key = np.frombuffer(a, "<u8")
                yield pa.record_batch({"id": pa.array(unblob(b)), "first": pa.array((key >> np.uint64(word_bits)).astype(np.int64)),
                                       "word": pa.array((key & low).astype(np.int64)), "f": pa.array(unblob(c))})

    return found.where(F.col("kind") == FOUND).select("a", "b", "c").mapInArrow(run, "id long, first long, word long, f long")


def _word_rows(found: DataFrame) -> DataFrame:
    """(lang, id, w, f) of the rows of kind FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, a, b, c in zip(*(batch.column(x).to_pylist() for x in ("lang", "a", "b", "c"))):
                ids = unblob(b)
                if len(ids):
                    yield pa.record_batch({"lang": pa.array([lang] * len(ids)), "id": pa.array(ids), "w": pa.array([w.decode() for w in a.split(_STOP)]),
                                           "f": pa.array(unblob(c))})

    return found.where(F.col("kind") == FOUND).select("lang", "a", "b", "c").mapInArrow(run, "lang string, id long, w string, f long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words with at least ``least`` occurrences, (lang, words, f), and (lang, n), the words of each language.

    Words get ids (one for each word and language). A phrase is packed as (id of all its words but the last, id of the last), both dense, in one
    integer of at most 64 bits. Each shard sorts its permuted keys into quotient filters, one per block of quotients; a block's filters of all
    shards are merged, and the shards get back which of their keys are frequent, so that the next length is counted only where both its parts of
    one word less are. Blocks follow the number of words, and the permutation spreads keys evenly over them whatever their counts. A table that no
    later step reads is deleted from the shared folder once its successor is written.
    """
    with shuffles_dropped(docs.sparkSession):
        return _frequent(docs, least, longest)


def _frequent(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    blocks = partitions(spark)
    shards, shards_at = written(encode(docs, blocks), "phrase-shards")
    merged, _ = written(merge_words(shards, blocks, least), "phrase-words")
    vocabulary, _ = written(_word_rows(merged), "phrase-vocabulary")
    totals = merged.where(F.col("kind") == FOUND).groupBy("lang").agg(F.sum("n").alias("n"))
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    last = vocabulary.agg(F.max("id")).first()[0] or 0
    word_bits = max(1, last.bit_length())
    blocks = max(blocks, -(-all_words // ENTRIES_PER_BLOCK))
    parts = shards.where(F.col("kind") == SEQ).select("shard", F.lit(PART_SEQ).alias("kind"), "block", "a", "b").unionByName(
        merged.where(F.col("kind") == BACK).select("shard", F.lit(PART_WORDS).alias("kind"), "block", "a", "b"))
    phrases = vocabulary.select("lang", "id", F.array("w").alias("words"), "f")
    every, layouts, done = [phrases], {}, []
    for k in range(2, longest + 1):
        layouts[k] = Layout(max(1, last.bit_length()) + word_bits, blocks)
        counted, counted_at = written(count_filters(parts, k, dict(layouts), word_bits, k < longest), "phrase-filters")
        for path in done:
            delete_table(spark, path)
        merged, merged_at = written(merge_filters(counted, layouts[k], least), "phrase-merged")
        rows, _ = written(_phrase_rows(merged, word_bits), "phrase-rows")
        last = rows.agg(F.max("id")).first()[0] or 0
        firsts = phrases.select(F.col("id").alias("first"), "lang", "words")
        ends = vocabulary.select(F.col("id").alias("word"), "w")
        phrases, _ = written(rows.join(firsts, "first").join(ends, "word").select("lang", "id", F.concat("words", F.array("w")).alias("words"), "f"), "phrases")
        every.append(phrases)
        if not last:
            break
        back = merged.where(F.col("kind") == BACK).select("shard", F.lit(PART_STATE + k).alias("kind"), "block", "a", "b")
        if k == 2:
            parts, done = parts.unionByName(back), [shards_at, merged_at]
            delete_table(spark, counted_at)
        else:
            parts, done = counted.where(F.col("kind") == PART_STATE).unionByName(back), [counted_at, merged_at]
    out = every[0]
    for p in every[1:]:
        out = out.unionByName(p)
    return out.select("lang", "words", "f"), totals


def _whole(x: str):
    return F.col(x).cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """The ``best`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    docs: lang (null: ``und``) and text (null: empty); other columns are not read, repeated rows count again. Texts, A-Z lower-cased, fall into
    pieces at ``. , ; : ! ?`` and U+000A to U+000D, and pieces into words at spaces and tabs; phrases stay within a piece. a, l and r count all
    occurrences, overlaps included, n all words of the language. The score of a phrase is that of its lowest cut (ties: the first),
    floor(1000 a n / (l r)) in exact decimals. Phrases found whole inside a longer one as frequent as themselves go. Ties in the
    ranking go by a, then by the phrase's bytes. Empty tables and texts without words give no rows; a very long text is one row and must fit a task.
    """
    phrases, totals = frequent_phrases(docs, least, longest)
    phrases = phrases.select("lang", F.array_join("words", " ").alias("phrase"), "words", F.col("f").alias("a"))
    f = phrases.select("lang", "phrase", "a")
    candidates = phrases.where(F.size("words") > 1)
    size = F.size("words")
    cuts = candidates.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("p"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("q"))
    left, right = f.select("lang", F.col("phrase").alias("p"), F.col("a").alias("l")), f.select("lang", F.col("phrase").alias("q"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "p"]).join(right, ["lang", "q"]).join(totals, "lang")
    # whole-number division of exact decimals: 1000 a n below 10^38 up to 10^17 words
    scored = scored.withColumn("up", (F.lit(1000).cast("decimal(4,0)") * _whole("a") * _whole("n")).cast("decimal(38,0)")).withColumn(
        "down", (_whole("l") * _whole("r")).cast("decimal(38,0)")).withColumn("score", F.expr("up div down"))
    lowest = scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = candidates.where(size > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("m")).select(
        "lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i")).select(
        "lang", F.array_join(F.slice("words", F.col("i"), F.col("m")), " ").alias("phrase"), F.col("a").alias("longer"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = lowest.join(inside, ["lang", "phrase"], "left").where("longer is null or longer < a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
