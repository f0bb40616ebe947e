"""Quotient filters: exact round trips; collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.llm import collocations as co


@pytest.mark.parametrize("bits", [1, 2, 7, 20, 33, 63, 64])
def test_permutation_is_invertible(bits):
    rng = np.random.default_rng(bits)
    keys = np.arange(min(1 << bits, 5000), dtype=np.uint64) if bits < 20 else rng.integers(0, (1 << bits) - 1, 5000, np.uint64, endpoint=True)
    mixed = co.Permutation(bits)(keys)
    assert (co.Permutation(bits).inverse(mixed) == keys).all()
    assert len(np.unique(mixed)) == len(np.unique(keys)) and int(mixed.max()) < 1 << bits


def test_too_wide_keys_are_refused():
    with pytest.raises(ValueError):
        co.Permutation(65)


@pytest.mark.parametrize("bits, first, span", [(64, 0, 1 << 64), (64, 3 << 62, 1 << 62), (30, 1000, 500), (12, 0, 4096), (1, 0, 2)])
@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_filter_keeps_keys_and_counts(bits, first, span, n):
    rnd = random.Random(n + bits)
    keys = sorted({first + rnd.randrange(span) for _ in range(n)})
    counts = [rnd.choice([1, 1, 1, 2, 10 ** 12]) for _ in keys]
    blob = co.write_filter(np.array(keys, np.uint64), np.array(counts, np.int64), bits, first, span)
    got_keys, got_counts = co.read_filter(blob, first)
    assert got_keys.tolist() == keys and got_counts.tolist() == counts


def test_filters_are_compact():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 100_000, np.uint64))
    blob = co.write_filter(keys, np.ones(len(keys), np.int64), 40, 0, 1 << 40)
    assert len(blob) < 5.1 * len(keys)  # 40 bits are 5 bytes, counts come on top of it


def test_merge_adds_equal_keys():
    a, b = np.array([1, 5, 9], np.uint64), np.array([5, 9, 11], np.uint64)
    keys, counts = co.merge_counts([a, b], [np.array([1, 2, 3]), np.array([10, 20, 30])])
    assert keys.tolist() == [1, 5, 9, 11] and counts.tolist() == [1, 12, 23, 30]


def plain(rows, least, best):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und" if lang != "" else ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {}
    for (lang, w), a in f.items():
        if len(w) < 2 or a < least:
            continue
        found[lang, w] = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
    gone = {(lang, w[i:i + m]) for lang, w in found for m in range(2, len(w)) for i in range(len(w) - m + 1) if f[lang, w] >= f[lang, w[i:i + m]]}
    out = []
    for lang in {x for x, _ in found}:
        rows = sorted((-s, -f[g, w], " ".join(w).encode(), l, r) for (g, w), (s, _, l, r) in found.items() if g == lang and (g, w) not in gone)
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(rows[:best])]
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["a", "b", "New", "york", "new", "é", "ß", "\x00", "İ", "x y", "of"]
    rows = [(None, None), ("en", ""), ("en", " \t\n"), (None, "solo"), ("", "new york new york"), ("fr", "a a a a a a a a")]
    for _ in range(120):
        text = "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " "]) for _ in range(rnd.randrange(40)))
        rows.append((rnd.choice(["en", "en", "fr", None, "de"]), text + rnd.choice(["", " New York City of"]) * 3))
    return rows + [("en", "the Same phrase here")] * 60 + [("en", "long " * 30_000)]


@pytest.mark.parametrize("least, shard, block", [(5, 1 << 21, 1 << 21), (3, 40, 16), (1, 300, 4)])
def test_collocations_match_plain_counts(spark, monkeypatch, least, shard, block):
    monkeypatch.setattr(co, "WORDS_PER_SHARD", shard)
    monkeypatch.setattr(co, "ENTRIES_PER_BLOCK", block * 50)
    rows = corpus(least)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({"words": F.lit("own"), "shard": F.lit(7)}).repartition(3)
    got = [tuple(r) for r in co.collocations(df, least, best=200).collect()]
    assert sorted(got) == plain(rows, least, 200)


def test_empty_and_wordless_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert co.collocations(none).count() == 0
    assert co.collocations(spark.createDataFrame([("en", None), (None, " ")], "lang string, text string")).count() == 0
    assert co.collocations(spark.createDataFrame([("en", "a b c")], "lang string, text string")).count() == 0
