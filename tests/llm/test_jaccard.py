"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.llm import jaccard


def shingles(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def edited(rnd, words, share):
    return [f"x{rnd.randrange(10 ** 6)}" if rnd.random() < share else w for w in words]


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    rows = [None, "", " \t\n", "one", "One", "two words", "a b c d", "A b  c d", "a b c d e", "a b c d e f", "é à ü ö ß"]
    passage = [word() for _ in range(80)]
    for _ in range(12):  # families at all distances, some of long texts
        base = [word() for _ in range(rnd.choice([6, 11, 30, 120, 700]))]
        for share in (0, 0, 0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.04, 0.06):
            rows.append(" ".join(edited(rnd, base, share)))
        rows.append(" ".join(base + [word() for _ in range(len(base) // 5)]))
        rows.append(" ".join(base[:len(base) * 4 // 5]))
    for _ in range(40):  # a passage that makes up three quarters and more of many texts
        rows.append(" ".join([word() for _ in range(rnd.randrange(6, 26))] + passage))
    for k in range(60):  # a chain: each links with its neighbours only
        rows.append(" ".join(f"c{i}" for i in range(k * 8, k * 8 + 100)))
    rows += ["same text of several words here"] * 30
    rnd.shuffle(rows)
    ids = [*range(1000, 1000 + len(rows))]
    rnd.shuffle(ids)
    return [*zip(ids, rows)] + [(None, "same text of several words here"), (None, "only null has this one text"), (1003, "twice"), (1003, "twice")]


@pytest.mark.parametrize("seed, tile", [(1, 2048), (2, 4)])
def test_components_match_all_pairs(spark, monkeypatch, seed, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "n": F.lit("own"), "node": F.lit(2)}).repartition(3)
    got = [tuple(r) for r in jaccard.components(df).collect()]
    assert sorted(got, key=repr) == plain(rows)


def test_empty_table_and_long_text(spark):
    assert jaccard.components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    long = " ".join(f"w{i}" for i in range(60_000))
    got = jaccard.components(spark.createDataFrame([(2, long), (1, long + " more")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 59_997, 1), (2, 59_996, 1)]


def test_signatures_never_exceed_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        both = rng.integers(0, 1 << 63, rng.integers(0, 400)).astype(np.uint64)
        a, b = (np.unique(np.r_[both, rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64)]) for _ in "ab")
        wide, narrow = 1024, 64 << int(rng.integers(0, 5))
        x, y = (np.frombuffer(jaccard.signature(s, wide), "<u8")[None, :] for s in (a, b))
        assert (jaccard.fold(x, narrow // 64)[0] == np.frombuffer(jaccard.signature(a, narrow), "<u8")).all()
        differing = int(np.bitwise_count(jaccard.fold(x, narrow // 64) ^ jaccard.fold(y, narrow // 64)).sum())
        assert differing <= len(np.setxor1d(a, b))
        assert not jaccard.linked(a, b) or jaccard.may_link(len(a), len(b), differing)


def test_linked_sizes_lie_in_neighbouring_bands():
    for n in range(1, 20_000):
        assert jaccard.band_of(n * 5 // 4) - jaccard.band_of(n) in (0, 1)
        assert jaccard.bits_of(jaccard.band_of(n) + 1) <= 2 * jaccard.bits_of(jaccard.band_of(n))


def test_labels_spread_over_a_plan_that_grows_with_the_hops(spark):
    """Each hop used to read the labels before it twice, 62 joins for six hops, whose plans filled the driver."""
    rnd = random.Random(5)
    nodes = [rnd.randrange(10 ** 9) for _ in range(40)]
    rows = [*zip(nodes, nodes[1:])] + [(nodes[0], 7), (3, 4), (4, 3)] + [(10 ** 9 + 5, 10 ** 9 + k) for k in range(5)]  # a chain, a pair, a star
    near = {}
    for a, b in rows:
        near.setdefault(a, {a}).add(b)
        near.setdefault(b, {b}).add(a)
    label = {v: v for v in near}
    for _ in range(jaccard.HOPS):
        label = {v: min(label[u] for u in near[v]) for v in near}
    labels = jaccard._spread(spark.createDataFrame(rows, "a long, b long"))
    assert {r["node"]: r["label"] for r in labels.collect()} == label
    assert labels.count() == len(near)
    assert labels._jdf.queryExecution().analyzed().toString().count("Join Inner") == jaccard.HOPS - 1
