"""Merkle manifest against a plain tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from featherloom.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def grow(level):
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def way(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 3])))
        i //= 3
    return out


def plain(rows):
    """(group, key, leaf) -> sorted (group, key, leaf, subroot, root, proof)."""
    groups = {}
    for g, k, d in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        groups.setdefault(g, []).append((k, d))
    trees = [(g, leaves, grow([d for _, d in leaves])) for g, leaves in groups.items()]
    top = grow([levels[-1][0] for _, _, levels in trees])
    return [(g, k, d, levels[-1][0], top[-1][0], way(levels, i) + way(top, n))
            for n, (g, leaves, levels) in enumerate(trees) for i, (k, d) in enumerate(leaves)]


def flat(got):
    return [(r["g"], r["k"], r["d"], r["subroot"], r["root"], [(bytes(s["l"]).hex(), bytes(s["r"]).hex()) for s in r["proof"]]) for r in got]


CASES = {
    "one": [("a", 1)],
    "one group": [("a", i) for i in range(1000)],
    "sizes": [(g, i) for g, n in (("b", 1), ("a", 2), ("é", 3), ("c", 4), ("z", 27), ("y", 28), ("x", 81), ("w", 82), ("v", 243), ("u", 7)) for i in range(n)],
    "nulls and ties": [(None, None)] * 3 + [(None, 1), ("", 2), ("", 2), ("", None)] + [("hot", i // 40) for i in range(700)],
    "many groups": [(f"g{i % 100}", i) for i in range(260)],
}


@pytest.mark.parametrize("name", CASES)
def test_proofs_match_a_plain_tree(spark, monkeypatch, name):
    monkeypatch.setattr(merkle, "CHUNK", 8)
    rows = [(g, k, digest(repr(g), repr(k))) for g, k in CASES[name]]
    df = spark.createDataFrame(rows, "g string, k long, d string").withColumns({"proof": F.lit("old"), "t": F.lit(1), "x": F.lit(2)})
    out = merkle.proofs(df.repartition(3), "g", "k", "d")
    assert out.columns == ["g", "k", "d", "t", "x", "subroot", "root", "proof"]
    out = out.withColumns({"same": merkle.fold(F.col("d"), F.col("proof")) == F.col("root"), "other": merkle.fold(F.sha2("d", 256), F.col("proof")) == F.col("root")})
    got = out.collect()
    assert sorted(flat(got), key=repr) == sorted(plain(rows), key=repr)
    assert all(r["same"] and not r["other"] for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, k long, d string")
    assert merkle.proofs(df, "g", "k", "d").count() == 0


def test_leaf_fields(spark):
    df = spark.createDataFrame([(5, "é\n", None), (None, "", "x" * 100_000)], "a long, b string, c string")
    got = [r[0] for r in df.select(merkle.leaf(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [digest("1:5", "3:é\n", "-"), digest("-", "0:", "100000:" + "x" * 100_000)]
