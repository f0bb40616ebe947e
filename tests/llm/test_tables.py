"""Mixing, sharding, shared helpers, the pipeline and the registered queries."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from featherloom.catalog.base import Tables
from featherloom.llm import decontaminate, mixing, sharding, simhash
from featherloom.llm.common import number_rows, prefix_sums, word_count
from featherloom.llm.components import star_roots
from featherloom.llm.queries import book
from tools.check import compare, connect

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_row_numbers_and_prefix_sums(spark):
    rows = [(i % 7 if i % 11 else None, i % 5, i) for i in range(300)] + [(1, 1, 1)] * 20
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(5)
    numbered = number_rows(df, [F.col("o"), F.col("v")], "n").collect()
    assert [(r["o"], r["v"]) for r in sorted(numbered, key=lambda r: r["n"])] == sorted((o, v) for _, o, v in rows)
    assert sorted(r["n"] for r in numbered) == list(range(len(rows)))
    for keys in (["k"], []):
        got = prefix_sums(df, keys, [F.col("o"), F.col("v")], {"before": "v"}).collect()
        want, runs = [], {}
        for k, o, v in sorted(rows, key=lambda r: (r[1], r[2])):
            g = k if keys else 0
            want.append((k, o, v, runs.get(g, 0)))
            runs[g] = runs.get(g, 0) + v
        key = lambda r: repr(r)
        if keys:
            assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
        else:
            assert sorted(r["before"] for r in got) == sorted(w[3] for w in want)
    assert prefix_sums(df.limit(0), ["k"], [F.col("o")], {"before": "v"}).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 2, 3, 5, 40, 41, 97, 400])
def test_feistel_is_a_permutation(spark, rows):
    df = spark.range(rows).withColumn("position", F.lit("clash"))
    got = sharding.assign(df, 40, ["id"]).collect()
    assert sorted(r["position"] for r in got) == list(range(rows))
    again = {r["id"]: r["position"] for r in sharding.assign(df.repartition(3), 40, ["id"]).collect()}
    assert all(again[r["id"]] == r["position"] for r in got)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) - rows // 40 in (0, 1)


def test_equal_rows_and_nulls_get_shards(spark):
    df = spark.createDataFrame([(None, "a")] * 5 + [(1, "b")] * 50 + [(2, None)], "doc_id long, text string")
    got = sharding.assign(df, 8, ["doc_id", "text"]).collect()
    assert sorted(r["position"] for r in got) == list(range(56))


def water(sizes, weights, most=3):
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weights[s] for s in open_))
        new = {s: most * sizes[s] for s in open_ if level * weights[s] > most * sizes[s]}
        if not new:
            return {s: capped.get(s, level * weights[s]) for s in sizes}
        capped.update(new)


@pytest.mark.parametrize("spread", [1, 6])
def test_mix_meets_targets(spark, spread):
    rows = [(i, f"s{i % 9}" if i % 9 else None, (i * 37 % 50) * (10 ** (spread * (i % 9 == 5)) if spread < 2 else i % 9 + 1) ) for i in range(400)]
    rows += [(None, "s1", None), (7, "zero", 0), (8, "zero", None), (3, "s3", 12), (3, "s3", 12)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("before", F.lit("clash"))
    got = mixing.plan(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + (n or 0)
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want = water(sizes, weights)
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {sizes[s]}
        assert mine[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["epochs"] * r["size"] + r["part"] for r in mine) - want[s]) <= 0.5
        assert all(r["epochs"] * r["size"] + r["part"] <= 3 * r["size"] for r in mine)
    again = mixing.plan(df.repartition(4)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["epochs"], r["part"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.plan(df.limit(0)).count() == 0


def test_mix_repeats_rows(spark):
    rows = [(i, "big" if i % 10 else "small", "w " * (i % 13)) for i in range(200)] + [(1, "big", None), (1, "big", "w w")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("epochs", F.lit("own"))
    got = mixing.mixed(df, word_count(F.col("text")))
    assert got.columns == df.columns
    sizes = {s: sum(len(WORD.findall(t or "")) for _, x, t in rows if x == s) for s in ("big", "small")}
    want = water(sizes, {"big": 1, "small": 2})
    have = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("n")).collect()}
    assert all(abs(have[s] - want[s]) <= 6 for s in sizes)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 7)] + [(200, 200 + i) for i in range(1, 50)]
    got = {r["node"]: r["root"] for r in star_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90, **{200 + i: 200 for i in range(1, 50)}}
    assert star_roots(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", [n for n in book.queries if n in book.sql])
def test_query_matches_sql(spark, folder, name):
    assert compare(Tables(spark, folder), connect(folder), book.queries[name], book.sql[name])[0] == "ok"


@pytest.mark.parametrize("name", [n for n in book.queries if n not in book.sql])
def test_query_runs_over_its_table(spark, folder, name):
    rows = book.queries[name](Tables(spark, folder))
    one_per_document = name not in ("op5_license_scan", "op9_decontamination")
    n = rows.count()
    assert n == Tables(spark, folder).documents.count() if one_per_document else n > 0


def test_pipeline_stages(spark, folder):
    """Every stage on what the one before kept, each held against what it promises."""
    docs = Tables(spark, folder).documents
    start, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, folder), "test")
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == start.columns
    labels = {r["doc_id"]: r["toxic"] for r in Tables(spark, folder).labels.collect()}
    left = {r["doc_id"] for r in kept["toxicity"].collect()}
    assert sum(d in left for d, t in labels.items() if not t) >= 0.97 * sum(not t for t in labels.values())
    fps = [simhash.fingerprint((r["text"] or "").encode()) for r in kept["near_dedup"].collect()]
    assert all((a ^ b).bit_count() > simhash.DISTANCE for i, a in enumerate(fps) for b in fps[:i])
    index = decontaminate.Index([(r["item_id"], r["text"]) for r in Tables(spark, folder).benchmark.collect()])
    clean = {r["doc_id"] for r in kept["near_dedup"].collect() if not index.search(r["text"])}
    assert {r["doc_id"] for r in kept["decontamination"].collect()} == clean
    sharded = kept["sharding"].groupBy("shard").count().collect()
    assert kept["sharding"].count() == kept["mixing"].count() and max(r["count"] for r in sharded) - min(r["count"] for r in sharded) <= 1
