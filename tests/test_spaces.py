"""Text components and graph eigenvectors beside dense numpy."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from featherloom.catalog.base import Tables
from featherloom.catalog.models import STOP
from featherloom.operators import models, spectral, textspace


def dense(texts, terms):
    """TF-IDF rows by plain Python."""
    rows = []
    for t in texts:
        w = [x for x in re.findall(r"\w{2,}", (t or "").lower()) if x not in STOP]
        rows.append(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    n = collections.Counter(g for r in rows for g in r)
    docs = collections.Counter(g for r in rows for g in set(r))
    known = sorted(n, key=lambda g: (-n[g], g.encode()))[:terms]
    at = {g: i for i, g in enumerate(known)}
    m = np.zeros((len(rows), len(known)))
    for i, r in enumerate(rows):
        for g in r:
            if g in at:
                m[i, at[g]] += math.log((1 + len(rows)) / (1 + docs[g])) + 1
    size = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(size == 0, 1, size)


@pytest.mark.parametrize("terms", [10_000, 300])
def test_text_components_are_those_of_a_dense_svd(spark, folder, terms):
    d = Tables(spark, folder).documents.select("doc_id", "text")
    d = d.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "the of and"), (-4, "same words here"), (-4, "same words here")], d.schema))
    rows, found = textspace.text_components(d, "doc_id", "text", 3, STOP, terms)
    data = d.collect()
    m = dense([r["text"] for r in data], terms)
    centred = m - m.mean(axis=0)
    u, s, v = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(found.singular, s[:3], rtol=1e-7)
    got = collections.defaultdict(list)
    for r in rows.collect():
        got[r["doc_id"]].append(r["components"])
    want = centred @ found.loadings  # signs and ties as found, values by numpy
    assert np.allclose(np.abs(np.sum(found.loadings * v[:3].T, axis=0)), 1, atol=1e-5)
    for r, w in zip(data, want):
        assert np.allclose(got[r["doc_id"]][0], w, atol=1e-8)
    assert len(got[-4]) == 2


def test_texts_without_words(spark):
    d = spark.createDataFrame([(1, None), (2, "")], "id int, text string")
    rows, found = textspace.text_components(d, "id", "text", 2, STOP)
    assert sorted((r["id"], r["components"]) for r in rows.collect()) == [(1, [0.0, 0.0]), (2, [0.0, 0.0])] and list(found.singular) == [0, 0]
    assert textspace.text_components(d.where("id < 0"), "id", "text", 2, STOP)[0].count() == 0


def test_eigenvalues_of_the_neighbour_graph(spark, folder):
    edges = models.neighbour_graph(Tables(spark, folder).embeddings, "vec_id", "embedding").cache()
    rows, values = spectral.leading_eigenvectors(edges, 4)
    data = edges.collect()
    ids = sorted({e[c] for e in data for c in ("src", "dst")})
    w = np.zeros((len(ids), len(ids)))
    for e in data:
        i, j = ids.index(e["src"]), ids.index(e["dst"])
        w[i, j] = w[j, i] = e["weight"]
    d = w.sum(axis=0)
    s = w / np.sqrt(np.outer(d, d))
    want = np.linalg.eigvalsh(s)[::-1]
    assert np.allclose(values, want[:4], atol=1e-8)
    v = np.zeros((len(ids), 4))
    for r in rows.collect():
        v[ids.index(r["id"])] = r["vector"]
    assert np.abs(s @ v - v * values).max() < 1e-4 and np.allclose(v.T @ v, np.eye(4), atol=1e-6)


def test_eigenvectors_of_a_long_ring_take_all_their_steps(spark):
    """Eigenvalues that lie close together need more than 80 steps."""
    n = 400
    edges = spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst"), F.lit(1.0).alias("weight"))
    rows, values = spectral.leading_eigenvectors(edges, 4, block_nodes=100)
    assert np.allclose(values, np.cos(2 * np.pi * np.array([0, 1, 1, 2]) / n), rtol=0, atol=1e-8)
    v = np.array([r["vector"] for r in rows.orderBy("id").collect()])
    around = (np.roll(v, 1, axis=0) + np.roll(v, -1, axis=0)) / 2
    assert v.shape == (n, 4) and np.abs(around - v * values).max() < 1e-4 and np.allclose(v.T @ v, np.eye(4), atol=1e-6)


def test_too_few_steps_are_an_error(spark):
    edges = spark.range(60).select(F.col("id").alias("src"), ((F.col("id") + 1) % 60).alias("dst"), F.lit(1.0).alias("weight"))
    with pytest.raises(ArithmeticError):
        spectral.leading_eigenvectors(edges, 4, steps=3)


def test_separate_cliques_are_clusters(spark):
    points = [(10 * c + i, [100.0 * c + 0.1 * i, float(i % 3)]) for c in range(3) for i in range(8)]
    got = {r["id"]: r["cluster"] for r in models.graph_clusters(spark.createDataFrame(points, "id long, v array<double>"), "id", "v", 3, k=3).collect()}
    assert len(got) == 24 and len({frozenset(i for i in got if got[i] == c) for c in got.values()}) == 3
    assert all(len({got[10 * c + i] for i in range(8)}) == 1 for c in range(3))
    empty = spark.createDataFrame([], "id long, v array<double>")
    assert models.graph_clusters(empty, "id", "v", 3).count() == 0
