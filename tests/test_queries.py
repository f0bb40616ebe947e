"""Every registered query beside its SQL on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

from featherloom.catalog import all_books
from featherloom.catalog.base import Tables
from featherloom.sources import generated
from tools.check import compare, connect

BOOKS = list(all_books())
QUERIES = {name: (fn, book.sql.get(name)) for book in BOOKS for name, fn in book.queries.items()}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


# many model fits each; run with FULL_QUERIES=1
SLOW = {"m03_char_ngram_words", "m04_text_mixture_clusters", "m08_base_models", "m08_base_classifiers", "m09_feature_subset_bagging",
        "m10_bootstrap_bagging", "m11_out_of_fold_stacking", "v15_threshold_search"}


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, folder, con, name):
    if name in SLOW and not os.environ.get("FULL_QUERIES"):
        pytest.skip("slow; set FULL_QUERIES=1")
    fn, sql = QUERIES[name]
    verdict, rows = compare(Tables(spark, folder), con, fn, sql)
    assert verdict in ("ok", "rows-only"), verdict
    assert rows > 0


def test_every_section_is_registered():
    letters = {name[0] for name in QUERIES}
    assert letters >= set("spjawtufrqeckmvx")


def test_whole_tables_are_used(spark, folder):
    """The full-table queries take every order, vector position and element."""
    t = Tables(spark, folder)
    june = QUERIES["r08_resample_monthly_all"][0](t).where("month like '%-06'").collect()
    assert june and all(r["mean"] is not None for r in june)
    seen = QUERIES["s07_vector_log_all"][0](t).groupBy().sum("n").first()[0]
    assert seen == sum(len(r["embedding"]) for r in t.embeddings.collect())


def test_grid_is_dealt_over_tasks(spark):
    bounds = spark.range(1)
    cells = generated.grid(bounds, F.lit(70), F.lit(30))
    assert {tuple(r) for r in cells.collect()} == {(x, y) for x in range(70) for y in range(30)}
    assert max(n for n in cells.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()) < 70 * 30
    assert generated.grid(bounds, F.lit(0), F.lit(30)).count() == generated.grid(bounds, F.lit(None), F.lit(30)).count() == 0
