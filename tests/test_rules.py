"""Rule tables beside every rule tried on every text."""

import random
import re

import pytest

from featherloom.operators.rules import match_rules

RULES = "priority int, needs string, pattern string, cluster int"


def plain(text, rules, default=-1):
    if text is None:
        return default
    low = text.lower()
    hits = [(p, c) for p, needs, pattern, c in rules if p is not None and c is not None and (needs or "").lower() in low and (pattern is None or re.search(pattern, low))]
    return max(hits)[1] if hits else default


@pytest.mark.parametrize("block_rules", [200_000, 40])
def test_rules_match_as_if_all_were_tried(spark, block_rules):
    r = random.Random(11)
    words = ["".join(r.choice("abcäß") for _ in range(r.randrange(1, 5))) for _ in range(90)]
    rules = [(r.randrange(60), w.upper() if i % 9 == 0 else w, f"(^| ){w}" if i % 3 == 0 else None, i % 7) for i, w in enumerate(words)]
    rules += [rules[3], (None, "a", None, 9), (99, "a", None, None), (-5, None, "c+ä", 30), (-6, "", "b$", 31)]
    texts = [" ".join("".join(r.choice("abcÄßx") for _ in range(r.randrange(1, 9))) for _ in range(r.randrange(0, 6))) for _ in range(60)]
    texts += [None, "", "xyz", "a.c", texts[0], "ab " * 50_000]
    d = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "id long, body string, priority long")
    got = match_rules(d, "body", spark.createDataFrame(rules, RULES), block_rules=block_rules)
    assert got.columns == ["id", "body", "priority", "cluster"]
    rows = got.collect()
    assert len(rows) == len(texts)
    assert [(x["id"], x["cluster"]) for x in sorted(rows)] == [(i, plain(t, rules)) for i, t in enumerate(texts)]


def test_no_rules_and_no_texts(spark):
    d = spark.createDataFrame([(1, "abc")], "id long, body string")
    none = spark.createDataFrame([], RULES)
    assert [r["cluster"] for r in match_rules(d, "body", none, default=7).collect()] == [7]
    assert match_rules(d.where("false"), "body", spark.createDataFrame([(1, "a", None, 2)], RULES)).count() == 0
