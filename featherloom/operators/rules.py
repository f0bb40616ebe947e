"""Keyword rules kept as a table, so that thousands of them cost little more than a few.

Every rule names a literal that its matches hold. One automaton finds all literals of a text in one pass over it, whatever their number;
only rules whose literals occur are tried, from the last one down, and the first that matches is the answer. Texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from featherloom.session import materialize

BLOCK_RULES = 200_000  # rules that one automaton holds


def _best_rule(rules: list[tuple], text_at: int):
    """Task body: the last three columns are the lower-case text and the best rule of earlier blocks; the text is kept for later ones."""

    def run(batches):
        import re

        import ahocorasick
        import pyarrow as pa

        by_literal: dict[str, list[int]] = {}
        for i, (_, needs, _, _) in enumerate(rules):  # ascending (priority, cluster)
            by_literal.setdefault(needs, []).append(i)
        always = by_literal.pop("", [])
        found = ahocorasick.Automaton()
        for needs, at in by_literal.items():
            found.add_word(needs, at)
        found.make_automaton()
        patterns = [p and re.compile(p) for _, _, p, _ in rules]

        def best(text, priority, cluster):
            met = {id(at): at for _, at in found.iter(text)} if by_literal else {}
            for i in sorted((i for at in [always, *met.values()] for i in at), reverse=True):
                if patterns[i] is None or patterns[i].search(text):
                    mine = (rules[i][0], rules[i][3])
                    return mine if priority is None or mine > (priority, cluster) else (priority, cluster)
            return priority, cluster

        for b in batches:
            texts, earlier = b.column(text_at).to_pylist(), zip(b.column(text_at + 1).to_pylist(), b.column(text_at + 2).to_pylist())
            hits = [(p, c) if t is None else best(t, p, c) for t, (p, c) in zip(texts, earlier)]
            cols = [*b.columns[:text_at + 1], pa.array([p for p, _ in hits], pa.int64()), pa.array([c for _, c in hits], pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return run


def match_rules(df: DataFrame, text: str, rules: DataFrame, out: str = "cluster", default: int = -1, block_rules: int = BLOCK_RULES) -> DataFrame:
    """``df`` with the cluster of the matching rule that has the greatest ``(priority, cluster)``, or ``default``.

    ``rules`` is a table ``(priority, needs, pattern, cluster)`` of whole numbers and strings. A rule matches a text whose lower-case form holds
    ``needs`` and in which ``pattern``, if given, is found (a Python expression, on the lower-case text). ``needs`` may be null or empty: such a
    rule is tried on every text. Rules with a null priority or cluster do not count. A null text matches nothing. ``needs`` is put into lower case.

    The rules go to the tasks through the driver, ``block_rules`` at a time: a longer table is dealt into blocks by a hash, with a pass each and a
    written table between them, so no task holds more than about one block.
    """
    table = rules.select(F.col("priority").cast("long").alias("priority"), F.lower(F.coalesce("needs", F.lit(""))).alias("needs"), "pattern",
                         F.col("cluster").cast("int").alias("cluster")).where("priority IS NOT NULL AND cluster IS NOT NULL").distinct()
    table = materialize(table, "rules")
    blocks = max(1, -(-table.count() // block_rules))
    shape = StructType([*df.schema.fields]).add("__text", "string").add("__priority", LongType()).add("__cluster", IntegerType())
    d = df.withColumns({"__text": F.lower(F.col(text)), "__priority": F.lit(None).cast("long"), "__cluster": F.lit(None).cast("int")})
    for block in range(blocks):
        mine = table.where(F.pmod(F.xxhash64(*table.columns), F.lit(blocks)) == block).collect()
        ordered = sorted(((r["priority"], r["needs"], r["pattern"], r["cluster"]) for r in mine), key=lambda r: (r[0], r[3]))
        d = (materialize(d, "ruled") if block else d).mapInArrow(_best_rule(ordered, len(df.columns)), shape)
    return d.select(*df.columns, F.coalesce("__cluster", F.lit(default)).alias(out))
