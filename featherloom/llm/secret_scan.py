"""Secret scan over a ledger of content-addressed blobs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featherloom.session import scratch_path

SPAN = "array<struct<start:bigint,end:bigint>>"


def none() -> Column:
    return F.expr(f"cast(array() as {SPAN})")



@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if the given group has enough characters."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


# fixed values: the base rules, in the order in which kinds tie
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, end) of the rule's matches: code points, end exclusive.

    The pieces between matches and the matches themselves alternate, so running lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    long_enough = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda g: F.char_length(g) >= rule.least)
    steps = F.zip_with(F.transform(F.split(text, rule.pattern, -1), F.char_length), F.zip_with(
        F.transform(found, F.char_length), long_enough, lambda n, ok: F.struct(n.alias("n"), ok.alias("ok"))),
        lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none().alias("spans"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + s["gap"]
        end = begin + F.coalesce(s["hit"]["n"], F.lit(0))
        span = F.array(F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return F.struct(end.cast("bigint").alias("at"),
                        F.when(s["hit"]["ok"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(steps, start, step, lambda s: s["spans"])


def _may_match(text: Column, rule: Rule) -> Column:
    """A cheap test that no counted match escapes."""
    if rule.group == 0 and rule.pattern.endswith("]+"):  # a run of one class: only runs that are long enough matter
        fixed = len(rule.pattern[:rule.pattern.index("[")])
        return F.rlike(text, F.lit(f"{rule.pattern[:-1]}{{{rule.least - fixed},}}"))
    return F.rlike(text, F.lit(rule.pattern))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    schema = f"blob string, kind string, version int, spans {SPAN}"
    try:
        return spark.read.schema(schema).parquet(path).dropDuplicates(["blob", "kind", "version"])
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def scan(files: DataFrame, ledger: str, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Bring the ledger at ``ledger`` (a folder all executors share) up to date with ``files`` and ``rules``.

    ``files`` holds one row per historical version of a file. Each text is addressed by its SHA-256; of all rows with the same text one is
    scanned, and only for the (blob, rule version) pairs that the ledger lacks. What was scanned is appended, found or not, so the next
    call pays for new texts and new rule versions only. A call that fails before the append is repeated whole; pairs that stand twice in
    the ledger count once. Null texts are empty texts; ``path`` may be null or repeat.
    """
    spark = files.sparkSession
    rows = files.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("blob", F.sha2("text", 256))
    # one row per text stands for its copies; hashes move, texts stay until the chosen rows are known
    chosen = rows.groupBy("blob").agg(F.min("path").alias("path"))
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    unseen = chosen.select("blob", "path", F.explode(table).alias("r")).select("blob", "path", "r.*").join(
        read_ledger(spark, ledger).select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
    due = unseen.groupBy(F.col("blob").alias("__blob"), F.col("path").alias("__path")).agg(F.collect_set("kind").alias("due"))
    # a path may hold several texts, so both identify the row; equal rows scanned twice count once in the ledger
    todo = rows.join(due, (F.col("blob") == F.col("__blob")) & F.col("path").eqNullSafe(F.col("__path")))
    scanned = F.array(*[F.struct(
        F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.array_contains("due", r.kind).alias("due"),
        F.when(F.array_contains("due", r.kind) & _may_match(F.col("text"), r), matches(F.col("text"), r)).otherwise(none()).alias("spans"))
        for r in rules])
    todo.select("blob", F.explode(scanned).alias("r")).where("r.due").select("blob", "r.kind", "r.version", "r.spans").write.mode("append").parquet(ledger)


def current(spark: SparkSession, ledger: str, rules: tuple[Rule, ...]) -> DataFrame:
    """The ledger's findings (blob, kind, version, spans) under the present rule versions."""
    wanted = reduce(lambda a, b: a | b, [(F.col("kind") == r.kind) & (F.col("version") == r.version) for r in rules])
    return read_ledger(spark, ledger).where(wanted & (F.size("spans") > 0))


def findings(files: DataFrame, ledger: str, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan, then join back to all paths: path, blob, kind, version, spans for every path and rule with a finding."""
    scan(files, ledger, path, text, rules)
    rows = files.select(F.col(path).alias("path"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    return rows.join(current(files.sparkSession, ledger, rules), "blob")


def summary(files: DataFrame, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: str | None = None) -> DataFrame:
    """Scan, then one row per row of ``files``: path, blob, counts per kind, ``spans`` (kind:start:end by start, then rule order, comma-joined)."""
    spark = files.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    scan(files, ledger, path, text, rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    per_blob = current(spark, ledger, rules).groupBy("blob").agg(
        F.array_sort(F.flatten(F.collect_list(F.transform("spans", lambda s: F.struct(
            s["start"].alias("start"), F.element_at(rank, F.col("kind")).alias("rank"), F.col("kind").alias("kind"), s["end"].alias("end")))))).alias("found"))
    rows = files.select(F.col(path).alias("path"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("blob"))
    joined = rows.join(per_blob, "blob", "left")
    found = F.coalesce("found", F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint>>)"))
    kinds = F.transform(found, lambda s: s["kind"])
    counts = {f"n_{r.kind}": (F.size(kinds) - F.size(F.array_remove(kinds, r.kind))).cast("long") for r in rules}
    spans = F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return joined.select("path", "blob", *[c.alias(n) for n, c in counts.items()], spans.alias("spans"))
