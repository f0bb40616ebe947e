"""Merkle manifest of a table: one ternary hash tree per group, one over the groups, and a proof for every row by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherloom.llm.common import number_rows, ordered
from featherloom.session import materialize

FAN = 3
STEP = 4  # levels that one block spans, so a block has at most FAN ** STEP digests
BLOCK = FAN ** STEP
CHUNK = 1 << 12  # leaves under one ancestor that share a join key
INNER, TOP, ROOT = 0, 1, 2  # trees of the groups, tree over them, end
STEPS = "array<struct<l: binary, r: binary>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, put one after another."""
    return F.sha2(F.concat(*map(field, values)), 256)


def proof_text(proof: Column) -> Column:
    """The digests of a proof as hex text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.lower(F.concat(F.hex(s["l"]), F.hex(s["r"])))), "")


def fold(digest: Column, proof: Column) -> Column:
    """The root that ``digest`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, digest, lambda acc, s: F.sha2(F.concat(F.lower(F.hex(s["l"])), acc, F.lower(F.hex(s["r"]))), 256))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves: the least h with FAN ** h >= n."""
    return sum((F.when(n > FAN ** i, 1).otherwise(0) for i in range(39)), F.lit(0))


def _up(level: Column) -> Column:
    """The next level: each FAN consecutive digests become the digest of their concatenation."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda q: F.sha2(F.array_join(F.slice(level, q * FAN + 1, F.lit(FAN)), ""), 256))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` (g, k, d, r) with ``p0`` and ``n``, first place and size of the group, ``j``, place in it, and ``lo``, place in the whole order.

    Rows are dealt by ranges of (group, key), so a hot group is cut over many tasks; the rest comes from one row per (range, group).
    """
    at = ordered(rows, [F.col("g").asc_nulls_first(), F.col("k").asc_nulls_first(), F.col("d")], "merkle-order")
    groups = at.groupBy("__part", "g").agg(F.count("*").alias("m"), F.min("__at").alias("at0"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, so at most as many as there are shuffle partitions: small enough to broadcast
    firsts = at.groupBy("__part").agg(F.count("*").alias("c")).select(
        F.col("__part").alias("__p"), F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("first"))
    own = Window.partitionBy("g")
    groups = groups.join(F.broadcast(firsts), F.col("__part") == F.col("__p")).select(
        "__p", F.col("g").alias("__g"), "at0", F.sum("m").over(own).alias("n"), F.min(F.col("first") + F.col("at0")).over(own).alias("p0"),
        F.coalesce(F.sum("m").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    j = F.col("__at") - F.col("at0") + F.col("before")
    return at.join(groups, (F.col("__part") == F.col("__p")) & F.col("g").eqNullSafe(F.col("__g"))).select(
        "p0", "n", j.alias("j"), (F.col("p0") + j).alias("lo"), "d", "r")


def _grow(nodes: DataFrame, kind: int, label: str) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes`` (t, h, j, lo, hi, d, r): tree, its height, place among its leaves, leaves of the table below, digest, carried row.

    Returns the tree roots (t, lo, hi, d) and the jump table (kind, k, lo, hi, to_kind, to_k, to_lo, steps, sub, d, r): every node whose level
    is a multiple of STEP holds the siblings on its way to the node that many levels up, or to the root of its tree if that comes first.
    """
    no_row = F.lit(None).cast(nodes.schema["r"].dataType)
    after = kind + 1
    none = F.lit(None).cast("string")
    single = nodes.where("h = 0")
    roots = [single.select("t", "lo", "hi", "d")]
    jumps = [single.select(
        F.lit(kind).alias("kind"), F.lit(0).alias("k"), "lo", "hi", F.lit(after).alias("to_kind"), F.lit(0).alias("to_k"), F.col("lo").alias("to_lo"),
        F.array().cast(STEPS).alias("steps"), F.col("d").alias("sub"), "d", "r")]
    highest = nodes.agg(F.max("h")).first()[0] or 0
    for k, level in enumerate(range(0, highest, STEP)):
        block = nodes.where(F.col("h") > level).groupBy("t", "h", F.floor(F.col("j") / BLOCK).alias("b")).agg(
            F.sort_array(F.collect_list(F.struct("j", "lo", "hi", "d", "r"))).alias("m"))
        block = block.withColumn("l0", F.transform("m", lambda x: x["d"]))
        for q in range(STEP):
            block = block.withColumn(f"l{q + 1}", _up(F.col(f"l{q}")))
        done = F.col("h") <= level + STEP
        span = F.least(F.lit(STEP), F.col("h") - level)
        top = F.get(F.element_at(F.array(*[F.col(f"l{q}") for q in range(1, STEP + 1)]), span), F.lit(0))
        block = materialize(block.withColumns({"top": top, "span": span, "done": done, "blo": F.get("m", F.lit(0))["lo"], "bhi": F.element_at("m", -1)["hi"]}),
                            f"{label}-{k}")
        roots.append(block.where("done").select("t", F.col("blo").alias("lo"), F.col("bhi").alias("hi"), F.col("top").alias("d")))
        x = F.col("x")

        def sibling(q: int) -> Column:
            at, digests = F.floor(x / FAN ** q).cast("int"), F.col(f"l{q}")
            left, right = F.slice(digests, at - at % FAN + 1, at % FAN), F.slice(digests, at + 2, FAN - 1 - at % FAN)
            return F.struct(F.unhex(F.array_join(left, "")).alias("l"), F.unhex(F.array_join(right, "")).alias("r"))

        jumps.append(block.select("*", F.posexplode("m").alias("x", "node")).select(
            F.lit(kind).alias("kind"), F.lit(k).alias("k"), F.col("node.lo").alias("lo"), F.col("node.hi").alias("hi"),
            F.when(F.col("done"), after).otherwise(kind).alias("to_kind"), F.when(F.col("done"), 0).otherwise(k + 1).alias("to_k"), F.col("blo").alias("to_lo"),
            F.slice(F.array(*map(sibling, range(STEP))), F.lit(1), F.col("span")).alias("steps"), F.when(F.col("done"), F.col("top")).otherwise(none).alias("sub"),
            F.col("node.d").alias("d"), F.col("node.r").alias("r")))
        nodes = block.where(~F.col("done")).select("t", "h", F.col("b").alias("j"), F.col("blo").alias("lo"), F.col("bhi").alias("hi"), F.col("top").alias("d"),
                                                   no_row.alias("r"))

    def union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        return whole

    return union(roots), union(jumps)


def proofs(rows: DataFrame, group: str, key: str, digest: str) -> DataFrame:
    """``rows`` plus ``subroot``, ``root`` and ``proof``, for every row. ``digest`` (lowercase hex) is the row's leaf.

    Per ``group`` (nulls are one group) leaves ascend by ``key`` (null first), ties by digest; rows equal in all three are interchangeable.
    While a level has several nodes, each three consecutive ones become one; a lone leaf is the group's root. The roots of the groups, ordered by
    group (null first, by bytes), are the leaves of a last tree. ``proof`` is an array of (l, r): the digests left and right of the way up, as bytes.

    Every fourth level's nodes first hold the siblings of the four levels above them (a block of 81 digests knows them). Then the table is joined
    with itself: a node takes over the ancestor of its ancestor and that one's siblings, so the distance doubles until all leaves hold the way to
    the root. Only nodes that later rounds can meet are kept. A high ancestor has many nodes below it, so it is copied once per CHUNK leaves it
    covers and met under (ancestor, chunk): no key holds more than CHUNK leaves, whatever the size of the group.

    An empty table gives no rows. Columns named subroot, root or proof are replaced, others are kept under any name.
    """
    kept = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    held = materialize(rows.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(digest).alias("d"), F.struct(*[F.col(c) for c in kept]).alias("r")),
                       "merkle-leaves")
    leaves = materialize(_placed(held), "merkle-placed").select(
        F.col("p0").alias("t"), _height(F.col("n")).alias("h"), "j", "lo", (F.col("lo") + 1).alias("hi"), "d", "r")
    subroots, inner = _grow(leaves, INNER, "merkle-inner")
    numbered = number_rows(subroots.select("lo", "hi", "d"), [F.col("lo")], "j", "merkle-groups")
    count = numbered.count()
    top = numbered.select(F.lit(0).cast("long").alias("t"), _height(F.lit(count)).alias("h"), "j", "lo", "hi", "d",
                          F.lit(None).cast(leaves.schema["r"].dataType).alias("r"))
    _, over = _grow(top, TOP, "merkle-top")
    none = F.lit(None).cast("string")
    table = inner.withColumn("root", none).unionByName(over.withColumn("root", F.col("sub")).withColumn("sub", none))
    table = materialize(table, "merkle-jumps")
    far = table.groupBy("kind").agg(F.max("k").alias("k")).collect()  # two rows
    hops = sum(r["k"] + 1 for r in far)
    reach = 1
    while reach < hops:
        y = table.select(*[F.col(c).alias(f"y_{c}") for c in ("kind", "k", "lo", "to_kind", "to_k", "to_lo", "steps", "sub", "root")], F.explode(
            F.sequence(F.floor(F.col("lo") / CHUNK), F.floor((F.col("hi") - 1) / CHUNK))).alias("y_chunk"))
        x = table.where(f"kind = {TOP} or k % {2 * reach} = 0")
        ended = F.col("y_kind").isNull()
        table = x.join(y, (F.col("to_kind") == F.col("y_kind")) & (F.col("to_k") == F.col("y_k")) & (F.col("to_lo") == F.col("y_lo")) &
                       (F.floor(F.col("lo") / CHUNK) == F.col("y_chunk")), "left").select(
            "kind", "k", "lo", "hi", F.when(ended, F.lit(ROOT)).otherwise(F.col("y_to_kind")).alias("to_kind"),
            F.when(ended, F.lit(0)).otherwise(F.col("y_to_k")).alias("to_k"),
            F.when(ended | (F.col("y_to_kind") == ROOT), F.col("lo")).otherwise(F.col("y_to_lo")).alias("to_lo"),
            F.concat("steps", F.coalesce("y_steps", F.array().cast(STEPS))).alias("steps"), F.coalesce("sub", "y_sub").alias("sub"), "d", "r",
            F.coalesce("root", "y_root").alias("root"))
        reach *= 2
        if reach < hops:
            table = materialize(table, "merkle-jumps")
    return table.where(f"kind = {INNER} and k = 0").select(
        "r.*", F.col("sub").alias("subroot"), "root", F.col("steps").alias("proof"))
