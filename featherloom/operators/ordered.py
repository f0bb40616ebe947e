"""Order-dependent operators that never put one whole group into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sends every row of a hot key to one task.
Here the rows are dealt into ranges of (key, order), sorted inside them and written once to the
shared folder; a chunk is a stretch of at most ``chunk_rows`` rows of a range. Windows run per
``(key, chunk)``; what a chunk needs from earlier chunks comes from a summary with one row per
``(key, chunk)``. The number of chunks follows the number of rows, and no value, however frequent,
is kept together. The table is written because range bounds come from a sample: rows and summary
must see the same cut.

Order specs are column names; a leading ``-`` means descending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featherloom.session import materialize

_KEY, _CHUNK, _AT, _BLOCK = "__key", "__chunk", "__at", "__block"
CHUNK_ROWS = 1 << 20


def _split(spec: str) -> tuple[str, bool]:
    return (spec[1:], True) if spec.startswith("-") else (spec, False)


def sort_columns(order: list[str]) -> list[Column]:
    out = []
    for spec in order:
        name, desc = _split(spec)
        out.append(F.col(name).desc_nulls_last() if desc else F.col(name).asc_nulls_first())
    return out


def ranged(df: DataFrame, keys: list[str], order: list[str], label: str = "ordered") -> DataFrame:
    """``df`` in ranges of (keys, order), written, with ``__part`` and the row's place ``__at`` in it.

    A running id as last range column lets even rows that tie in everything be cut.
    """
    sort = [*[F.col(k).asc_nulls_first() for k in keys], *sort_columns(order), F.col("__salt")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(n, *sort).sortWithinPartitions(*sort).drop("__salt")
    written = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()), label)
    return written.withColumns({"__part": F.shiftright("__id", 33), _AT: F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("__id")


def _chunked(df: DataFrame, keys: list[str], order: list[str], chunk_rows: int | None) -> DataFrame:
    # struct keys compare equal field by field, nulls included
    key = F.struct(*keys) if keys else F.struct(F.lit(0))
    stretch = F.floor(F.col(_AT) / F.lit(chunk_rows or CHUNK_ROWS))
    chunk = F.shiftleft("__part", 33).bitwiseOR(stretch.cast("long"))
    return ranged(df, keys, order).withColumns({_KEY: key, _CHUNK: chunk}).drop("__part")


_AGG = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _merge(kind: str, local: Column, carry: Column) -> Column:
    if kind == "count":
        return local + F.coalesce(carry, F.lit(0))
    if kind == "sum":
        return F.when(local.isNull(), carry).otherwise(local + F.coalesce(carry, F.lit(0)))
    return F.greatest(local, carry) if kind == "max" else F.least(local, carry)


def _keyed_join(left: DataFrame, right: DataFrame) -> DataFrame:
    r = right.withColumnsRenamed({_KEY: "__rkey", _CHUNK: "__rchunk"})
    on = (F.col(_KEY) == F.col("__rkey")) & (F.col(_CHUNK) == F.col("__rchunk"))
    return left.join(r, on, "left").drop("__rkey", "__rchunk")


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    aggs: dict[str, tuple[str, Column]],
    *,
    exclusive: bool = False,
    totals: bool = False,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add running aggregates per key, up to the row (or before it when ``exclusive``).

    ``aggs`` maps the new column to ``(sum|count|max|min, expression)``. Rows that tie in
    ``order`` follow one another in some order. ``totals`` also adds ``<name>_total`` over the whole key.
    """
    d = _chunked(df, keys, order, chunk_rows)
    frame = Window.partitionBy(_KEY, _CHUNK).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    before = Window.partitionBy(_KEY).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(_KEY)
    per_chunk = d.groupBy(_KEY, _CHUNK).agg(*[_AGG[k](e).alias(n) for n, (k, e) in aggs.items()])
    again = {n: ("sum" if k == "count" else k) for n, (k, _) in aggs.items()}
    carry = per_chunk.select(
        _KEY, _CHUNK,
        *[_AGG[again[n]](n).over(before).alias(f"__carry_{n}") for n in aggs],
        *([_AGG[again[n]](n).over(whole).alias(f"{n}_total") for n in aggs] if totals else []),
    )
    local = d.withColumns({f"__local_{n}": _AGG[k](e).over(frame) for n, (k, e) in aggs.items()})
    out = _keyed_join(local, carry)
    out = out.withColumns({
        n: _merge(k, F.col(f"__local_{n}"), F.col(f"__carry_{n}")) for n, (k, _) in aggs.items()
    })
    extra = [f"{n}_total" for n in aggs] if totals else []
    return out.select(*df.columns, *aggs, *extra)


def positions(df: DataFrame, keys: list[str], order: list[str], name: str = "pos", **opts) -> DataFrame:
    """Row number per key, from 1, in a unique order."""
    return running(df, keys, order, {name: ("count", F.lit(1))}, **opts)


def previous(
    df: DataFrame, keys: list[str], order: list[str], cols: dict[str, Column], chunk_rows: int | None = None
) -> DataFrame:
    """Add the values of the row before (null on a key's first row)."""
    d = _chunked(df, keys, order, chunk_rows).withColumn("__row", F.struct(*[e.alias(n) for n, e in cols.items()]))
    w = Window.partitionBy(_KEY, _CHUNK).orderBy(_AT)
    last = d.groupBy(_KEY, _CHUNK).agg(F.max_by("__row", _AT).alias("__last"))
    carry = last.select(
        _KEY, _CHUNK, F.lag("__last").over(Window.partitionBy(_KEY).orderBy(_CHUNK)).alias("__carry")
    )
    out = _keyed_join(d.withColumn("__prev", F.lag("__row").over(w)), carry)
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    return out.select(*df.columns, *[prev[n].alias(n) for n in cols])


def known_around(
    df: DataFrame, keys: list[str], order: list[str], cols: dict[str, Column], present: Column,
    chunk_rows: int | None = None, pos: str | None = None,
) -> DataFrame:
    """Values of the closest row where ``present`` holds, as ``prev_<name>`` (at or before this
    row) and ``next_<name>`` (at or after it).

    ``pos`` also gives the row's number per key, from 1, and the numbers ``prev_<pos>`` and ``next_<pos>`` of those
    closest rows, in the same pass.
    """
    d = _chunked(df, keys, order, chunk_rows)
    up = Window.partitionBy(_KEY, _CHUNK).orderBy(_AT)
    d = d.withColumn("__n", F.row_number().over(up))
    d = d.withColumn("__row", F.when(present, F.struct(F.col("__n").cast("long").alias("__n"), *[e.alias(n) for n, e in cols.items()])))
    # a descending running frame: frames that reach to the end are recomputed for every row
    so_far = (Window.unboundedPreceding, 0)
    after = Window.partitionBy(_KEY, _CHUNK).orderBy(F.desc(_AT)).rowsBetween(*so_far)
    steps, back = (Window.partitionBy(_KEY).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.asc(_CHUNK), F.desc(_CHUNK)))
    ends = d.groupBy(_KEY, _CHUNK).agg(
        F.max_by("__row", F.when(F.col("__row").isNotNull(), F.col(_AT))).alias("hi"),
        F.min_by("__row", F.when(F.col("__row").isNotNull(), F.col(_AT))).alias("lo"), F.count("*").alias("rows"))
    first = F.coalesce(F.sum("rows").over(steps), F.lit(0))

    def moved(row: Column, by: Column) -> Column:
        return F.when(row.isNotNull(), row.withField("__n", row["__n"] + by))

    ends = ends.withColumn("__first", first).withColumns({"hi": moved(F.col("hi"), F.col("__first")), "lo": moved(F.col("lo"), F.col("__first"))})
    carry = ends.select(_KEY, _CHUNK, "__first", F.last("hi", True).over(steps).alias("__before"), F.last("lo", True).over(back).alias("__after"))
    local = d.withColumns({"__prev": F.last("__row", True).over(up.rowsBetween(*so_far)), "__next": F.last("__row", True).over(after)})
    out = _keyed_join(local, carry)
    prev = F.coalesce(moved(F.col("__prev"), F.col("__first")), F.col("__before"))
    nxt = F.coalesce(moved(F.col("__next"), F.col("__first")), F.col("__after"))
    numbers = [(F.col("__n") + F.col("__first")).alias(pos), prev["__n"].alias(f"prev_{pos}"), nxt["__n"].alias(f"next_{pos}")] if pos else []
    return out.select(*df.columns, *numbers, *[prev[n].alias(f"prev_{n}") for n in cols], *[nxt[n].alias(f"next_{n}") for n in cols])


def last_known(
    df: DataFrame, keys: list[str], order: list[str], cols: dict[str, Column], present: Column, **opts
) -> DataFrame:
    """Values of the latest row at or before this one where ``present`` holds (ascending order)."""
    row = F.struct(*[F.col(s).alias(f"o{i}") for i, s in enumerate(order)], *[e.alias(n) for n, e in cols.items()])
    out = running(df, keys, order, {"__known": ("max", F.when(present, row))}, **opts)
    return out.select(*df.columns, *[F.col("__known")[n].alias(n) for n in cols])


def rolling(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows: int,
    aggs: dict[str, Column],
    *,
    block_rows: int = 500_000,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Aggregates over the last ``rows`` rows per key.

    Rows get their position, positions are cut into blocks, and the last ``rows - 1`` rows of a
    block are also sent to the next one, so each block is complete on its own. Keys with at most
    ``block_rows`` rows need one block and no copies.
    """
    size = max(block_rows, 4 * rows)
    d = positions(df, keys, order, "__pos", chunk_rows=chunk_rows)
    d = d.withColumn(_KEY, F.struct(*keys) if keys else F.struct(F.lit(0)))
    home = F.floor((F.col("__pos") - 1) / size)
    tail = (F.col("__pos") - 1) % size >= size - (rows - 1)
    d = d.withColumn("__home", home).withColumn(
        _BLOCK, F.explode(F.when(tail, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home")))
    )
    frame = Window.partitionBy(_KEY, _BLOCK).orderBy("__pos").rowsBetween(-(rows - 1), 0)
    d = d.withColumns({n: e.over(frame) for n, e in aggs.items()})
    return d.where(F.col(_BLOCK) == F.col("__home")).select(*df.columns, *aggs)


def group_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], chunk_rows: int | None = None
) -> DataFrame:
    """Exact linear-interpolation quantiles per key (whole table when ``keys`` is empty).

    Values are counted first, then located by running counts, so neither one key nor the whole
    column ever sits in one task's buffer. A key without values gets nulls.
    """
    freq = df.groupBy(*keys, value).agg(F.count(value).alias("__n"))
    return quantiles_of_counts(freq, keys, value, "__n", probs, chunk_rows)


def quantiles_of_counts(
    freq: DataFrame, keys: list[str], value: str, n: str, probs: dict[str, float], chunk_rows: int | None = None
) -> DataFrame:
    """:func:`group_quantiles` of a table that already holds each value once per key with its count."""
    freq = freq.select(*keys, value, F.col(n).alias("__n"))
    run = running(freq, keys, [value], {"__hi": ("sum", F.col("__n"))}, totals=True, chunk_rows=chunk_rows)
    lo, hi = F.col("__hi") - F.col("__n"), F.col("__hi")

    def at(rank: Column) -> Column:
        return (lo <= rank) & (rank < hi)

    last = F.col("__hi_total") - 1
    low = {n: F.floor(last * F.lit(float(p))) for n, p in probs.items()}
    high = {n: F.ceil(last * F.lit(float(p))) for n, p in probs.items()}
    wanted = F.col(value).isNull()  # keeps keys that have no value at all
    for n in probs:
        wanted = wanted | at(low[n]) | at(high[n])
    parts = []
    for n in probs:
        parts += [F.max(F.when(at(low[n]), F.col(value))).alias(f"__l_{n}"),
                  F.max(F.when(at(high[n]), F.col(value))).alias(f"__h_{n}")]
    picked = run.where(wanted).groupBy(*keys).agg(F.max("__hi_total").alias("__hi_total"), *parts)
    out = []
    for n, p in probs.items():
        frac = last * F.lit(float(p)) - low[n]
        lv, hv = F.col(f"__l_{n}").cast("double"), F.col(f"__h_{n}").cast("double")
        out.append((lv + (hv - lv) * frac).alias(n))
    return picked.select(*keys, *out)
