"""Row-wise functions over several columns of one row."""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featherloom.functions.numbers import finite


def columns_by_type(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_by_type(df, T.NumericType)


def columns_by_name(df: DataFrame, pattern: str) -> list[str]:
    """Columns whose name matches a regular expression from its start."""
    return [c for c in df.columns if re.match(pattern, c)]


def clean_names(df: DataFrame) -> DataFrame:
    """Everything but letters, digits and underscore becomes an underscore."""
    return df.toDF(*[re.sub(r"[^a-zA-Z0-9_]", "_", c) for c in df.columns])


def align_to(df: DataFrame, schema: T.StructType, fill=0) -> DataFrame:
    """Exactly the columns of ``schema``: extra ones dropped, missing ones filled."""
    have = set(df.columns)
    return df.select([
        F.col(f.name) if f.name in have else F.lit(fill).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _array(cols: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def _fold(values: Column, step) -> Column:
    return F.aggregate(values, F.lit(0.0), step)


def row_sum(cols: list[str]) -> Column:
    return _fold(F.filter(_array(cols), lambda x: x.isNotNull()), lambda a, x: a + x)


def row_count(cols: list[str]) -> Column:
    return F.size(F.filter(_array(cols), lambda x: x.isNotNull()))


def row_mean(cols: list[str]) -> Column:
    return F.try_divide(row_sum(cols), row_count(cols))


def row_min(cols: list[str]) -> Column:
    return F.array_min(_array(cols))


def row_max(cols: list[str]) -> Column:
    return F.array_max(_array(cols))


def row_std(cols: list[str]) -> Column:
    """Sample deviation; null for fewer than two values."""
    present = F.filter(_array(cols), lambda x: x.isNotNull())
    mean = row_mean(cols)
    squares = _fold(present, lambda a, x: a + (x - mean) * (x - mean))
    return F.sqrt(F.try_divide(squares, F.size(present) - 1))


def row_median(cols: list[str]) -> Column:
    v = F.sort_array(F.filter(_array(cols), lambda x: x.isNotNull()))
    n = F.size(v)
    half = F.floor((n - 1) / 2).cast("int")
    other = F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(v, half) + F.get(v, other)) / 2)


def row_entropy(cols: list[str]) -> Column:
    """Entropy in nats of the row's values after dividing by their sum (by 1 when it is 0)."""
    total = row_sum(cols)
    base = F.when(total == 0, 1.0).otherwise(total)
    return _fold(_array(cols), lambda a, x: a - F.when(x / base > 0, x / base * F.ln(x / base)).otherwise(0.0))


def row_rank(cols: list[str], target: str) -> Column:
    """Rank of one column's value inside its row, ties averaged."""
    v = _array(cols)
    x = F.col(target).cast("double")
    return 1 + F.size(F.filter(v, lambda e: e < x)) + (F.size(F.filter(v, lambda e: e == x)) - 1) / 2


def nth_null_label(cols: list[str], n: int) -> Column:
    """Name of the n-th null column (from 1), or null."""
    labels = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return F.get(F.filter(labels, lambda x: x.isNotNull()), F.lit(n - 1))


def pick_named(selector: Column, cols: list[str]) -> Column:
    """Value of the column whose name stands in ``selector``."""
    return F.coalesce(*[F.when(selector == c, F.col(c)) for c in cols])


def abs_differences(cols: list[str]) -> dict[str, Column]:
    return {f"abs_{a}_{b}": F.abs(F.col(a) - F.col(b)) for a, b in itertools.combinations(cols, 2)}


def polynomial(cols: list[str], degree: int = 2) -> dict[str, Column]:
    """Squares and pair products; degree 3 adds cubes and mixed cubes."""
    out = {f"{a}_sq": F.col(a) * F.col(a) for a in cols}
    out |= {f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in itertools.combinations(cols, 2)}
    if degree >= 3:
        out |= {f"{a}_cube": F.col(a) * F.col(a) * F.col(a) for a in cols}
        for a, b in itertools.combinations(cols, 2):
            out[f"{a}_sq_x_{b}"] = F.col(a) * F.col(a) * F.col(b)
            out[f"{a}_x_{b}_sq"] = F.col(a) * F.col(b) * F.col(b)
    return out


def pair_arithmetic(cols: list[str], eps: float = 1e-6) -> dict[str, Column]:
    """Sum, difference, product, guarded ratio and ``sqrt(a^2 - b^2)`` (null when negative)."""
    out = {}
    for a, b in itertools.combinations(cols, 2):
        x, y = F.col(a), F.col(b)
        gap = x * x - y * y
        out |= {
            f"{a}_plus_{b}": x + y, f"{a}_minus_{b}": x - y, f"{a}_times_{b}": x * y,
            f"{a}_over_{b}": x / (y + F.lit(eps)), f"{a}_root_{b}": F.when(gap >= 0, F.sqrt(gap)),
        }
    return out


def pair_functions(cols: list[str]) -> dict[str, Column]:
    """Arithmetic, log and root differences of all ordered pairs, sine and cosine of each column.

    Logs and roots take magnitudes; missing and non-finite results become 0.
    """
    out = {}
    for a, b in itertools.product(cols, repeat=2):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        out |= {
            f"{a}_plus_{b}": x + y, f"{a}_minus_{b}": x - y, f"{a}_times_{b}": x * y,
            f"{a}_log_{b}": F.log1p(F.abs(x)) - F.log1p(F.abs(y)),
            f"{a}_sqrt_{b}": F.sqrt(F.abs(x)) - F.sqrt(F.abs(y)),
            f"{a}_abs_diff_{b}": F.abs(x - y),
        }
    for a in cols:
        out |= {f"{a}_sin": F.sin(F.col(a).cast("double")), f"{a}_cos": F.cos(F.col(a).cast("double"))}
    return {k: F.coalesce(finite(v), F.lit(0.0)) for k, v in out.items()}
