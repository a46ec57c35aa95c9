"""Comparisons and guards that treat NaN, infinity and NULL as missing values.

Spark orders NaN above every number, so a plain ``>`` is true for NaN on the
left.  Everything that flags or averages goes through these helpers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")
NAN = float("nan")


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """TRUE where the value is a finite number, FALSE for NULL, NaN and infinities."""
    c = as_col(c).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(INF))


def finite_or_null(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(finite(c), c)


def known_gt(a: str | Column, b: str | Column) -> Column:
    """``a > b`` with FALSE whenever either side is NaN or NULL."""
    a, b = as_col(a), as_col(b)
    return F.coalesce(~F.isnan(a) & ~F.isnan(b) & (a > b), F.lit(False))


def known_lt(a: str | Column, b: str | Column) -> Column:
    """``a < b`` with FALSE whenever either side is NaN or NULL."""
    return known_gt(b, a)


def ratio(a: str | Column, b: str | Column) -> Column:
    """``a / b``; NULL where the divisor is zero or missing (ANSI mode would raise)."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def zero_to_nan(c: str | Column) -> Column:
    """Exact zeros are blanked pixels; turn them into NaN."""
    c = as_col(c)
    return F.when(c == 0.0, F.lit(NAN)).otherwise(c)


def blank_unless(c: str | Column, keep: Column) -> Column:
    """NaN wherever ``keep`` is not true."""
    return F.when(keep, as_col(c)).otherwise(F.lit(NAN))


def inf_to_nan(df: DataFrame) -> DataFrame:
    """Replace infinities by NaN in every floating point column."""
    floats = [f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    swaps = {
        f.name: F.when(F.abs(F.col(f.name)) == INF, F.lit(NAN).cast(f.dataType))
        .otherwise(F.col(f.name))
        .alias(f.name, metadata=f.metadata)
        for f in floats
    }
    return df.select([swaps.get(f.name, F.col(f.name)) for f in df.schema.fields])


def ceil_to(c: str | Column, precision: int = 0) -> Column:
    """Round up at a decimal precision."""
    scale = float(10**precision)
    return F.ceil(as_col(c) * scale).cast("double") / scale


def floor_to(c: str | Column, precision: int = 0) -> Column:
    """Round down at a decimal precision."""
    scale = float(10**precision)
    return F.floor(as_col(c) * scale).cast("double") / scale


def array_median(values: str | Column) -> Column:
    """Median of an array's values, NULL elements left out; NULL for an array without values."""
    kept = F.array_sort(F.filter(as_col(values), lambda v: v.isNotNull()))
    n = F.size(kept)
    return (F.get(kept, F.floor((n - 1) / 2).cast("int")) + F.get(kept, F.floor(n / 2).cast("int"))) / 2.0
