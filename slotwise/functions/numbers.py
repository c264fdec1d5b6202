from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; 0.0 where the denominator is not positive."""
    n, d = col(num).cast("double"), col(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def clip(c: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(col(c), F.lit(low)), F.lit(high))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0))


def to_target_space(y: str | Column) -> Column:
    """log1p(1 - y): the model learns the shortfall from full service."""
    return F.log1p(F.lit(1.0) - col(y))


def from_target_space(t: str | Column) -> Column:
    return F.lit(1.0) - F.expm1(col(t))


def sample_weight(y: str | Column, weight: float = 10.0) -> Column:
    return F.when(col(y) < 1, F.lit(float(weight))).otherwise(F.lit(1.0))


def clip_residual(r: str | Column, limit: float = 0.15) -> Column:
    return clip(r, -limit, limit)


def publishable(pred: str | Column, vol_plan: str | Column) -> Column:
    """Final service level: nothing planned means 0, otherwise inside [0, 1]."""
    return F.when(col(vol_plan) == 0, F.lit(0.0)).otherwise(clip(pred))


def total(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else out + c
    return F.lit(0.0) if out is None else out
