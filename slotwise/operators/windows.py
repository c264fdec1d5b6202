"""Date-window and program predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import EngineConfig
from slotwise.operators.columns import with_program_facts


def date_window(
    date_col: str,
    days: int,
    as_of: dt.datetime,
    mode: str = "training",
    cutoff: str | None = None,
    future_days: int = 7,
) -> Column:
    """Row predicate of the extraction window.

    The base keeps its time of day: with as_of at 10:00 the day exactly `days`
    ago (midnight) is already outside. Modes: inference (up to today +
    future_days), training with a dd/mm/yyyy cutoff (that day included), and
    training without upper bound.
    """
    c = F.col(date_col).cast("timestamp")
    if mode == "inference":
        base, upper = as_of, c <= F.lit(dt.datetime.combine(as_of.date(), dt.time()) + dt.timedelta(days=future_days))
    elif cutoff:
        base = dt.datetime.strptime(cutoff, "%d/%m/%Y")
        upper = c < F.lit(base + dt.timedelta(days=1))
    else:
        base, upper = as_of, None
    lower = c >= F.lit(base - dt.timedelta(days=days))
    # The date twin of the lower bound lets partition pruning and file statistics work.
    first_day = F.col(date_col) >= F.lit((base - dt.timedelta(days=days)).date())
    return lower & first_day if upper is None else lower & first_day & upper


def config_window(date_col: str, cfg: EngineConfig) -> Column:
    days = cfg.inference_window_days if cfg.mode == "inference" else cfg.window_days
    return date_window(date_col, days, cfg.as_of, cfg.mode, cfg.cutoff, cfg.future_days)


def program_filter(df: DataFrame, programs: Sequence[int], channel: int | None = None) -> DataFrame:
    """IN (programs) and channel equality: one predicate that reaches the scan, however long the list."""
    if not programs:
        raise ValueError("empty program list: add at least one program")
    if channel is not None:
        df = df.where(F.col("channel_id") == channel)
    return df.where(F.col("program_id").isin(*[int(p) for p in programs]))


def recent_window(df: DataFrame, ts: str = "slot_ts", days: int = 90, per_program: bool = False, many: bool = False) -> DataFrame:
    """Rows within `days` of the latest timestamp, overall or of their program. `many`: see with_program_facts."""
    span = F.expr(f"INTERVAL {int(days)} DAYS")
    if not per_program:
        newest = df.agg(F.max(ts)).scalar()
        return df.where(F.col(ts) >= newest - span)
    newest = df.groupBy("program_id").agg(F.max(ts).alias("_newest"))
    return with_program_facts(df, newest, many).where(F.col(ts) >= F.col("_newest") - span).drop("_newest")


def evaluation_window(df: DataFrame, as_of: dt.datetime, days: int, ts: str = "slot_ts") -> DataFrame:
    """The last `days` days; earlier rows only warmed up lags."""
    start = dt.datetime.combine(as_of.date(), dt.time()) - dt.timedelta(days=days)
    return df.where(F.col(ts) >= F.lit(start))


def past_only(df: DataFrame, as_of: dt.datetime, days: int, margin: int = 15, date_col: str = "ref_date") -> DataFrame:
    """days + margin days back from as_of, strictly before today."""
    base = as_of - dt.timedelta(days=days + margin)
    return df.where(
        (F.col(date_col).cast("timestamp") >= F.lit(base))
        & (F.col(date_col) >= F.lit(base.date()))
        & (F.col(date_col) < F.lit(as_of.date()))
    )
