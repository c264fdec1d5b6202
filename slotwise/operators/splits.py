"""Time-ordered splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.history import numbered


def head_tail_split(df: DataFrame, share: float = 0.2) -> DataFrame:
    """Unshuffled split per program: the last ceil(share * n) rows validate."""
    rows = numbered(df, ["program_id"], ["slot_ts", "channel_id"], F.to_date("slot_ts"))
    n_val = F.ceil(F.col("n_rows") * F.lit(share))
    return rows.withColumn("is_validation", F.col("row_num") > F.col("n_rows") - n_val)


def cut_date(df: DataFrame, share: float, ts: str = "slot_ts") -> Column:
    """First date of the last max(1, floor(dates * share)) dates, as a scalar subquery.

    The distinct dates are a calendar, so one row holds them.
    """
    dates = F.sort_array(F.collect_set(F.to_date(ts)))
    n_test = F.greatest(F.lit(1), F.floor(F.size(dates) * F.lit(share)).cast("int"))
    return df.agg(F.try_element_at(dates, F.size(dates) - n_test + 1).alias("cut")).scalar()


def date_split(df: DataFrame, share: float = 0.2, ts: str = "slot_ts") -> DataFrame:
    """Adds is_test: rows on or after the cut date."""
    return df.withColumn("is_test", F.to_date(ts) >= cut_date(df, share, ts))


def future_split(df: DataFrame, as_of: dt.datetime, ts: str = "slot_ts") -> DataFrame:
    """Adds is_future: after the last slot with actual volume and not before today."""
    today = F.lit(dt.datetime.combine(as_of.date(), dt.time()))
    last = df.where(F.col("vol_actual") > 0).agg(F.max(ts)).scalar()
    edge = F.coalesce(last, today)
    return df.withColumn("is_future", (F.col(ts) > edge) & (F.col(ts) >= today))


def bounded_sample(df: DataFrame, keys: list[str], n: int = 1000, seed: int = 42) -> DataFrame:
    """At most n rows, the same ones on every run: the MD5 of the keys' text and the seed orders them."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return df.orderBy(F.md5(text), *keys).limit(n)
