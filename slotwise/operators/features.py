"""Derived features; every ratio is 0.0 where its denominator is not positive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.catalog import LOG_GAP_COLUMNS, SLOT_SECONDS
from slotwise.functions.clock import weekday
from slotwise.functions.numbers import ratio
from slotwise.operators.columns import ensure_columns


def _d(name):
    return F.col(name).cast("double")


def delta_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "vol_delta": F.col("vol_actual") - F.col("vol_plan"),
            "hc_delta": _d("hc_equiv") - _d("hc_plan"),
            "aht_actual_avg": ratio("aht_actual_total", "vol_answered"),
            "aht_plan_avg": ratio("aht_plan_total", "vol_plan"),
        }
    ).withColumn("aht_delta", F.col("aht_actual_avg") - F.col("aht_plan_avg"))


def synthetic_features(df: DataFrame) -> DataFrame:
    """Demand pressure and staffing indicators.

    Units are kept as the business uses them: the margin subtracts calls from
    seconds, and synthetic occupancy multiplies total handle time by volume.
    """
    capacity = F.col("hc_plan") * SLOT_SECONDS
    return df.withColumns(
        {
            "pressure_vol_hc": ratio("vol_plan", "hc_plan"),
            "strain_index": ratio("aht_plan_total", capacity),
            "vol_per_agent": ratio("vol_plan", "hc_plan"),
            "occupancy_synth": ratio(_d("vol_plan") * _d("aht_plan_total"), capacity),
            "capacity_margin": ratio(capacity - F.col("vol_plan"), capacity),
            "staffing_dev_pct": ratio(_d("hc_equiv") - _d("hc_plan"), "hc_plan"),
            "staffing_ratio": ratio("hc_equiv", "hc_plan"),
            "overload_rate": ratio("vol_actual", _d("hc_equiv") * SLOT_SECONDS),
        }
    )


def rate_features(df: DataFrame) -> DataFrame:
    logged = _d("hc_equiv") * SLOT_SECONDS
    return df.withColumns(
        {
            "absence_rate_daily": ratio("absence_sec", "scheduled_sec"),
            "turnover_rate_daily": ratio("turnover_left", "turnover_active"),
            "abandon_rate": ratio("vol_abandoned", "vol_actual"),
            "avg_wait": ratio("wait_total", "vol_actual"),
            "occupancy": ratio("aht_actual_total", logged),
            "pause_tech_rate": ratio("pause_tech_sec", logged),
            "pause_personal_rate": ratio("pause_personal_sec", logged),
            "pause_mgmt_rate": ratio("pause_mgmt_sec", logged),
            "hc_dev_pct": ratio("hc_delta", "hc_plan"),
            "vol_dev_pct": ratio("vol_delta", "vol_plan"),
        }
    )


def log_gap_features(df: DataFrame) -> DataFrame:
    return ensure_columns(df, LOG_GAP_COLUMNS).withColumns(
        {
            "log_gap_rate_daily": ratio("log_gap_sec", "paid_sec"),
            "tech_issue_rate_daily": ratio("tech_issue_sec", "paid_sec"),
            "new_hire_pct_daily": ratio("new_hires", "hc_logged"),
            "agent_issue_rate_daily": ratio("agent_issue_sec", "paid_sec"),
        }
    )


def seasonality(df: DataFrame, ts: str = "slot_ts") -> DataFrame:
    if ts not in df.columns:
        return df
    day, dow, hour = F.dayofmonth(ts), weekday(ts), F.hour(ts)

    def flag(cond):
        return F.when(cond, 1.0).otherwise(0.0)

    return df.withColumns(
        {
            "day_of_month": day,
            "week_of_month": (F.floor((day - 1) / 7) + 1).cast("int"),
            "day_of_week": dow,
            "is_month_edge": flag((day <= 5) | (day >= 26)),
            "is_mon_fri": flag(dow.isin(0, 4)),
            "is_weekend": flag(dow >= 5),
            "hour_cycle": hour % 8,
            "is_peak_hour": flag((hour >= 10) & (hour <= 14)),
        }
    )


def row_features(df: DataFrame) -> DataFrame:
    """All features that need only their own row."""
    for step in (delta_features, synthetic_features, rate_features, log_gap_features, seasonality):
        df = df.transform(step)
    return df


def override_volume(df: DataFrame, volume: int = 0) -> DataFrame:
    """What-if: another planned volume everywhere, with the features that follow from it."""
    per_call = F.col("aht_plan_avg")
    df = df.withColumns({"vol_plan": F.lit(volume).cast("bigint"), "aht_plan_total": per_call * volume})
    return synthetic_features(df)
