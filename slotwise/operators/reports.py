"""BI read paths and dashboard preparation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions.clock import slot_text
from slotwise.functions.numbers import ratio
from slotwise.operators.columns import with_program_facts
from slotwise.operators.windows import program_filter


def left_forecast(mart: DataFrame, forecast: DataFrame) -> DataFrame:
    """Every mart row with its forecast, where there is one."""
    extra = [c for c in forecast.columns if c in catalog.KEYS or c not in mart.columns]
    return mart.join(forecast.select(*extra), catalog.KEYS, "left")


def inner_forecast_actual(forecast: DataFrame, mart: DataFrame) -> DataFrame:
    extra = [c for c in forecast.columns if c in catalog.KEYS or c not in mart.columns]
    return forecast.select(*extra).join(mart, catalog.KEYS)


def frontend_kpis(df: DataFrame) -> DataFrame:
    """Row KPIs of the BI screen.

    Averages follow the screen's own definitions: handle time per offered call
    and wait per answered call, unlike the model features.
    """
    return df.withColumns(
        {
            "vol_delta": F.col("vol_actual") - F.col("vol_plan"),
            "abandon_rate_now": ratio("vol_abandoned", "vol_actual"),
            "hc_delta": F.col("hc_equiv").cast("double") - F.col("hc_plan"),
            "absence_rate_now": ratio("absence_sec", "scheduled_sec"),
            "aht_now": ratio("aht_actual_total", "vol_actual"),
            "aht_plan": ratio("aht_plan_total", "vol_plan"),
            "wait_now": ratio("wait_total", "vol_answered"),
            "sl_now": ratio("vol_in_sla", "vol_actual"),
        }
    )


FRONTEND_COLUMNS = [
    *catalog.KEYS, "vol_actual", "vol_plan", "vol_delta", "vol_answered", "vol_in_sla", "vol_abandoned",
    "abandon_rate_now", "hc_equiv", "hc_plan", "hc_delta", "missed_days", "vacation", "absence_rate_now",
    "aht_now", "aht_plan", "wait_now", "pause_tech_sec", "pause_personal_sec", "sl_now", "sl_pred", "sl_plan",
    "sl_lag_1", "impact_people", "impact_volume", "impact_handle_time", "impact_context",
    *[f"{s}_{i}_{p}" for s in ("detractor", "booster") for i in (1, 2, 3) for p in ("name", "impact", "pillar")],
]
FRONTEND_VARIANTS = {
    "full": FRONTEND_COLUMNS,
    "without_plan_sl": [c for c in FRONTEND_COLUMNS if c != "sl_plan"],
    "reduced": [
        *catalog.KEYS, "vol_actual", "vol_in_sla", "vol_plan", "aht_now", "aht_plan", "hc_equiv", "hc_plan",
        "pause_tech_sec", "pause_personal_sec", "sl_now", "sl_plan", "sl_pred", "impact_people", "impact_volume",
        "impact_handle_time", "detractor_1_name", "detractor_1_impact", "detractor_2_name", "booster_1_name",
        "booster_1_impact",
    ],
}


def bi_frontend(
    mart: DataFrame, forecast: DataFrame, as_of: dt.datetime, programs: Sequence[int], channel: int = 7,
    variant: str = "full",
) -> DataFrame:
    """Today onwards: actuals, plan, forecast and drivers in one table."""
    live = program_filter(mart.where(F.col("ref_date") >= F.lit(as_of.date())), programs, channel)
    return left_forecast(live, forecast).transform(frontend_kpis).select(*FRONTEND_VARIANTS[variant])


def abs_errors(df: DataFrame) -> DataFrame:
    """Absolute error of plan and model against the capped actual service level."""
    actual = F.least(ratio("vol_in_sla", "vol_actual"), F.lit(1.0))
    return df.withColumn("sl_actual", actual).withColumns(
        {
            "abs_err_plan": F.abs(F.col("sl_actual") - F.col("sl_plan")),
            "abs_err_model": F.abs(F.col("sl_actual") - F.col("sl_pred").cast("double")),
        }
    )


def plan_vs_model(forecast: DataFrame, mart: DataFrame, as_of: dt.datetime) -> DataFrame:
    live = forecast.where(F.col("ref_date") >= F.lit(as_of.date()))
    return inner_forecast_actual(live, mart).transform(abs_errors).select(
        "ref_date", "slot", "program_id", "sl_plan", "sl_pred", "sl_actual", "abs_err_plan", "abs_err_model",
        "impact_people", "impact_volume", "impact_handle_time", "detractor_1_name", "detractor_1_impact",
        "booster_1_name", "booster_1_impact",
    )


def actuals_extract(mart: DataFrame, as_of: dt.datetime, programs: Sequence[int], channel: int = 7) -> DataFrame:
    """Actual and plan service level of the past week, today excluded."""
    first, last = (as_of.date() - dt.timedelta(days=d) for d in (7, 1))
    rows = program_filter(mart.where(F.col("ref_date").between(F.lit(first), F.lit(last))), programs, channel)
    return rows.select(
        "ref_date", "slot", "program_id", "vol_in_sla", F.col("vol_actual").alias("vol_offered"),
        ratio("vol_in_sla", "vol_actual").alias("sl_actual"), "sl_plan",
    )


def order_keys(df: DataFrame, keys: Sequence[str] = ("ref_date", "slot", "program_id", "channel_id")) -> DataFrame:
    """Sort for output only."""
    return df.orderBy(*keys)


def slot_end(df: DataFrame, many: bool = False) -> DataFrame:
    """Start and end text of each slot; the step is the gap of its program's first two distinct slots (30 if one).

    A day has at most 1440 distinct slots, which bounds the collected set. `many`: see with_program_facts.
    """
    slots = F.sort_array(F.collect_set("slot"))
    steps = df.groupBy("program_id").agg(
        F.when(F.size(slots) >= 2, F.get(slots, F.lit(1)) - F.get(slots, F.lit(0)))
        .otherwise(catalog.SLOT_MINUTES)
        .alias("step")
    )
    return with_program_facts(df, steps, many).where("step IS NOT NULL").withColumns(
        {"slot_start": slot_text("slot"), "slot_end": slot_text(F.col("slot") + F.col("step"))}
    )


def uplift_rank(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy(F.col("uplift_mae_pct").desc(), "program_id")


def extreme_rows(df: DataFrame, per: Sequence[str] = ("program_id",), value: str = "sl_pred") -> DataFrame:
    """First row with the lowest and first row with the highest prediction."""
    row = F.struct(*catalog.KEYS, value)
    order = F.struct("ref_date", "slot", "program_id", "channel_id")
    out = df.groupBy(*per).agg(
        F.min_by(row, F.struct(F.col(value), order)).alias("lowest"),
        F.min_by(row, F.struct(-F.col(value), order)).alias("highest"),
    )
    cases = F.explode(F.array(F.struct(F.lit("lowest").alias("which"), F.col("lowest").alias("row")),
                              F.struct(F.lit("highest").alias("which"), F.col("highest").alias("row"))))
    return out.select(cases.alias("case")).select("case.which", "case.row.*")


def latest_run(runs: DataFrame, at: str = "executed_at") -> DataFrame:
    return runs.agg(F.max_by("suffix", F.struct(at, "suffix")).alias("suffix"), F.max(at).alias(at))


def run_evolution(docs: DataFrame) -> DataFrame:
    """One row per run, oldest first."""
    fields = ["mae_model", "rmse_model", "r2_model", "mae_plan", "rmse_plan", "r2_plan", "uplift_mae_pct", "n_rows"]
    at = F.try_to_timestamp(F.col("executed_at"))
    return docs.select(
        at.alias("executed_at"), "days", "suffix", *[F.col(f"overall.{f}").alias(f) for f in fields]
    ).orderBy("executed_at")


def run_evolution_by_program(docs: DataFrame) -> DataFrame:
    at = F.try_to_timestamp(F.col("executed_at"))
    fields = ["sl_actual_mean", "mae_model", "mae_plan", "rmse_model", "r2_model", "uplift_mae_pct"]
    return (
        docs.select(at.alias("executed_at"), "days", "suffix", F.explode("by_program").alias("program", "m"))
        .select(
            "executed_at", "days", "suffix", F.col("program").cast("int").alias("program_id"),
            F.coalesce("m.n_rows", F.lit(0)).alias("n_rows"), *[F.col(f"m.{f}").alias(f) for f in fields],
        )
        .orderBy("executed_at")
    )


def programs_in_all_runs(rows: DataFrame) -> DataFrame:
    """Programs that occur in every run of a (suffix, program_id) table."""
    runs = rows.agg(F.count_distinct("suffix")).scalar()
    per = rows.groupBy("program_id").agg(F.count_distinct("suffix").alias("n_runs"))
    return per.where(F.col("n_runs") == runs).select("program_id")


def union_programs(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate per-program results by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def feature_sets(
    programs: DataFrame, all_features: Sequence[str], exclusions: Mapping[int, Sequence[str]] | None = None,
    optional: Mapping[str, Sequence[int] | None] | None = None,
) -> DataFrame:
    """(program_id, features): global, then optional, then the remaining inputs, minus exclusions.

    Exclusions never remove a global feature. `optional` maps a feature to the
    programs allowed to use it (None: all).
    """
    exclusions = catalog.EXCLUDED_FEATURES if exclusions is None else exclusions
    optional = {f: None for f in catalog.OPTIONAL_FEATURES} if optional is None else optional
    pid = F.col("program_id")

    def names(fs):
        return F.array(*[F.lit(f) for f in fs]).cast("array<string>")

    excluded = names([])
    for p, fs in exclusions.items():
        excluded = F.when(pid == p, names(fs)).otherwise(excluded)
    allowed = names([])
    for f, only in optional.items():
        ok = F.lit(True) if only is None else pid.isin(*[int(p) for p in only])
        allowed = F.when(ok, F.concat(allowed, names([f]))).otherwise(allowed)
    core = names(catalog.GLOBAL_FEATURES)
    extra = F.array_except(F.array_union(allowed, names(all_features)), excluded)
    return programs.select("program_id", F.array_union(core, extra).alias("features"))


def configured_programs(exclusions: Mapping[int, Sequence[str]], optional: Mapping[str, Sequence[int] | None]) -> list[int]:
    """Programs named anywhere in the feature registry."""
    named = {int(p) for ps in optional.values() if ps for p in ps} | {int(p) for p in exclusions}
    return sorted(named)


def with_exclusions(
    exclusions: Mapping[int, Sequence[str]], program_id: int, features: Sequence[str]
) -> dict[int, list[str]]:
    """The registry with one program's exclusions replaced."""
    return {**{int(p): list(f) for p, f in exclusions.items()}, int(program_id): list(features)}
