"""Cleaning rules between the raw interval table and feature building."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.config import EngineConfig
from slotwise.functions import clock
from slotwise.functions.numbers import clip, ratio
from slotwise.operators.columns import MAP_PROGRAMS, ensure_columns, fill_numeric, with_program_facts


def with_slot_ts(df: DataFrame) -> DataFrame:
    """Timestamp of the slot; tables without the two key columns pass unchanged."""
    if not {"ref_date", "slot"} <= set(df.columns):
        return df
    return df.withColumn("slot_ts", clock.slot_timestamp("ref_date", "slot"))


def clock_parts(df: DataFrame) -> DataFrame:
    if "slot_ts" not in df.columns:
        return df
    return df.withColumns({"hour": F.hour("slot_ts"), "weekday": clock.weekday("slot_ts")})


def split_ts_text(df: DataFrame, ts: str = "slot_ts") -> DataFrame:
    """Date and time-of-day text from the timestamp, where they are absent."""
    add = {}
    if "ref_date" not in df.columns:
        add["ref_date"] = F.to_date(ts)
    if "slot_text" not in df.columns:
        add["slot_text"] = F.date_format(ts, "HH:mm:ss")
    return df.withColumns(add) if add else df


def relevant_slots(df: DataFrame) -> DataFrame:
    """Drop closed shifts: nothing planned, nothing offered, nobody scheduled."""
    return df.where((F.col("vol_plan") > 0) | (F.col("vol_actual") > 0) | (F.col("hc_plan") > 0))


def target(df: DataFrame, name: str = "sl_actual") -> DataFrame:
    """Service level reached, clipped to [0, 1]; optionally its gap to the plan."""
    if name not in ("sl_actual", "sl_residual"):
        raise ValueError(f"unknown target {name!r}: use 'sl_actual' or 'sl_residual'")
    df = ensure_columns(df, ["sl_plan"]).withColumns(
        {"sl_actual": clip(ratio("vol_in_sla", "vol_actual")), "sl_plan": clip("sl_plan")}
    )
    if name == "sl_residual":
        df = df.withColumn("sl_residual", F.col("sl_actual") - F.col("sl_plan"))
    return df


def active_programs(df: DataFrame) -> DataFrame:
    """Actual volume per program and whether it had any."""
    return df.groupBy("program_id").agg(F.sum("vol_actual").alias("vol_actual")).withColumn(
        "is_active", F.col("vol_actual") > 0
    )


def active_semi(df: DataFrame, many: bool = False) -> DataFrame:
    """Only rows of programs with some actual volume in the table. `many`: see with_program_facts."""
    active = active_programs(df).select("program_id", F.col("is_active").alias("_active"))
    return with_program_facts(df, active, many).where("_active").drop("_active")


def operational_flag(df: DataFrame, enabled: bool = True, min_volume: int = 1) -> DataFrame:
    flag = F.col("vol_actual") >= min_volume if enabled else F.lit(True)
    return df.withColumn("is_operational", flag)


def operational_filter(df: DataFrame, enabled: bool = True, min_volume: int = 1) -> DataFrame:
    return operational_flag(df, enabled, min_volume).where("is_operational")


def clean(df: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Training keeps operational rows of active programs; inference keeps all rows."""
    df = df.transform(with_slot_ts).transform(clock_parts).transform(relevant_slots)
    df = df.transform(target, cfg.target)
    if cfg.mode != "inference":
        df = df.transform(active_semi, len(cfg.programs) > MAP_PROGRAMS).transform(operational_filter, cfg.operational_filter, cfg.min_volume)
    return fill_numeric(df)


def operational_diagnostics(df: DataFrame, min_volume: int = 1) -> DataFrame:
    """Per program: share without operation and the service level of the rest."""
    op = F.col("vol_actual") >= min_volume
    idle = F.count_if(~op)
    rows = F.count("*")
    return (
        df.groupBy("program_id")
        .agg(
            rows.alias("n_rows"),
            idle.alias("n_idle"),
            F.coalesce(F.avg(F.when(op, F.col("sl_actual"))), F.lit(0.0)).alias("sl_mean"),
            F.coalesce(F.avg(F.when(op, (F.col("sl_actual") == 0).cast("double"))) * 100, F.lit(0.0)).alias(
                "zero_pct"
            ),
        )
        .withColumn("idle_pct", F.col("n_idle") / F.col("n_rows") * 100)
    )


def target_distribution(df: DataFrame, name: str = "sl_actual") -> DataFrame:
    """Counts at 0, at 1 and between, overall (program NULL) and per program, in one pass."""
    y = F.col(name)
    n = F.col("n_rows")
    return (
        df.groupingSets([[], [F.col("program_id")]], F.col("program_id"))
        .agg(
            F.count("*").alias("n_rows"),
            F.avg(y).alias("sl_mean"),
            F.count_if(y == 0).alias("n_zero"),
            F.count_if(y == 1).alias("n_one"),
            F.count_if((y > 0) & (y < 1)).alias("n_between"),
            F.grouping("program_id").cast("int").alias("is_total"),
        )
        .withColumns(
            {
                "zero_pct": F.when(n > 0, F.col("n_zero") / n * 100),
                "one_pct": F.when(n > 0, F.col("n_one") / n * 100),
                "between_pct": F.when(n > 0, F.col("n_between") / n * 100),
            }
        )
    )


def quality_labels(diagnostics: DataFrame, distribution: DataFrame) -> DataFrame:
    """Text labels for the warnings a data owner reads."""
    dist = distribution.where("is_total = 0").select(
        "program_id", F.col("n_rows").alias("n_dist"), F.col("n_zero").alias("n_zero")
    )
    return diagnostics.join(dist, "program_id").select(
        "program_id",
        F.when(F.col("idle_pct") > 70, "mostly_idle")
        .when(F.col("idle_pct") > 50, "often_idle")
        .otherwise("ok")
        .alias("idle_label"),
        F.when(F.col("n_zero") / F.col("n_dist") > 0.30, "many_zeros").otherwise("ok").alias("zero_label"),
        F.when(F.col("n_dist") < 100, "few_rows").otherwise("ok").alias("size_label"),
    )


def r2_label(r2):
    return F.when(r2 > 0.3, "good").when(r2 > 0, "weak").otherwise("poor")


def mask_non_operational(df: DataFrame, cols=("sl_actual", "sl_pred", "sl_plan")) -> DataFrame:
    """Blank chart series where nothing was offered."""
    have = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.when(F.col("vol_actual") > 0, F.col(c)) for c in have})
