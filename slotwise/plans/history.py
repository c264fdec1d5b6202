"""Raw history, clean table and feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from slotwise import catalog
from slotwise.config import EngineConfig
from slotwise.operators import daily, encoding, features, history, windows
from slotwise.operators.columns import MAP_PROGRAMS
from slotwise.operators.mart import interval_mart
from slotwise.sources.stages import staged


def in_scope(df: DataFrame, date_col: str, cfg: EngineConfig, channel: bool = True) -> DataFrame:
    """The source rows a run can use: its window, its programs and, if the source has channels, its channel."""
    return windows.program_filter(df.where(windows.config_window(date_col, cfg)), cfg.programs, cfg.channel if channel else None)


def scoped_mart(intraday: DataFrame, plan: DataFrame, agents: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The mart of one run. Date, program and channel are keys of every aggregate, so the sources are cut before them."""
    return interval_mart(
        in_scope(intraday, "row_date", cfg), in_scope(plan, "plan_date", cfg), in_scope(agents, "work_date", cfg, False),
        cfg.as_of, cfg.window_days, cfg.plan_sla_scale,
    )


def scan_mart(mart: DataFrame, cfg: EngineConfig) -> DataFrame:
    rows = mart.where(windows.config_window("ref_date", cfg))
    return windows.program_filter(rows, cfg.programs, cfg.channel).select(*catalog.MART_COLUMNS)


def scan_log_gap(system_time: DataFrame, agents: DataFrame, cfg: EngineConfig, dedupe: bool = False) -> DataFrame:
    rows = system_time.where(windows.config_window("work_date", cfg))
    rows = windows.program_filter(rows, cfg.programs)
    return daily.log_gap_agg(rows, in_scope(agents, "work_date", cfg, False), dedupe)


def raw_history(mart: DataFrame, system_time: DataFrame, agents: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Interval rows of the window with their daily log-gap facts."""
    return daily.daily_merge(scan_mart(mart, cfg), scan_log_gap(system_time, agents, cfg))


def feature_table(
    clean: DataFrame, cfg: EngineConfig, stored_encoding: DataFrame | None = None, stage: bool = True
) -> DataFrame:
    """All derived columns. Training fits the program encoding, otherwise the stored one is used.

    The clean rows feed four branches (rows, bucket tails, global mean,
    encoding), so by default they are staged once.
    """
    rows = features.row_features(clean)
    if stage:
        rows = staged(rows, "clean")
    wide = history.lag_and_rolling(rows)
    enc = stored_encoding
    if enc is None:
        enc = encoding.target_encoding_fit(rows)
    if stage:
        enc = staged(enc, "encoding")
    return encoding.encoding_lookup(wide, enc, many=len(cfg.programs) > MAP_PROGRAMS)


def full_history(
    intraday: DataFrame, plan: DataFrame, agents: DataFrame, system_time: DataFrame, cfg: EngineConfig
) -> DataFrame:
    return raw_history(scoped_mart(intraday, plan, agents, cfg), system_time, agents, cfg)
