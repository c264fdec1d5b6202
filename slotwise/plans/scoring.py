"""Inference and benchmark runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.config import EngineConfig
from slotwise.operators import cleaning, columns, drivers, encoding, metrics, windows
from slotwise.operators.columns import MAP_PROGRAMS
from slotwise.plans.history import feature_table
from slotwise.sources.forecast import FACT_COLUMNS, fact_schema

Scorer = Callable[[DataFrame], DataFrame]

RESULT_COLUMNS = [
    *catalog.KEYS, "vol_actual", "vol_plan", "hc_plan", "sl_actual", "sl_plan_wfm", "sl_pred", *catalog.PILLAR_COLUMNS,
    *[f"{s}_{i}_{p}" for s in ("detractor", "booster") for i in (1, 2, 3) for p in ("name", "pillar", "impact")],
]


def explained(scored: DataFrame) -> DataFrame:
    """Pillar impacts and top drivers of scored rows."""
    return scored.transform(drivers.pillar_rollup).transform(drivers.top_drivers)


def scoring_columns(df: DataFrame, features: Sequence[str] = tuple(catalog.FEATURES)) -> DataFrame:
    """Only what scoring reads and the published tables carry."""
    wanted = {*FACT_COLUMNS, *RESULT_COLUMNS, *features, "slot_ts", "sl_plan", "sl_actual", "vol_actual"}
    return df.select(*[c for c in df.columns if c in wanted])


def future_features(history: DataFrame, cfg: EngineConfig, stored_encoding: DataFrame) -> DataFrame:
    """Feature rows from today on; earlier rows only feed the lags."""
    cfg = cfg.with_mode("inference")
    window = windows.program_filter(history.where(windows.config_window("ref_date", cfg)), cfg.programs, cfg.channel)
    feats = feature_table(cleaning.clean(window, cfg), cfg, stored_encoding)
    return feats.where(F.col("slot_ts") >= F.lit(dt.datetime.combine(cfg.today, dt.time())))


def inference_run(history: DataFrame, cfg: EngineConfig, stored_encoding: DataFrame, scorer: Scorer) -> DataFrame:
    """Forecast rows in published shape, before the type cast; see sources.forecast.publish."""
    future = future_features(history, cfg, stored_encoding)
    future = encoding.encoding_override(future, stored_encoding, many=len(cfg.programs) > MAP_PROGRAMS)
    return explained(scorer(scoring_columns(future, cfg.features)))


def forecast_rows(run: DataFrame, updated_at: dt.datetime | None = None) -> DataFrame:
    return fact_schema(run, updated_at).select(*FACT_COLUMNS)


def mean_prediction(run: DataFrame) -> DataFrame:
    return run.groupBy("program_id").agg(F.avg("sl_pred").alias("sl_pred_mean"), F.count("*").alias("n_rows"))


def benchmark_rows(
    history: DataFrame, cfg: EngineConfig, stored_encoding: DataFrame, scorer: Scorer, days: int = 7
) -> DataFrame:
    """Scored and explained rows of the last `days` full days."""
    past = windows.past_only(history, cfg.as_of, days)
    past = windows.program_filter(past, cfg.programs, cfg.channel)
    inference = cfg.with_mode("inference")
    feats = feature_table(cleaning.clean(past, inference), inference, stored_encoding)
    rows = windows.evaluation_window(feats, cfg.as_of, days)
    rows = encoding.encoding_override(rows, stored_encoding, many=len(cfg.programs) > MAP_PROGRAMS)
    return explained(scorer(scoring_columns(rows, cfg.features)))


def benchmark_run(
    history: DataFrame, cfg: EngineConfig, stored_encoding: DataFrame, scorer: Scorer, days: int = 7
) -> tuple[DataFrame, DataFrame]:
    """(result rows, metric rows with mean pillar impacts: global and per program)."""
    rows = benchmark_rows(history, cfg, stored_encoding, scorer, days)
    result = columns.result_projection(rows, {"sl_plan": "sl_plan_wfm"}, RESULT_COLUMNS)
    return result, metrics.metrics_document(rows, pillars=True)
