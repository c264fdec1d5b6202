"""Stage tables of the test data, one function per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slotwise import catalog
from slotwise.models.linear import score_linear
from slotwise.models.shap import score_trees
from slotwise.operators import cleaning, encoding, features, windows
from slotwise.operators.mart import interval_mart
from slotwise.plans import history as plans
from slotwise.sources import demo
from slotwise.sources.stages import staged

AS_OF = demo.AS_OF


def mart(spark: SparkSession, sf: str) -> DataFrame:
    cfg = demo.config()
    return interval_mart(
        demo.intraday(spark, sf), demo.plan(spark, sf), demo.agents(spark, sf), cfg.as_of, cfg.window_days,
        cfg.plan_sla_scale,
    )


def live_mart(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    cfg = demo.config(mode)
    return plans.scan_mart(plans.scoped_mart(demo.intraday(spark, sf), demo.plan(spark, sf), demo.agents(spark, sf), cfg), cfg)


def raw(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    return plans.full_history(
        demo.intraday(spark, sf), demo.plan(spark, sf), demo.agents(spark, sf), demo.system_time(spark, sf),
        demo.config(mode),
    )


def clean(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    return cleaning.clean(raw(spark, sf, mode), demo.config(mode))


def light(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    """Clean rows without the daily log-gap facts, for operators that do not read them."""
    return cleaning.clean(live_mart(spark, sf, mode), demo.config(mode))


def rows(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    return features.row_features(clean(spark, sf, mode))


def stored_encoding(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.target_encoding_fit(light(spark, sf, "training"))


def history_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Raw history of the training window, staged: every mode's window is a part of it."""
    return staged(raw(spark, sf, "training"), "history")


def feats(spark: SparkSession, sf: str, mode: str = "inference", history: DataFrame | None = None) -> DataFrame:
    history = history_stage(spark, sf) if history is None else history
    cfg, training = demo.config(mode), demo.config("training")
    stored = None if mode == "training" else encoding.target_encoding_fit(cleaning.clean(history, training))
    window = history.where(windows.config_window("ref_date", cfg))
    return plans.feature_table(cleaning.clean(window, cfg), cfg, stored)


def coefs(history: DataFrame) -> DataFrame:
    """The fixed linear model for every program that had volume; the others have no model."""
    return demo.linear_coefs(cleaning.active_programs(history).where("is_active"))


def scored(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    history = history_stage(spark, sf)
    return score_linear(feats(spark, sf, mode, history), coefs(history), demo.LINEAR_FEATURES)


def fixed_scores(spark: SparkSession, sf: str, mode: str = "inference") -> DataFrame:
    """Rows scored and explained by the fixed forest."""
    history = history_stage(spark, sf)
    active = cleaning.active_programs(history).where("is_active")
    features = {r["program_id"]: list(demo.FOREST_FEATURES) for r in active.collect()}
    return score_trees(feats(spark, sf, mode, history), demo.forest_nodes(active), features)


KEYS = "ref_date:date slot program_id channel_id:bigint"
MART_INTS = (
    "vol_plan vol_actual vol_answered vol_in_sla vol_abandoned hc_plan aht_plan_total aht_actual_total wait_total "
    "pause_tech_sec pause_personal_sec pause_mgmt_sec absence_sec scheduled_sec turnover_active turnover_left "
    "vacation missed_days remote:bigint"
)
MART_SPEC = f"{KEYS} {MART_INTS} sl_plan hc_equiv:double"
GAP_INTS = (
    "log_gap_sec paid_sec sys_fail_sec client_fail_sec seat_sec tech_issue_sec agent_issue_sec new_hires hc_logged:bigint"
)
assert set(catalog.LOG_GAP_COLUMNS) == set(GAP_INTS.replace(":bigint", "").split())
