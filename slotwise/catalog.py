"""Names and constants shared by every layer."""

from __future__ import annotations

KEYS = ["ref_date", "slot", "program_id", "channel_id"]
SERIES = ["program_id", "channel_id"]
SLOT_MINUTES = 30
SLOT_SECONDS = 1800

# Model inputs, in model order.
FEATURES = [
    "vol_plan",
    "hc_plan",
    "aht_plan_total",
    "hour",
    "weekday",
    "absence_rate_daily",
    "turnover_rate_daily",
    "vacation",
    "missed_days",
    "avg_wait_lag_1",
    "vol_dev_pct_lag_1",
    "aht_delta_lag_1",
    "pressure_vol_hc",
    "strain_index",
    "vol_per_agent",
    "capacity_margin",
    "occupancy_synth",
    "log_gap_rate_daily",
    "new_hire_pct_daily",
    "agent_issue_rate_daily",
    "sl_mean_3",
    "sl_mean_6",
    "sl_std_6",
    "sl_lag_1",
    "sl_lag_2",
    "sl_lag_3",
    "sl_accel",
    "program_enc",
    "day_of_month",
    "week_of_month",
    "day_of_week",
    "is_month_edge",
    "is_mon_fri",
    "is_weekend",
    "hour_cycle",
    "is_peak_hour",
    "sl_plan",
]

# Business pillar of every model input.
PILLARS = {
    "volume": ["vol_plan", "vol_dev_pct_lag_1"],
    "people": [
        "hc_plan",
        "absence_rate_daily",
        "turnover_rate_daily",
        "vacation",
        "missed_days",
        "log_gap_rate_daily",
        "new_hire_pct_daily",
        "agent_issue_rate_daily",
    ],
    "handle_time": ["aht_plan_total", "avg_wait_lag_1", "aht_delta_lag_1"],
    "operational_health": [
        "pressure_vol_hc",
        "strain_index",
        "vol_per_agent",
        "capacity_margin",
        "occupancy_synth",
    ],
    "temporal_context": [
        "hour",
        "weekday",
        "day_of_month",
        "week_of_month",
        "day_of_week",
        "is_month_edge",
        "is_mon_fri",
        "is_weekend",
        "hour_cycle",
        "is_peak_hour",
        "sl_mean_3",
        "sl_mean_6",
        "sl_std_6",
        "sl_lag_1",
        "sl_lag_2",
        "sl_lag_3",
        "sl_accel",
        "sl_plan",
    ],
    "operational_context": ["program_enc"],
}
PILLAR_OF = {f: p for p, fs in PILLARS.items() for f in fs}

# Labels written next to attributions.
PILLAR_LOOKUP_DEFAULT = "Geral"
PILLAR_DRIVER_DEFAULT = "Outros"
NO_DRIVER = ("Sem Impacto Relevante", "N/A", 0.0)
DRIVER_THRESHOLD = 0.001

# Published pillar columns: the two context pillars are reported as one.
PILLAR_COLUMNS = {
    "impact_volume": ["volume"],
    "impact_people": ["people"],
    "impact_handle_time": ["handle_time"],
    "impact_health": ["operational_health"],
    "impact_context": ["temporal_context", "operational_context"],
}

# Features every program gets, optional ones, and exclusions.
GLOBAL_FEATURES = [
    "hour",
    "weekday",
    "vol_plan",
    "hc_plan",
    "aht_plan_total",
    "absence_rate_daily",
    "avg_wait_lag_1",
    "vol_dev_pct_lag_1",
    "aht_delta_lag_1",
    "pressure_vol_hc",
    "strain_index",
    "vol_per_agent",
    "capacity_margin",
    "occupancy_synth",
    "log_gap_rate_daily",
    "sl_mean_3",
    "sl_mean_6",
    "sl_std_6",
    "sl_accel",
    "is_peak_hour",
]
OPTIONAL_FEATURES = [
    "turnover_rate_daily",
    "vacation",
    "missed_days",
    "new_hire_pct_daily",
    "agent_issue_rate_daily",
]
EXCLUDED_FEATURES = {
    589361: [
        "new_hire_pct_daily",
        "agent_issue_rate_daily",
        "program_enc",
        "vacation",
        "sl_lag_2",
        "is_weekend",
    ],
}

MART_MEASURES = [
    "vol_plan",
    "vol_actual",
    "vol_answered",
    "vol_in_sla",
    "vol_abandoned",
    "sl_plan",
    "hc_plan",
    "hc_equiv",
    "aht_plan_total",
    "aht_actual_total",
    "wait_total",
    "pause_tech_sec",
    "pause_personal_sec",
    "pause_mgmt_sec",
    "absence_sec",
    "scheduled_sec",
    "turnover_active",
    "turnover_left",
    "vacation",
    "missed_days",
    "remote",
]
MART_COLUMNS = KEYS + MART_MEASURES

LOG_GAP_COLUMNS = [
    "log_gap_sec",
    "paid_sec",
    "sys_fail_sec",
    "client_fail_sec",
    "seat_sec",
    "tech_issue_sec",
    "new_hires",
    "hc_logged",
    "agent_issue_sec",
]

# Metrics whose previous-slot value is a feature (first slot of a series: 0).
LAGGED_METRICS = [
    "abandon_rate",
    "avg_wait",
    "occupancy",
    "pause_tech_rate",
    "pause_personal_rate",
    "pause_mgmt_rate",
    "hc_dev_pct",
    "vol_dev_pct",
    "aht_delta",
]
