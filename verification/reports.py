"""Run history and explanation reports."""

from slotwise.operators import drivers, reports
from slotwise.sources import stores
from verification import inputs as i
from verification.registry import check
from verification.sources import stored_docs
from verification.splits import RUN_SCORES
from verification.sqltext import metric_select

K = i.KEYS
EVO = "mae_model rmse_model r2_model mae_plan rmse_plan r2_plan uplift_mae_pct:double"


@check("run_evolution", f"suffix:string executed_at:timestamp days n_rows:bigint {EVO}", ["clean_infer", "fx_runs"], f"""
SELECT m.*, cast(as_of AS timestamp) AS executed_at, days FROM (SELECT suffix, {metric_select()} FROM {RUN_SCORES} GROUP BY 1) AS m JOIN fx_runs USING (suffix)
ORDER BY executed_at""")
def _(s, d):
    return reports.run_evolution(stores.scan_metric_docs(s, stored_docs(s, d)))


@check("run_evolution_by_program",
       "suffix:string executed_at:timestamp days program_id n_rows:bigint sl_actual_mean mae_model mae_plan rmse_model r2_model uplift_mae_pct:double",
       ["clean_infer", "fx_runs"], f"""
SELECT m.*, cast(as_of AS timestamp) AS executed_at, days FROM (SELECT suffix, program_id, {metric_select()} FROM {RUN_SCORES} GROUP BY 1, 2) AS m
JOIN fx_runs USING (suffix)""")
def _(s, d):
    return reports.run_evolution_by_program(stores.scan_metric_docs(s, stored_docs(s, d)))


@check("pillar_rollup", f"{K} impact_volume impact_people impact_handle_time impact_health impact_context:double", ["pillars_infer"],
       "SELECT * FROM pillars_infer")
def _(s, d):
    return drivers.pillar_rollup(i.scored(s, d))


@check("waterfall", f"{K} step:bigint feature:string impact running_value total_value sl_total:double", ["long_infer"], """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY ref_date, slot, program_id, channel_id ORDER BY abs(impact) DESC, position) AS rk FROM long_infer),
g AS (SELECT ref_date, slot, program_id, channel_id, base_value, least(rk, 16) AS step,
 CASE WHEN rk > 15 THEN 'Outros (demais features)' ELSE feature END AS feature, sum(impact) AS impact FROM r GROUP BY ALL),
t AS (SELECT *, base_value + sum(impact) OVER w AS total_value,
  base_value + sum(impact) OVER (PARTITION BY ref_date, slot, program_id, channel_id ORDER BY step) AS running_value
 FROM g WINDOW w AS (PARTITION BY ref_date, slot, program_id, channel_id))
SELECT *, 1 - (exp(total_value) - 1) AS sl_total FROM t""")
def _(s, d):
    return drivers.waterfall(i.scored(s, d))
