"""Aggregations."""

from pyspark.sql import functions as F

from slotwise.operators import cleaning, columns, daily, drivers, history, metrics
from slotwise.operators import mart as mart_ops
from slotwise.sources import demo, forecast
from verification import inputs as i
from verification.registry import check
from verification.sqltext import METRIC_SPEC, R2, metric_select

K = i.KEYS


@check("intraday_agg", f"{K} {' '.join(mart_ops.INTRADAY_SUMS)}:bigint", ["actual"], "SELECT * FROM actual")
def _(s, d):
    return mart_ops.intraday_agg(demo.intraday(s, d), i.AS_OF)


@check("plan_agg", f"{K} vol_plan hc_plan sla_weighted aht_weighted:bigint", ["planned"], "SELECT * FROM planned")
def _(s, d):
    return mart_ops.plan_agg(demo.plan(s, d), i.AS_OF)


PEOPLE = f"program_id:bigint ref_date:date {' '.join(mart_ops.PEOPLE_MEASURES)}:bigint"


@check("people_two_level", PEOPLE, ["people"], "SELECT * FROM people")
def _(s, d):
    return mart_ops.people_two_level(demo.agents(s, d), i.AS_OF)


@check("people_distinct", PEOPLE, ["people"], "SELECT * FROM people")
def _(s, d):
    return mart_ops.people_distinct(demo.agents(s, d), i.AS_OF)


@check("log_gap_agg", f"ref_date:date program_id {i.GAP_INTS}", ["gap_train"], "SELECT * FROM gap_train")
def _(s, d):
    return daily.log_gap_agg(demo.system_time(s, d), demo.agents(s, d))


@check("active_programs", "program_id vol_actual:bigint is_active:boolean", ["mart_train"],
       "SELECT program_id, sum(vol_actual) AS vol_actual, sum(vol_actual) > 0 AS is_active FROM mart_train GROUP BY 1")
def _(s, d):
    return cleaning.active_programs(i.live_mart(s, d, "training"))


@check("operational_diagnostics", "program_id n_rows n_idle:bigint idle_pct sl_mean zero_pct:double", ["clean_infer"], """
SELECT program_id, count(*) AS n_rows, count(*) FILTER (vol_actual < 1) AS n_idle,
 count(*) FILTER (vol_actual < 1) * 100.0 / count(*) AS idle_pct, coalesce(avg(sl_actual) FILTER (vol_actual >= 1), 0) AS sl_mean,
 coalesce(avg(CASE WHEN sl_actual = 0 THEN 100.0 ELSE 0 END) FILTER (vol_actual >= 1), 0) AS zero_pct
FROM clean_infer GROUP BY 1""")
def _(s, d):
    return cleaning.operational_diagnostics(i.light(s, d))


@check("target_distribution", "program_id is_total n_rows n_zero n_one n_between:bigint sl_mean zero_pct one_pct between_pct:double", ["clean_train"], """
SELECT program_id, grouping(program_id) AS is_total, count(*) AS n_rows, avg(sl_actual) AS sl_mean, count(*) FILTER (sl_actual = 0) AS n_zero,
 count(*) FILTER (sl_actual = 1) AS n_one, count(*) FILTER (sl_actual > 0 AND sl_actual < 1) AS n_between,
 count(*) FILTER (sl_actual = 0) * 100.0 / count(*) AS zero_pct, count(*) FILTER (sl_actual = 1) * 100.0 / count(*) AS one_pct,
 count(*) FILTER (sl_actual > 0 AND sl_actual < 1) * 100.0 / count(*) AS between_pct
FROM clean_train GROUP BY GROUPING SETS ((), (program_id))""")
def _(s, d):
    return cleaning.target_distribution(i.light(s, d, "training"))


@check("target_encoding_fit", "program_id n:bigint enc global_mean:double", ["enc_train"], "SELECT * FROM enc_train")
def _(s, d):
    return i.stored_encoding(s, d)


@check("global_mean_fill", f"{K} sl_lag_1:double", ["hist_train"],
       "SELECT * FROM hist_train")
def _(s, d):
    """Lags that fall before the series take the table mean."""
    return history.lag_and_rolling(i.rows(s, d, "training"))


@check("regression_metrics", METRIC_SPEC, ["scored_infer"],
       f"SELECT {metric_select()} FROM scored_infer WHERE vol_actual > 0")
def _(s, d):
    return metrics.regression_metrics(i.scored(s, d))


@check("metrics_by_program", f"program_id:bigint {METRIC_SPEC}", ["scored_infer"],
       f"SELECT program_id, {metric_select()} FROM scored_infer WHERE vol_actual > 0 GROUP BY 1")
def _(s, d):
    return metrics.metrics_by_program(i.scored(s, d))


@check("metrics_document", f"program_id is_total:bigint {METRIC_SPEC}", ["scored_infer"],
       f"SELECT program_id, grouping(program_id) AS is_total, {metric_select()} FROM scored_infer WHERE vol_actual > 0 "
       "GROUP BY GROUPING SETS ((), (program_id))")
def _(s, d):
    return metrics.metrics_document(i.scored(s, d))


@check("evaluated_programs", "program_id n_rows:bigint r2_score rmse mae sl_actual_mean:double label:string", ["scored_infer"], f"""
SELECT program_id, n_rows, round(r2_model, 4) AS r2_score, round(rmse_model, 4) AS rmse, round(mae_model, 4) AS mae,
 round(sl_actual_mean, 3) AS sl_actual_mean, CASE WHEN r2_model > 0.3 THEN 'good' WHEN r2_model > 0 THEN 'weak' ELSE 'poor' END AS label
FROM (SELECT program_id, {metric_select()} FROM scored_infer WHERE vol_actual > 0 GROUP BY 1) AS m WHERE n_rows >= 10""")
def _(s, d):
    return metrics.evaluated_programs(i.scored(s, d).where("vol_actual > 0"))


@check("metrics_by_band", "band:string n_rows:bigint mae_model rmse_model r2_model:double", ["scored_infer"], f"""
SELECT * FROM (SELECT CASE WHEN sl_actual < 0.3 THEN 'sl_0_30' WHEN sl_actual < 0.6 THEN 'sl_30_60' WHEN sl_actual < 0.8 THEN 'sl_60_80'
 ELSE 'sl_80_100' END AS band, {metric_select()} FROM scored_infer WHERE vol_actual > 0 GROUP BY 1) AS b WHERE n_rows >= 10""")
def _(s, d):
    return metrics.metrics_by_band(i.scored(s, d).where("vol_actual > 0"))


@check("psi_drift", "program_id n_expected n_actual:bigint psi:double drift:string", ["clean_train"], """
WITH r AS (SELECT program_id, sl_actual, ref_date < DATE '2024-01-25' AS is_e FROM clean_train),
sp AS (SELECT program_id, min(sl_actual) AS lo, max(sl_actual) AS hi FROM r GROUP BY 1),
b AS (SELECT r.program_id, is_e, greatest(0, least(9, (SELECT count(*) FROM (SELECT unnest(range(0, 11)) AS e) AS g
   WHERE CASE WHEN e = 10 THEN hi ELSE e * ((hi - lo) / 10) + lo END <= sl_actual) - 1)) AS bin FROM r JOIN sp USING (program_id)),
n AS (SELECT program_id, count(*) FILTER (is_e) AS ne, count(*) FILTER (NOT is_e) AS na FROM r GROUP BY 1),
p AS (SELECT n.program_id, ne, na, bins.bin,
   cast((SELECT count(*) FROM b WHERE b.program_id = n.program_id AND b.bin = bins.bin AND is_e) AS double) / nullif(ne, 0) AS e,
   cast((SELECT count(*) FROM b WHERE b.program_id = n.program_id AND b.bin = bins.bin AND NOT is_e) AS double) / nullif(na, 0) AS a
 FROM n, (SELECT unnest(range(0, 10)) AS bin) AS bins),
q AS (SELECT program_id, ne, na, CASE WHEN e = 0 THEN 0.0001 ELSE e END AS e, CASE WHEN a = 0 THEN 0.0001 ELSE a END AS a FROM p),
t AS (SELECT program_id, ne AS n_expected, na AS n_actual, coalesce(sum((a - e) * ln(a / e)), 0) AS psi FROM q GROUP BY ALL)
SELECT *, CASE WHEN psi > 0.15 THEN 'DRIFT' ELSE 'STABLE' END AS drift FROM t""")
def _(s, d):
    role = F.when(F.col("ref_date") < "2024-01-25", "train").otherwise("test")
    return metrics.psi_drift(i.light(s, d, "training").withColumn("role", role))


P5 = "impact_volume impact_people impact_handle_time impact_health impact_context"


@check("pillar_means", f"program_id:bigint {P5}:double", ["pillars_infer"],
       "SELECT program_id, " + ", ".join(f"avg({c}) AS {c}" for c in P5.split()) + " FROM pillars_infer GROUP BY 1")
def _(s, d):
    return drivers.pillar_means(drivers.pillar_rollup(i.scored(s, d)))


@check("mean_abs_attribution", "program_id:bigint feature:string mean_abs:double", ["long_infer"],
       "SELECT program_id, feature, avg(abs(impact)) AS mean_abs FROM long_infer GROUP BY 1, 2")
def _(s, d):
    return drivers.mean_abs_attribution(i.scored(s, d))


NAMES = ", ".join(f"'{f}'" for f in demo.LINEAR_FEATURES)


@check("importance_report", "program_id rank position:bigint feature:string importance:double is_top is_unused:boolean", ["long_infer"], f"""
SELECT *, rank <= 5 AS is_top, importance = 0 AS is_unused FROM (
 SELECT *, row_number() OVER (PARTITION BY program_id ORDER BY importance DESC, position) AS rank FROM (
  SELECT program_id, feature, list_position([{NAMES}], feature) AS position, round(avg(abs(impact)), 9) AS importance
  FROM long_infer GROUP BY 1, 2) AS m) AS r""")
def _(s, d):
    """Mean absolute attributions of the linear model in the place of a trained model's importances."""
    names = F.array(*map(F.lit, demo.LINEAR_FEATURES))
    table = drivers.mean_abs_attribution(i.scored(s, d)).select(
        "program_id", "feature", F.array_position(names, F.col("feature")).alias("position"), F.round("mean_abs", 9).alias("importance"))
    return metrics.importance_report(table)


@check("min_slot_per_date", "ref_date:date min_slot:bigint", ["mart"],
       "SELECT ref_date, min(slot) AS min_slot FROM mart GROUP BY 1")
def _(s, d):
    return forecast.min_slot_per_date(i.mart(s, d))


READY = """SELECT p.program_id, coalesce(n, 0) AS n_rows, coalesce(op, 0) AS n_operational,
 CASE WHEN coalesce(n, 0) = 0 THEN 'no_data' WHEN op = 0 THEN 'inactive' WHEN op < 50 THEN 'insufficient' ELSE 'trainable' END AS status
FROM (SELECT DISTINCT program_id FROM fx_plan) AS p LEFT JOIN
 (SELECT program_id, count(*) AS n, count(*) FILTER (sl_actual > 0) AS op FROM clean_train GROUP BY 1) AS c USING (program_id)"""


def _ready(s, d):
    return metrics.training_readiness(i.light(s, d, "training"), demo.plan(s, d).select("program_id").distinct())


@check("training_readiness", "program_id n_rows n_operational:bigint status:string", ["fx_plan", "clean_train"], READY)
def _(s, d):
    return _ready(s, d)


@check("training_summary", "n_trained n_skipped trained_rows:bigint", ["fx_plan", "clean_train"], f"""
SELECT count(*) FILTER (status = 'trainable') AS n_trained, count(*) FILTER (status <> 'trainable') AS n_skipped,
 coalesce(sum(n_rows) FILTER (status = 'trainable'), 0) AS trained_rows FROM ({READY}) AS r""")
def _(s, d):
    return metrics.training_summary(_ready(s, d))


CORR = ["vol_plan", "vol_actual", "hc_plan", "aht_plan_total", "absence_rate_daily", "avg_wait", "occupancy", "pressure_vol_hc",
        "capacity_margin", "log_gap_rate_daily", "new_hire_pct_daily", "hour", "weekday", "sl_plan", "sl_actual"]


@check("correlation_matrix", "feature_a feature_b:string corr:double", ["rows_infer"], "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM rows_infer"
    for n, a in enumerate(CORR) for b in CORR[n:]))
def _(s, d):
    return metrics.correlation_matrix(i.rows(s, d), CORR)


@check("histogram", "bin n_rows:bigint", ["scored_infer"], """
SELECT least(29, CASE WHEN hi > lo THEN floor((sl_pred - lo) / ((hi - lo) / 30)) ELSE 0 END) AS bin, count(*) AS n_rows
FROM scored_infer, (SELECT min(sl_pred) AS lo, max(sl_pred) AS hi FROM scored_infer) AS r GROUP BY 1""")
def _(s, d):
    return metrics.histogram(i.scored(s, d), "sl_pred")


@check("grain_check", "ref_date:date program_id agent_id copies:bigint", ["fx_agents"],
       "SELECT work_date AS ref_date, program_id, agent_id, count(*) AS copies FROM fx_agents GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(s, d):
    """Agent-day keys that repeat (the fan-out factor of the new-hire join)."""
    a = demo.agents(s, d).withColumnRenamed("work_date", "ref_date")
    return columns.grain_check(a, ["ref_date", "program_id", "agent_id"])


@check("cv_summary", "program_id n_folds:bigint cv_r2_mean cv_r2_std:double", ["scored_train"], f"""
WITH r AS (SELECT *, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY program_id) AS n FROM scored_train
 WINDOW w AS (PARTITION BY program_id ORDER BY slot_ts, channel_id)),
f AS (SELECT program_id, fold, sl_actual, sl_pred FROM r, (SELECT unnest(range(0, 5)) AS fold) AS g
 WHERE k >= n - (5 - fold) * (n // 6) AND k < n - (4 - fold) * (n // 6))
SELECT program_id, count(*) AS n_folds, avg(r2) AS cv_r2_mean, stddev_pop(r2) AS cv_r2_std
FROM (SELECT program_id, fold, {R2.format(y='sl_actual', p='sl_pred')} AS r2 FROM f GROUP BY 1, 2) AS x GROUP BY 1""")
def _(s, d):
    folds = history.time_folds(i.scored(s, d, "training"), 5).where("role = 'test'")
    scores = folds.groupBy("program_id", "fold").agg(metrics.r2("sl_actual", "sl_pred").alias("r2"))
    return metrics.cv_summary(scores)
