"""Projections, predicates and scalar rules."""

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.functions import clock, numbers, suffix
from slotwise.operators import cleaning, columns, features, metrics, reports, windows
from slotwise.operators import mart as mart_ops
from slotwise.operators.drivers import pillar_of
from slotwise.sources import demo
from verification import inputs as i
from verification.registry import check
from verification.sqltext import D, div

K = i.KEYS


@check("slot_floor", "raw_minute slot n_rows:bigint", ["fx_intraday"],
       "SELECT raw_minute, raw_minute - raw_minute % 30 AS slot, count(*) AS n_rows FROM fx_intraday GROUP BY 1, 2")
def _(s, d):
    return demo.intraday(s, d).groupBy("raw_minute", clock.slot_floor("raw_minute").alias("slot")).agg(
        F.count("*").alias("n_rows"))


@check("date_window", "mode:string ref_date:date n_rows:bigint", ["fx_system"], f"""
SELECT 'inference' AS mode, work_date AS ref_date, count(*) AS n_rows FROM fx_system
 WHERE work_date >= DATE '2024-01-02' AND work_date <= {D} + 2 GROUP BY work_date
UNION ALL SELECT 'cutoff', work_date, count(*) FROM fx_system
 WHERE work_date >= DATE '2024-01-05' AND work_date < DATE '2024-01-21' GROUP BY work_date
UNION ALL SELECT 'open', work_date, count(*) FROM fx_system WHERE work_date > DATE '2024-01-11' GROUP BY work_date""")
def _(s, d):
    """Three window modes; with as_of at 10:00 the day exactly n days ago is outside."""
    t = demo.system_time(s, d)
    ten = i.AS_OF.replace(hour=10)
    cases = {
        "inference": windows.date_window("work_date", 30, ten, "inference", None, 2),
        "cutoff": windows.date_window("work_date", 15, i.AS_OF, "training", "20/01/2024"),
        "open": windows.date_window("work_date", 20, ten, "training"),
    }
    modes = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(m)) for m, c in cases.items()])))
    return t.select(modes.alias("mode"), F.col("work_date").alias("ref_date")).groupBy("mode", "ref_date").agg(
        F.count("*").alias("n_rows"))


@check("program_filter", "program_id channel_id n_rows:bigint", ["fx_intraday"],
       "SELECT program_id, channel_id, count(*) AS n_rows FROM fx_intraday "
       "WHERE program_id IN (900001, 900003) AND channel_id = 7 GROUP BY 1, 2")
def _(s, d):
    return windows.program_filter(demo.intraday(s, d), [900001, 900003], 7).groupBy("program_id", "channel_id").agg(
        F.count("*").alias("n_rows"))


def _joined(s, d):
    return mart_ops.full_outer_actual_plan(
        mart_ops.intraday_agg(demo.intraday(s, d), i.AS_OF), mart_ops.plan_agg(demo.plan(s, d), i.AS_OF))


@check("null_to_zero", f"{K} vol_actual vol_plan hc_plan idle_sec queue_sec:bigint", ["slots"],
       "SELECT ref_date, slot, program_id, channel_id, coalesce(vol_actual, 0) AS vol_actual, coalesce(vol_plan, 0) AS vol_plan, "
       "coalesce(hc_plan, 0) AS hc_plan, coalesce(idle_sec, 0) AS idle_sec, coalesce(queue_sec, 0) AS queue_sec FROM slots")
def _(s, d):
    return mart_ops.null_to_zero(_joined(s, d))


@check("hc_equiv", f"{K} hc_equiv:double", ["slots"],
       "SELECT ref_date, slot, program_id, channel_id, cast(coalesce(idle_sec, 0) / 1800.0 AS decimal(10,2)) AS hc_equiv FROM slots")
def _(s, d):
    return mart_ops.hc_equiv(_joined(s, d))


@check("weighted_plan", f"{K} sl_plan:double aht_plan_total:bigint", ["slots"],
       "SELECT ref_date, slot, program_id, channel_id, CASE WHEN vol_plan > 0 THEN cast(sla_weighted AS double) / vol_plan / 100.0 "
       "ELSE 0 END AS sl_plan, coalesce(aht_weighted, 0) AS aht_plan_total FROM slots")
def _(s, d):
    return mart_ops.weighted_plan(_joined(s, d), 100.0)


@check("time_groups", f"{K} aht_actual_total wait_total pause_tech_sec pause_personal_sec pause_mgmt_sec:bigint", ["mart"],
       "SELECT * FROM mart")
def _(s, d):
    return mart_ops.time_groups(_joined(s, d))


@check("parse_slot_ts", "ref_date:date clock_text:string slot_ts:timestamp n_rows:bigint", ["fx_intraday"], """
SELECT row_date AS ref_date, clock_text, CASE WHEN clock_text = 'n/a' THEN NULL ELSE
  cast(row_date AS timestamp) + to_minutes(cast(raw_minute AS int)) END AS slot_ts, count(*) AS n_rows
FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN 'n/a' ELSE
  printf('%02d:%02d:00.0000000', cast(raw_minute // 60 AS int), cast(raw_minute % 60 AS int)) END AS clock_text FROM fx_intraday) AS t GROUP BY ALL""")
def _(s, d):
    m = F.col("raw_minute")
    text = F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(
        F.format_string("%02d:%02d:00.0000000", F.floor(m / 60).cast("int"), m % 60))
    t = demo.intraday(s, d).select(F.col("row_date").alias("ref_date"), text.alias("clock_text"))
    return t.withColumn("slot_ts", clock.parse_slot_timestamp("ref_date", "clock_text")).groupBy(
        "ref_date", "clock_text", "slot_ts").agg(F.count("*").alias("n_rows"))


@check("clock_parts", f"{K} slot_ts:timestamp hour weekday:bigint", ["mart_infer"],
       "SELECT *, cast(ref_date AS timestamp) + to_minutes(slot) AS slot_ts, floor(slot / 60) AS hour, isodow(ref_date) - 1 AS weekday FROM mart_infer")
def _(s, d):
    return cleaning.clock_parts(cleaning.with_slot_ts(i.live_mart(s, d)))


@check("relevant_slots", f"{K} vol_plan vol_actual hc_plan:bigint", ["mart"],
       "SELECT * FROM mart WHERE vol_plan > 0 OR vol_actual > 0 OR hc_plan > 0")
def _(s, d):
    return cleaning.relevant_slots(i.mart(s, d))


@check("target", f"{K} sl_actual sl_plan sl_residual:double", ["mart_infer"], f"""
SELECT * REPLACE (greatest(0, least(1, sl_plan)) AS sl_plan), sl_actual - greatest(0, least(1, sl_plan)) AS sl_residual
FROM (SELECT *, greatest(0, least(1, {div('vol_in_sla', 'vol_actual')})) AS sl_actual FROM mart_infer) AS t""")
def _(s, d):
    return cleaning.target(i.live_mart(s, d), "sl_residual")


@check("fill_numeric", f"{K} {i.GAP_INTS} sl_plan:double", ["raw_infer"],
       "SELECT ref_date, slot, program_id, channel_id, sl_plan, " + ", ".join(
           f"coalesce({c}, 0) AS {c}" for c in catalog.LOG_GAP_COLUMNS) + " FROM raw_infer")
def _(s, d):
    return columns.fill_numeric(i.raw(s, d))


@check("operational_filter", f"{K} vol_actual:bigint is_operational:boolean", ["mart_train"],
       "SELECT *, true AS is_operational FROM mart_train WHERE vol_actual >= 2")
def _(s, d):
    return cleaning.operational_filter(i.live_mart(s, d, "training"), True, 2)


INTEGERS = {"vol_delta", "day_of_month", "week_of_month", "day_of_week", "hour_cycle"}


def _features(name, step, cols, ctes="rows_infer"):
    spec = " ".join([K, *[f"{c}:{'bigint' if c in INTEGERS else 'double'}" for c in cols]])
    check(name, spec, [ctes], f"SELECT * FROM {ctes}")(step)


_features("delta_features", lambda s, d: features.delta_features(i.light(s, d)),
          ["vol_delta", "hc_delta", "aht_actual_avg", "aht_plan_avg", "aht_delta"])
_features("synthetic_features", lambda s, d: features.synthetic_features(i.light(s, d)),
          ["pressure_vol_hc", "strain_index", "vol_per_agent", "occupancy_synth", "capacity_margin", "staffing_dev_pct",
           "staffing_ratio", "overload_rate"])
_features("rate_features", lambda s, d: features.rate_features(features.delta_features(i.light(s, d))),
          ["absence_rate_daily", "turnover_rate_daily", "abandon_rate", "avg_wait", "occupancy", "pause_tech_rate",
           "pause_personal_rate", "pause_mgmt_rate", "hc_dev_pct", "vol_dev_pct"])
_features("log_gap_features", lambda s, d: features.log_gap_features(i.clean(s, d)),
          ["log_gap_rate_daily", "tech_issue_rate_daily", "new_hire_pct_daily", "agent_issue_rate_daily"])
_features("seasonality", lambda s, d: features.seasonality(i.light(s, d)),
          ["day_of_month", "week_of_month", "day_of_week", "is_month_edge", "is_mon_fri", "is_weekend", "hour_cycle",
           "is_peak_hour"])


@check("target_transform", f"{K} forward inverse:double", ["clean_infer"],
       "SELECT *, ln(1 + (1 - sl_actual)) AS forward, 1 - (exp(ln(1 + (1 - sl_actual))) - 1) AS inverse FROM clean_infer")
def _(s, d):
    df = i.light(s, d).withColumn("forward", numbers.to_target_space("sl_actual"))
    return df.withColumn("inverse", numbers.from_target_space("forward"))


RES = "(cast((slot % 90) AS double) / 90 - 0.4)"


@check("clip_residual", f"{K} residual_pred sl_pred sl_actual:double was_clipped:boolean", ["clean_infer"], f"""
SELECT *, abs(residual_pred) > 0.15 AS was_clipped,
  greatest(0, least(1, sl_plan + greatest(-0.15, least(0.15, residual_pred)))) AS sl_pred
FROM (SELECT *, {RES} AS residual_pred FROM clean_infer) AS t""")
def _(s, d):
    df = i.light(s, d).withColumns(
        {"residual_pred": F.expr(RES), "sl_residual": F.col("sl_actual") - F.col("sl_plan")})
    return metrics.residual_final(df, 0.15).withColumn("sl_actual", numbers.clip("sl_actual"))


@check("post_rules", f"{K} sl_pred:double", ["clean_infer"], f"""
SELECT *, CASE WHEN vol_plan = 0 THEN 0 ELSE greatest(0, least(1, sl_plan + 2 * {RES})) END AS sl_pred FROM clean_infer""")
def _(s, d):
    return i.light(s, d).withColumn("sl_pred", numbers.publishable(F.expr(f"sl_plan + 2 * {RES}"), "vol_plan"))


@check("sample_weights", f"{K} weight:double", ["clean_train"],
       "SELECT *, CASE WHEN sl_actual < 1 THEN 10 ELSE 1 END AS weight FROM clean_train")
def _(s, d):
    return i.light(s, d, "training").withColumn("weight", numbers.sample_weight("sl_actual"))


@check("recent_window", "program_id n_rows:bigint first_ts last_ts:timestamp", ["clean_train"], """
SELECT program_id, count(*) AS n_rows, min(slot_ts) AS first_ts, max(slot_ts) AS last_ts
FROM clean_train c JOIN (SELECT program_id, max(slot_ts) AS newest FROM clean_train GROUP BY 1) n USING (program_id)
WHERE slot_ts >= newest - INTERVAL 7 DAY GROUP BY 1""")
def _(s, d):
    df = windows.recent_window(i.light(s, d, "training"), days=7, per_program=True)
    return df.groupBy("program_id").agg(
        F.count("*").alias("n_rows"), F.min("slot_ts").alias("first_ts"), F.max("slot_ts").alias("last_ts"))


@check("evaluation_window", f"{K} vol_actual:bigint slot_ts:timestamp", ["mart"],
       "SELECT *, cast(ref_date AS timestamp) + to_minutes(slot) AS slot_ts FROM mart "
       f"WHERE ref_date >= {D} - 7 AND ref_date < {D}")
def _(s, d):
    past = cleaning.with_slot_ts(windows.past_only(i.mart(s, d), i.AS_OF, 7))
    return windows.evaluation_window(past, i.AS_OF, 7)


@check("mask_non_operational", f"{K} sl_actual sl_plan:double", ["clean_infer"],
       "SELECT * REPLACE (CASE WHEN vol_actual > 0 THEN sl_actual END AS sl_actual, CASE WHEN vol_actual > 0 THEN sl_plan END AS sl_plan) FROM clean_infer")
def _(s, d):
    return cleaning.mask_non_operational(i.light(s, d))


@check("slot_end", f"{K} slot_start slot_end:string", ["mart"], """
SELECT ref_date, slot, program_id, channel_id, printf('%02d:%02d:00', cast(slot // 60 AS int), cast(slot % 60 AS int)) AS slot_start,
  printf('%02d:%02d:00', cast((slot + step) // 60 AS int), cast((slot + step) % 60 AS int)) AS slot_end
FROM mart JOIN (SELECT program_id, CASE WHEN count(*) > 1 THEN max(slot) FILTER (rk = 2) - min(slot) ELSE 30 END AS step
  FROM (SELECT program_id, slot, row_number() OVER (PARTITION BY program_id ORDER BY slot) AS rk
        FROM (SELECT DISTINCT program_id, slot FROM mart) AS u) AS r GROUP BY 1) AS st USING (program_id)""")
def _(s, d):
    return reports.slot_end(i.mart(s, d))


@check("run_suffix_parse", "suffix title executed_at:string days:bigint", ["fx_runs"], """
SELECT suffix, days, regexp_replace(suffix, '^(\\d{4})(\\d{2})(\\d{2})_(\\d{2})(\\d{2})(\\d{2})?_(\\d+)d$', 'Benchmark de \\7 dias - \\1-\\2-\\3 \\4:\\5') AS title,
  strftime(as_of, '%Y-%m-%d') || ' 03:00:00' AS executed_at FROM fx_runs
UNION ALL SELECT cast(days AS varchar) || 'd', days, 'Benchmark de ' || cast(days AS varchar) || ' dias', '' FROM fx_runs""")
def _(s, d):
    runs = demo.runs(s, d)
    names = reports.union_programs([
        runs.select(F.concat(F.lit("metrics_"), "suffix", F.lit(".json")).alias("file")),
        runs.select(F.concat(F.lit("benchmark_"), F.col("days").cast("string"), F.lit("d.csv")).alias("file"))])
    df = names.withColumn("suffix", suffix.strip_prefix("file"))
    return df.withColumns({"days": suffix.days("suffix"), "executed_at": suffix.timestamp_text("suffix"),
                           "title": suffix.title("suffix")})


@check("pillar_of", "feature pillar lookup_pillar:string n_rows:bigint", ["long_infer"], """
SELECT CASE WHEN slot = 0 THEN 'x_' || feature ELSE feature END AS feature, CASE WHEN slot = 0 THEN 'Outros' ELSE pillar END AS pillar,
 CASE WHEN slot = 0 THEN 'Geral' ELSE pillar END AS lookup_pillar, count(*) AS n_rows FROM long_infer GROUP BY ALL""")
def _(s, d):
    long = i.scored(s, d).select("slot", F.inline("contribs")).withColumn(
        "feature", F.when(F.col("slot") == 0, F.concat(F.lit("x_"), "feature")).otherwise(F.col("feature")))
    named = pillar_of(pillar_of(long, default=catalog.PILLAR_LOOKUP_DEFAULT).withColumnRenamed("pillar", "lookup_pillar"))
    return named.groupBy("feature", "pillar", "lookup_pillar").agg(F.count("*").alias("n_rows"))


@check("frontend_kpis", f"{K} vol_delta:bigint abandon_rate_now hc_delta absence_rate_now aht_now aht_plan wait_now sl_now:double", ["mart"], f"""
SELECT ref_date, slot, program_id, channel_id, vol_actual - vol_plan AS vol_delta, {div('vol_abandoned', 'vol_actual')} AS abandon_rate_now,
 hc_equiv - hc_plan AS hc_delta, {div('absence_sec', 'scheduled_sec')} AS absence_rate_now, {div('aht_actual_total', 'vol_actual')} AS aht_now,
 {div('aht_plan_total', 'vol_plan')} AS aht_plan, {div('wait_total', 'vol_answered')} AS wait_now, {div('vol_in_sla', 'vol_actual')} AS sl_now FROM mart""")
def _(s, d):
    return reports.frontend_kpis(i.mart(s, d))


@check("abs_errors", f"{K} sl_actual abs_err_plan abs_err_model:double", ["scored_infer"],
       "SELECT *, abs(sl_actual - sl_plan) AS abs_err_plan, abs(sl_actual - sl_pred) AS abs_err_model FROM scored_infer")
def _(s, d):
    return reports.abs_errors(i.scored(s, d))


@check("quality_labels", "program_id:bigint idle_label zero_label size_label:string", ["mart_train"], f"""
SELECT program_id, CASE WHEN idle / n > 0.7 THEN 'mostly_idle' WHEN idle / n > 0.5 THEN 'often_idle' ELSE 'ok' END AS idle_label,
 CASE WHEN zeros / n > 0.3 THEN 'many_zeros' ELSE 'ok' END AS zero_label, CASE WHEN n < 100 THEN 'few_rows' ELSE 'ok' END AS size_label
FROM (SELECT program_id, cast(count(*) AS double) AS n, count(*) FILTER (vol_actual < 1) AS idle,
 count(*) FILTER (vol_in_sla = 0) AS zeros FROM mart_train GROUP BY 1) AS t""")
def _(s, d):
    df = cleaning.target(i.live_mart(s, d, "training"))
    return cleaning.quality_labels(cleaning.operational_diagnostics(df), cleaning.target_distribution(df))


@check("split_ts_text", "ref_date:date slot_text:string program_id channel_id:bigint", ["clean_infer"],
       "SELECT ref_date, strftime(slot_ts, '%H:%M:%S') AS slot_text, program_id, channel_id FROM clean_infer")
def _(s, d):
    return cleaning.split_ts_text(i.light(s, d).select("slot_ts", "program_id", "channel_id"))


@check("actuals_extract", "ref_date:date slot program_id vol_in_sla vol_offered:bigint sl_actual sl_plan:double", ["mart"], f"""
SELECT ref_date, slot, program_id, vol_in_sla, vol_actual AS vol_offered, {div('vol_in_sla', 'vol_actual')} AS sl_actual, sl_plan
FROM mart WHERE program_id IN (900000, 900002, 900005) AND ref_date BETWEEN {D} - 7 AND {D} - 1 AND channel_id = 7""")
def _(s, d):
    return reports.actuals_extract(i.mart(s, d), i.AS_OF, [900000, 900002, 900005])
