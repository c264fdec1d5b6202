"""End-to-end compositions."""

import datetime as dt

from slotwise import catalog
from slotwise.models.linear import score_linear
from slotwise.models.shap import score_trees
from slotwise.operators import cleaning, encoding, reports
from slotwise.plans import scoring
from slotwise.plans.training import training_run
from slotwise.sources import demo, forecast
from slotwise.sources.stages import new_stage, staged
from verification import inputs as i
from verification.models import CFG, fixed_model
from verification.registry import check, columns
from verification.sqltext import D, METRIC_SPEC, div, metric_select

K = i.KEYS
P5 = " ".join(catalog.PILLAR_COLUMNS)
DRIVERS = " ".join(f"{x}_{k}_name {x}_{k}_pillar:string {x}_{k}_impact:double" for x in ("detractor", "booster") for k in (1, 2, 3))


@check("interval_mart", i.MART_SPEC, ["mart"], "SELECT * FROM mart")
def _(s, d):
    return i.mart(s, d)


@check("raw_history", f"{i.MART_SPEC} {i.GAP_INTS}", ["raw_infer"], "SELECT * FROM raw_infer")
def _(s, d):
    return reports.order_keys(i.raw(s, d))


@check("clean", f"{i.MART_SPEC} {i.GAP_INTS} slot_ts:timestamp hour weekday:bigint sl_actual:double is_operational:boolean",
       ["clean_train"], "SELECT *, true AS is_operational FROM clean_train")
def _(s, d):
    return i.clean(s, d, "training")


@check("clean_inference", f"{i.MART_SPEC} {i.GAP_INTS} slot_ts:timestamp hour weekday:bigint sl_actual:double",
       ["clean_infer"], "SELECT * FROM clean_infer")
def _(s, d):
    return i.clean(s, d)


INT_FEATURES = {"vol_plan", "hc_plan", "aht_plan_total", "hour", "weekday", "vacation", "missed_days", "day_of_month",
                "week_of_month", "day_of_week", "hour_cycle"}
FEATURES = " ".join(f"{f}:{'bigint' if f in INT_FEATURES else 'double'}" for f in catalog.FEATURES)


@check("feature_table", f"{K} {FEATURES} sl_actual:double", ["feat_train"], "SELECT * FROM feat_train")
def _(s, d):
    return i.feats(s, d, "training")


@check("feature_table_inference", f"{K} {FEATURES} sl_actual:double", ["feat_infer"], "SELECT * FROM feat_infer")
def _(s, d):
    return i.feats(s, d)


def _stored(history):
    return encoding.target_encoding_fit(cleaning.clean(history, demo.config("training")))


def _linear(history):
    coefs = i.coefs(history)
    return lambda rows: score_linear(rows, coefs, demo.LINEAR_FEATURES)


RUN = f"{K} sl_pred:double vol_plan hc_plan:bigint aht_plan_avg sl_lag_1 avg_wait_lag_1 vol_dev_pct_lag_1 {P5}:double {DRIVERS}"


@check("inference_run_linear", RUN, ["explained_infer"], f"SELECT * FROM explained_infer WHERE ref_date >= {D}")
def _(s, d):
    history = i.history_stage(s, d)
    return scoring.inference_run(history, demo.config(), _stored(history), _linear(history))


@check("mean_prediction", "program_id n_rows:bigint sl_pred_mean:double", ["scored_infer"],
       f"SELECT program_id, count(*) AS n_rows, avg(sl_pred) AS sl_pred_mean FROM scored_infer WHERE ref_date >= {D} GROUP BY 1")
def _(s, d):
    history = i.history_stage(s, d)
    return scoring.mean_prediction(scoring.inference_run(history, demo.config(), _stored(history), _linear(history)))


@check("benchmark_run_linear", f"{K} vol_actual vol_plan hc_plan:bigint sl_actual sl_plan_wfm sl_pred {P5}:double {DRIVERS}",
       ["explained_bench"], f"SELECT *, sl_plan AS sl_plan_wfm FROM explained_bench WHERE ref_date >= {D} - 7")
def _(s, d):
    history = i.history_stage(s, d)
    return scoring.benchmark_run(history, demo.config(), _stored(history), _linear(history))[0]


@check("benchmark_metrics_linear", f"program_id is_total:bigint {METRIC_SPEC}", ["scored_bench"],
       f"SELECT program_id, grouping(program_id) AS is_total, {metric_select()} FROM scored_bench WHERE ref_date >= {D} - 7 "
       "AND vol_actual > 0 GROUP BY GROUPING SETS ((), (program_id))")
def _(s, d):
    history = i.history_stage(s, d)
    return scoring.benchmark_run(history, demo.config(), _stored(history), _linear(history))[1]


def _fixed(s, d):
    model = fixed_model(s, d)
    return lambda rows: score_trees(rows, model.nodes, model.features)


@check("inference_run_fixed", RUN, ["forest_explained_infer"], f"SELECT * FROM forest_explained_infer WHERE ref_date >= {D}")
def _(s, d):
    """The inference run with a hand-written forest: everything after the fit, against SQL."""
    history = i.history_stage(s, d)
    return scoring.inference_run(history, demo.config(), _stored(history), _fixed(s, d))


@check("benchmark_run_fixed", f"{K} vol_actual vol_plan hc_plan:bigint sl_actual sl_plan_wfm sl_pred {P5}:double {DRIVERS}",
       ["forest_explained_bench"], f"SELECT *, sl_plan AS sl_plan_wfm FROM forest_explained_bench WHERE ref_date >= {D} - 7")
def _(s, d):
    history = i.history_stage(s, d)
    return scoring.benchmark_run(history, demo.config(), _stored(history), _fixed(s, d))[0]


@check("benchmark_pillars", f"program_id is_total:bigint mae_model {P5}:double", ["forest_explained_bench"],
       f"SELECT program_id, grouping(program_id) AS is_total, {metric_select()}, " + ", ".join(f"avg({c}) AS {c}" for c in catalog.PILLAR_COLUMNS)
       + f" FROM forest_explained_bench WHERE ref_date >= {D} - 7 AND vol_actual > 0 GROUP BY GROUPING SETS ((), (program_id))")
def _(s, d):
    """Mean pillar impacts next to the metrics of a benchmark run."""
    history = i.history_stage(s, d)
    return scoring.benchmark_run(history, demo.config(), _stored(history), _fixed(s, d))[1]


def _trained(s, d, **given):
    history = i.history_stage(s, d)
    programs = demo.plan(s, d).select("program_id").distinct()
    return history, training_run(history, programs, CFG, **given)


@check("training_run")
def _(s, d):
    """Metric rows of a training run as configured: search, folds and final models."""
    return _trained(s, d)[1].metrics


@check("inference_run")
def _(s, d):
    """Train without search and folds, score the future rows, publish, read back."""
    history, run = _trained(s, d, cross_validate=False, tune=False)
    enc = staged(run.encoding, "encoding")
    rows = scoring.inference_run(history, demo.config(), enc, lambda r: score_trees(r, run.model.nodes, run.model.features))
    batch = scoring.forecast_rows(rows, i.AS_OF)
    path = new_stage(s, "forecast")
    forecast.publish(s, path, batch)
    return forecast.read_forecast(s, path, batch.schema).select(*forecast.FACT_COLUMNS)


@check("benchmark_run")
def _(s, d):
    """Train without search and folds, score the last week, report rows."""
    history, run = _trained(s, d, cross_validate=False, tune=False)
    enc = staged(run.encoding, "encoding")
    return scoring.benchmark_run(
        history, demo.config(), enc, lambda r: score_trees(r, run.model.nodes, run.model.features), 7)[0]


FRONT_INTS = "vol_actual vol_plan vol_delta vol_answered vol_in_sla vol_abandoned hc_plan missed_days vacation pause_tech_sec pause_personal_sec:bigint"
FRONT_DBL = ("abandon_rate_now hc_equiv hc_delta absence_rate_now aht_now aht_plan wait_now sl_now sl_pred sl_plan sl_lag_1 "
             "impact_people impact_volume impact_handle_time impact_context:double")


FRONT_SQL = f"""
SELECT m.*, m.vol_actual - m.vol_plan AS vol_delta, {div('m.vol_abandoned', 'm.vol_actual')} AS abandon_rate_now,
 m.hc_equiv - m.hc_plan AS hc_delta, {div('m.absence_sec', 'm.scheduled_sec')} AS absence_rate_now, {div('m.aht_actual_total', 'm.vol_actual')} AS aht_now,
 {div('m.aht_plan_total', 'm.vol_plan')} AS aht_plan, {div('m.wait_total', 'm.vol_answered')} AS wait_now, {div('m.vol_in_sla', 'm.vol_actual')} AS sl_now,
 e.sl_pred, e.sl_lag_1, e.impact_people, e.impact_volume, e.impact_handle_time, e.impact_context,
 {', '.join('e.' + c.split(':')[0] for c in DRIVERS.split())}
FROM mart m LEFT JOIN (SELECT * FROM explained_infer WHERE ref_date >= {D}) AS e USING (ref_date, slot, program_id, channel_id)
WHERE m.ref_date >= {D} AND m.channel_id = 7 AND m.program_id BETWEEN 900000 AND 900005"""
FRONT_TYPES = columns(f"{K} {FRONT_INTS} {FRONT_DBL} {DRIVERS}")


def _frontend(name, variant):
    """The BI screen in its full form and its two smaller ones."""
    spec = " ".join(f"{c}:{FRONT_TYPES[c]}" for c in reports.FRONTEND_VARIANTS[variant])

    @check(name, spec, ["mart", "explained_infer"], FRONT_SQL)
    def _(s, d):
        history = i.history_stage(s, d)
        run = scoring.inference_run(history, demo.config(), _stored(history), _linear(history))
        published = run.select(*[c for c in forecast.FACT_COLUMNS if c != "updated_at"])
        return reports.bi_frontend(i.mart(s, d), published, i.AS_OF, demo.PROGRAMS, 7, variant)


_frontend("bi_frontend", "full")
_frontend("bi_frontend_without_plan", "without_plan_sl")
_frontend("bi_frontend_reduced", "reduced")


@check("plan_vs_model", "ref_date:date slot program_id:bigint sl_plan sl_pred sl_actual abs_err_plan abs_err_model impact_people "
       "impact_volume impact_handle_time:double detractor_1_name:string detractor_1_impact:double booster_1_name:string booster_1_impact:double",
       ["explained_infer"], f"""
SELECT *, abs(sl_actual - sl_plan) AS abs_err_plan, abs(sl_actual - sl_pred) AS abs_err_model FROM explained_infer WHERE ref_date >= {D} - 3""")
def _(s, d):
    """Forecast of the last three days and the future against the mart."""
    history = i.history_stage(s, d)
    rows = scoring.explained(score_linear(i.feats(s, d, "inference", history), i.coefs(history), demo.LINEAR_FEATURES))
    published = rows.select(*[c for c in forecast.FACT_COLUMNS if c != "updated_at"])
    return reports.order_keys(
        reports.plan_vs_model(published, i.mart(s, d), i.AS_OF - dt.timedelta(days=3)), ["ref_date", "slot", "program_id"])
