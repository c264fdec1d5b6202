"""Model operators. Tree fits have no SQL twin; linear ones do."""

from dataclasses import replace

from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.models import training as tr
from slotwise.models.linear import linear_per_program, score_linear
from slotwise.models.shap import score_trees
from slotwise.operators import cleaning, features, metrics
from slotwise.sources import demo
from slotwise.sources.stages import new_stage, staged
from verification import inputs as i
from verification.registry import check
from verification.sqltext import METRIC_SPEC, metric_select

K = i.KEYS
CFG = demo.config("training")


def train_rows(s, d):
    """Training features, staged by program."""
    return staged(i.feats(s, d, "training"), "features", "program_id")


def _features(s, d):
    """Inputs of every program that has actuals."""
    programs = cleaning.active_programs(i.live_mart(s, d, "training")).where("is_active")
    return tr.features_of(programs, CFG)


def _halves(s, d):
    rows = train_rows(s, d)
    cut = F.col("ref_date") < "2024-01-25"
    return rows.where(cut), rows.where(~cut)


@check("train_per_program")
def _(s, d):
    """Boosted regressors of all programs, as saved and reloaded node tables."""
    rows = train_rows(s, d)
    model = tr.train_per_program(rows, _features(s, d), CFG)
    return tr.load_models(s, tr.save_models(model, new_stage(s, "models"))).nodes


@check("feature_importance")
def _(s, d):
    rows = train_rows(s, d)
    return tr.train_per_program(rows, _features(s, d), CFG).importances


@check("importance_report_trained")
def _(s, d):
    rows = train_rows(s, d)
    return metrics.importance_report(tr.train_per_program(rows, _features(s, d), CFG).importances)


@check("linear_per_program", "program_id n_rows:bigint slope center base_value:double", ["clean_train"], """
SELECT program_id, count(*) AS n_rows, regr_slope(sl_actual, sl_plan) AS slope, avg(sl_plan) AS center, avg(sl_actual) AS base_value
FROM clean_train GROUP BY 1""")
def _(s, d):
    coefs = linear_per_program(i.light(s, d, "training"), ["sl_plan"], "sl_actual")
    return coefs.select("program_id", "n_rows", F.get("weights", F.lit(0)).alias("slope"),
                        F.get("centers", F.lit(0)).alias("center"), "base_value")


@check("linear_all_features")
def _(s, d):
    """Ridge over all 37 inputs: one aggregation for all programs."""
    return linear_per_program(train_rows(s, d), catalog.FEATURES, "sl_actual", 20.0)


@check("time_series_cv")
def _(s, d):
    return tr.time_series_cv(train_rows(s, d), _features(s, d), CFG)


@check("param_search")
def _(s, d):
    return tr.param_search(train_rows(s, d), _features(s, d), CFG)


SIZES = "SELECT program_id, count(*) AS n FROM feat_train WHERE program_id IN (SELECT program_id FROM mart_train GROUP BY 1 HAVING sum(vol_actual) > 0) GROUP BY 1"


@check("cv_fold_sizes", "program_id fold n_rows:bigint", ["feat_train", "mart_train"],
       f"SELECT program_id, fold, n // 6 AS n_rows FROM ({SIZES}) AS s, (SELECT unnest(range(5)) AS fold) AS f")
def _(s, d):
    """Every program is tested on five folds of n div 6 rows: the exact part of the cross-validation."""
    cfg = replace(CFG, model=replace(CFG.model, trees=1))  # sizes do not depend on the trees
    return tr.time_series_cv(train_rows(s, d), _features(s, d), cfg).select("program_id", "fold", "n_rows")


@check("param_search_summary", "program_id n_trials n_best n_in_range n_stopped_or_complete:bigint", ["feat_train", "mart_train"],
       f"SELECT program_id, 20 AS n_trials, 1 AS n_best, 20 AS n_in_range, 20 AS n_stopped_or_complete FROM ({SIZES}) AS s")
def _(s, d):
    """The exact part of a search as configured: trials, one best of the complete ones, all eight parameters in range."""
    found = tr.param_search(train_rows(s, d), _features(s, d), CFG)
    low_high = {("feature_fraction" if k == "feature" else k): v for k, v in tr.SEARCH.items()}
    inside = F.lit(True)
    for name, (low, high) in low_high.items():
        inside = inside & F.col(name).cast("double").between(low, high)
    rungs = F.lit(False)
    for r in tr.RUNGS:
        rungs = rungs | (F.col("grown") == r)
    return found.groupBy("program_id").agg(
        F.count_distinct("trial").alias("n_trials"), F.count_if(F.col("is_best") & F.col("complete")).alias("n_best"),
        F.count_if(inside).alias("n_in_range"), F.count_if(F.col("complete") | (rungs & (F.col("grown") < F.col("trees")))).alias("n_stopped_or_complete"))


@check("ensemble")
def _(s, d):
    train, test = _halves(s, d)
    return tr.ensemble(train, test, _features(s, d), CFG).select(*catalog.KEYS, "boosted", "forest", "ridge", "sl_pred")


@check("weighted_sum", f"{K} sl_pred:double", ["clean_infer"],
       "SELECT *, sl_plan * (0.5173917 / 0.8486276) + least(sl_actual, 0.37) * (0.3312359 / 0.8486276) AS sl_pred FROM clean_infer")
def _(s, d):
    rows = i.light(s, d).withColumn("cap", F.least("sl_actual", F.lit(0.37)))
    return tr.weighted_sum(rows, ["sl_plan", "cap"], (0.5173917, 0.3312359, 0.2))


@check("two_stage")
def _(s, d):
    train, test = _halves(s, d)
    return tr.two_stage(train, test, _features(s, d), CFG).select(*catalog.KEYS, "prob_below", "sl_pred")


@check("score_per_program", f"{K} raw_value sl_pred:double", ["scored_infer"], "SELECT * FROM scored_infer")
def _(s, d):
    """Linear scoring; programs without a model drop out."""
    return i.scored(s, d)


@check("score_trees")
def _(s, d):
    rows = train_rows(s, d)
    model = tr.train_per_program(rows, _features(s, d), CFG)
    return score_trees(rows, model.nodes, model.features, attribute=False).select(*catalog.KEYS, "raw_value", "sl_pred")


@check("attributions", f"{K} position:bigint feature pillar:string impact:double", ["long_infer"], "SELECT * FROM long_infer")
def _(s, d):
    return i.scored(s, d).select(*catalog.KEYS, F.inline("contribs"))


@check("attributions_trees")
def _(s, d):
    """Exact Shapley values of the boosted models: base + impacts = raw value."""
    rows = train_rows(s, d)
    model = tr.train_per_program(rows, _features(s, d), CFG)
    out = score_trees(rows, model.nodes, model.features)
    return out.select(*catalog.KEYS, "base_value", "raw_value", F.inline("contribs"))


FOREST_LEVEL = "greatest(0.0, least(1.0, 1 - (exp(raw_value) - 1)))"


def fixed_model(s, d):
    """The fixed forest for every program that has actuals, as a trained model."""
    features = {p: list(demo.FOREST_FEATURES) for p in _features(s, d)}
    programs = s.createDataFrame([(p,) for p in features], "program_id int")
    nodes = demo.forest_nodes(programs)
    inputs = s.createDataFrame([(p, k, f, 0.0) for p, fs in features.items() for k, f in enumerate(fs)], tr.IMPORTANCES)
    return tr.Trained(nodes, inputs, features)


@check("score_trees_fixed", f"{K} raw_value sl_pred:double", ["forest_scored_train"], "SELECT * FROM forest_scored_train")
def _(s, d):
    """A hand-written forest, scored from its node table after storage."""
    model = tr.load_models(s, tr.save_models(fixed_model(s, d), new_stage(s, "models")))
    return score_trees(train_rows(s, d), model.nodes, model.features, attribute=False)


@check("attributions_trees_fixed", f"{K} position:bigint feature pillar:string impact base_value:double", ["forest_long_train"],
       "SELECT * FROM forest_long_train")
def _(s, d):
    """Attributions by path patterns against all subsets of features."""
    model = fixed_model(s, d)
    out = score_trees(train_rows(s, d), model.nodes, model.features)
    return out.select(*catalog.KEYS, "base_value", F.inline("contribs"))


@check("evaluate_holdout_fixed", f"program_id:bigint part:string {METRIC_SPEC}", ["forest_scored_train"],
       f"SELECT program_id, CASE WHEN ref_date < DATE '2024-01-25' THEN 'train' ELSE 'test' END AS part, {metric_select()} "
       f"FROM (SELECT * REPLACE ({FOREST_LEVEL} AS sl_pred) FROM forest_scored_train) AS x GROUP BY 1, 2")
def _(s, d):
    train, test = _halves(s, d)
    return tr.evaluate_holdout(train, test, fixed_model(s, d), CFG)


@check("backtest_fixed", f"program_id:bigint {METRIC_SPEC}", ["forest_scored_train"],
       f"SELECT program_id, {metric_select()} FROM (SELECT * REPLACE ({FOREST_LEVEL} AS sl_pred) FROM forest_scored_train) AS x "
       "WHERE ref_date >= DATE '2024-01-25' GROUP BY 1")
def _(s, d):
    return metrics.metrics_by_program(tr.backtest(_halves(s, d)[1], fixed_model(s, d), CFG))


@check("evaluate_holdout")
def _(s, d):
    train, test = _halves(s, d)
    model = tr.train_per_program(train, _features(s, d), CFG)
    return tr.evaluate_holdout(train, test, model, CFG)


@check("evaluate_holdout_linear", f"program_id:bigint {METRIC_SPEC}", ["scored_train"],
       f"SELECT program_id, {metric_select()} FROM scored_train WHERE ref_date >= DATE '2024-01-25' GROUP BY 1")
def _(s, d):
    return metrics.metrics_by_program(i.scored(s, d, "training").where("ref_date >= DATE '2024-01-25'"))


@check("backtest")
def _(s, d):
    train, test = _halves(s, d)
    model = tr.train_per_program(train, _features(s, d), CFG)
    rows = tr.backtest(test, model, CFG)
    return metrics.metrics_by_program(rows)


LINEAR_WHAT_IF = {"vol_plan": 0.0, "aht_plan_total": 0.0, "strain_index": 0.0}


def _what_if_terms() -> str:
    terms = []
    for f, w, c in demo.LINEAR_MODEL:
        value = "0.0" if f in LINEAR_WHAT_IF else "CASE WHEN hc_plan > 0 THEN 1.0 ELSE 0.0 END" if f == "capacity_margin" else f
        terms.append(f"({w!r} * (({value}) - {c!r}))")
    return " + ".join(terms)


@check("what_if_volume", "program_id n_rows:bigint mean_change max_change:double", ["scored_infer"], f"""
SELECT program_id, count(*) AS n_rows, avg(changed - raw_value) AS mean_change, max(abs(changed - raw_value)) AS max_change
FROM (SELECT *, {demo.LINEAR_BASE!r} + {_what_if_terms()} AS changed FROM scored_infer) AS t GROUP BY 1""")
def _(s, d):
    """Zero planned volume everywhere: change of the raw prediction per program."""
    history = i.history_stage(s, d)
    base = i.feats(s, d, "inference", history)
    coefs, cols = i.coefs(history), demo.LINEAR_FEATURES
    a = score_linear(base, coefs, cols).select(*catalog.KEYS, "raw_value")
    b = score_linear(features.override_volume(base, 0), coefs, cols).select(*catalog.KEYS, F.col("raw_value").alias("changed"))
    diff = F.col("changed") - F.col("raw_value")
    return a.join(b, catalog.KEYS).groupBy("program_id").agg(
        F.count("*").alias("n_rows"), F.avg(diff).alias("mean_change"), F.max(F.abs(diff)).alias("max_change"))


