"""Whole runs on the small tables: invariants of training, scoring and publishing."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.config import ModelConfig
from slotwise.models import training as tr
from slotwise.models.shap import score_trees
from slotwise.plans import scoring
from slotwise.plans.training import training_run
from slotwise.sources import demo, forecast
from slotwise.sources.stages import new_stage
from slotwise.sources.stores import load_encoding
from verification import inputs

CFG = demo.config("training", model=ModelConfig(trees=2, depth=2, folds=2, search_trials=2, search_folds=2, min_operational=20))


@pytest.fixture(scope="module")
def history(spark, sf_dir):
    return inputs.history_stage(spark, sf_dir)


@pytest.fixture(scope="module")
def run(spark, sf_dir, history):
    programs = demo.plan(spark, sf_dir).select("program_id").distinct()
    return training_run(history, programs, CFG, {900001: ["sl_lag_2"]}, tree_range=(1, 2))


def test_parts_are_disjoint_and_complete(run):
    assert run.future.count() == 0  # only rows with volume are trained on
    assert run.train.agg(F.max("ref_date")).first()[0] < run.test.agg(F.min("ref_date")).first()[0]


def test_every_program_has_a_status(run):
    status = {r.program_id: r.status for r in run.readiness.collect()}
    assert status[900005] == "no_data" and sorted(status) == list(demo.PROGRAMS)
    trained = {p for p, s in status.items() if s == "trainable"}
    assert set(run.model.features) == trained and run.summary.first().n_trained == len(trained)
    assert "sl_lag_2" not in run.model.features[900001] and "sl_lag_2" in run.model.features[900000]


def test_metrics_are_complete(run):
    names = {r.metric for r in run.metrics.select("metric").distinct().collect()}
    assert {"psi", "r2_model_test", "mae_model_train", "r2_model_in_sample_last_fold", "cv_r2_mean"} <= names


def test_saved_run_scores_and_publishes(spark, run, history):
    path = run.save(new_stage(spark, "run"))
    model, enc = tr.load_models(spark, path), load_encoding(spark, f"{path}/encoding")
    rows = scoring.inference_run(history, demo.config(), enc, lambda r: score_trees(r, model.nodes, model.features))
    batch = scoring.forecast_rows(rows, inputs.AS_OF)
    assert [f.dataType.simpleString() for f in batch.schema] == [t for _, t in forecast.FACT_FIELDS]
    pdf = rows.toPandas()
    assert pdf["sl_pred"].between(0, 1).all() and (pdf[pdf["vol_plan"] == 0]["sl_pred"] == 0).all()
    total = pdf[list(catalog.PILLAR_COLUMNS)].sum(axis=1) + pdf["base_value"]
    assert (total - pdf["raw_value"]).abs().max() < 1e-9  # every input belongs to one pillar
    assert str(pdf["ref_date"].min()) == "2024-01-31" and 900005 not in set(pdf["program_id"])
    table = new_stage(spark, "forecast")
    forecast.publish(spark, table, batch)
    forecast.publish(spark, table, batch)
    assert forecast.read_forecast(spark, table, batch.schema).count() == len(pdf)


def test_benchmark_covers_the_last_days(spark, run, history):
    rows, scores = scoring.benchmark_run(
        history, demo.config(), run.encoding, lambda r: score_trees(r, run.model.nodes, run.model.features), 7)
    span = rows.agg(F.min("ref_date"), F.max("ref_date")).first()
    assert (str(span[0]), str(span[1])) == ("2024-01-24", "2024-01-30")
    assert rows.columns == scoring.RESULT_COLUMNS
    total = [r for r in scores.collect() if r.is_total == 1][0]
    assert total.n_rows == rows.where("vol_actual > 0").count()


def test_residual_target_runs(spark, sf_dir, history):
    cfg = replace(CFG, target="sl_residual")
    programs = demo.plan(spark, sf_dir).select("program_id").distinct()
    done = training_run(history, programs, cfg, None, False, False)
    worst = done.metrics.where("metric = 'mae_model_test'").agg(F.max("value")).first()[0]
    assert 0 <= worst <= 1


def test_ensemble_gives_the_test_metrics(spark, sf_dir, history):
    """use_ensemble and its member list change the test metrics, and only those."""
    programs = demo.plan(spark, sf_dir).select("program_id").distinct()
    found = []
    for changes in ({}, {"use_ensemble": True, "ensemble_members": ("ridge",)}, {"use_ensemble": True, "ensemble_members": ("boosted", "forest")}):
        cfg = replace(CFG, model=replace(CFG.model, **changes))
        rows = training_run(history, programs, cfg, None, False, False).metrics.where("metric IN ('mae_model_test', 'mae_model_train')").collect()
        found.append({(r.program_id, r.metric): r.value for r in rows})
    tests = [{k: v for k, v in f.items() if k[1] == "mae_model_test"} for f in found]
    assert tests[0] != tests[1] != tests[2] != tests[0] and all(t.keys() == tests[0].keys() for t in tests) and tests[0]
    assert [{k: v for k, v in f.items() if k[1] == "mae_model_train"} == {k: v for k, v in found[0].items() if k[1] == "mae_model_train"} for f in found] == [True] * 3
