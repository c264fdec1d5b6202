from dataclasses import replace
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import EngineConfig, ModelConfig
from slotwise.models import training as tr
from slotwise.models.linear import linear_per_program, moments, score_linear, total_moment
from slotwise.models.shap import explain_rows, explain_trees, leaves_of, score_trees
from slotwise.operators.metrics import correlation_matrix
from slotwise.sources import demo
from slotwise.sources.stages import new_stage

FEATS = ["hour", "vol_plan", "sl_lag_1", "sl_plan"]
CFG = EngineConfig(
    as_of=demo.AS_OF, programs=(1, 2), mode="training", features=tuple(FEATS),
    model=ModelConfig(trees=3, depth=3, step=0.5, subsample=1.0, feature_fraction="all", min_instances=2, folds=2),
)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 240
    pdf = pd.DataFrame({
        "program_id": np.repeat([1, 2], n // 2).astype("int32"), "channel_id": np.int32(7),
        "slot_ts": pd.date_range("2024-01-01", periods=n // 2, freq="30min").tolist() * 2,
        "hour": rng.integers(0, 24, n), "vol_plan": rng.integers(0, 6, n), "sl_lag_1": rng.random(n), "sl_plan": rng.random(n)})
    pdf["sl_actual"] = np.clip(0.3 + 0.02 * pdf["hour"] + 0.3 * pdf["sl_lag_1"] * (pdf["program_id"] == 1), 0, 1)
    pdf["vol_actual"] = 3
    return spark.createDataFrame(pdf).repartition(4).cache()


@pytest.fixture(scope="module")
def model(data):
    return tr.train_per_program(data, {1: FEATS, 2: FEATS[:3]}, CFG)


def shapley_by_definition(nodes, names, x):
    """All subsets of features: the value of a subset is the cover-weighted tree output."""
    trees = {t: {r.node: r for r in part.itertuples()} for t, part in nodes.groupby("tree")}

    def value(subset):
        def walk(tree, node):
            if node.left < 0:
                return node.value
            left, right = tree[node.left], tree[node.right]
            if node.feature in subset:
                return walk(tree, left if x[names.index(node.feature)] <= node.threshold else right)
            return (left.cover * walk(tree, left) + right.cover * walk(tree, right)) / node.cover
        return sum(t[0].weight * walk(t, t[0]) for t in trees.values())

    k = len(names)
    phi = []
    for f in names:
        others = [o for o in names if o != f]
        phi.append(sum(
            factorial(s) * factorial(k - s - 1) / factorial(k) * (value({*c, f}) - value(set(c)))
            for s in range(k) for c in combinations(others, s)))
    return phi, value(set()), value(set(names))


def test_attribution_equals_definition(model, data):
    nodes = model.nodes.where("program_id = 1").toPandas()
    x = data.where("program_id = 1").select(*FEATS).limit(12).toPandas().to_numpy(dtype=float)
    impacts, raw, base = explain_rows(x, leaves_of(nodes, FEATS))
    for i, row in enumerate(x):
        phi, empty, full = shapley_by_definition(nodes, FEATS, row)
        np.testing.assert_allclose(impacts[i], phi, atol=1e-12)
        assert abs(base - empty) < 1e-12 and abs(raw[i] - full) < 1e-12


def test_repeated_feature_on_a_path():
    """x split twice on the same path: the leaf's interval and share combine."""
    cols = ["tree", "weight", "node", "left", "right", "feature", "threshold", "value", "cover"]
    nodes = pd.DataFrame([
        (0, 1.0, 0, 1, 2, "a", 5.0, 0.0, 10.0), (0, 1.0, 1, 3, 4, "a", 2.0, 0.0, 6.0), (0, 1.0, 2, -1, -1, None, np.nan, 4.0, 4.0),
        (0, 1.0, 3, -1, -1, None, np.nan, 1.0, 2.0), (0, 1.0, 4, 5, 6, "b", 0.0, 0.0, 4.0),
        (0, 1.0, 5, -1, -1, None, np.nan, 2.0, 1.0), (0, 1.0, 6, -1, -1, None, np.nan, 3.0, 3.0)], columns=cols)
    x = np.array([[1.0, 0.0], [2.0, 9.0], [3.0, -1.0], [5.0, 1.0], [6.0, 1.0]])
    impacts, raw, base = explain_rows(x, leaves_of(nodes, ["a", "b"]))
    assert raw.tolist() == [1.0, 1.0, 2.0, 3.0, 4.0]
    for i, row in enumerate(x):
        np.testing.assert_allclose(impacts[i], shapley_by_definition(nodes, ["a", "b"], row)[0], atol=1e-12)


def test_scoring_contract(data, model):
    extra = data.limit(5).withColumn("program_id", F.lit(3))
    out = score_trees(data.unionByName(extra), model.nodes, model.features).toPandas()
    assert set(out["program_id"]) == {1, 2}  # no model, no row
    assert out["sl_pred"].between(0, 1).all() and (out[out["vol_plan"] == 0]["sl_pred"] == 0).all()
    sums = out["contribs"].map(lambda c: sum(x["impact"] for x in c)) + out["base_value"]
    assert (sums - out["raw_value"]).abs().max() < 1e-9
    assert {len(c) for c in out[out["program_id"] == 2]["contribs"]} == {3}
    flipped = score_trees(data, model.nodes, model.features, orient="sl").toPandas()
    a = out.set_index(["program_id", "slot_ts"])["contribs"].sort_index()
    b = flipped.set_index(["program_id", "slot_ts"])["contribs"].sort_index()
    assert all(abs(x["impact"] + y["impact"]) < 1e-12 for p, q in zip(a, b) for x, y in zip(p, q))


def test_nodes_stay_off_the_driver(data, model, monkeypatch):
    from slotwise.models import shap

    key = ["program_id", "slot_ts"]
    columns = [*key, "base_value", "raw_value", "sl_pred"]
    whole = score_trees(data, model.nodes, model.features).select(*columns).toPandas()

    def no(*_):
        raise AssertionError("collected")

    with monkeypatch.context() as m:
        m.setattr(shap, "GROUP_ROWS", 7, raising=False)
        for kind in {type(data), type(data).__mro__[1]}:
            m.setattr(kind, "toPandas", no)
        out = score_trees(data, model.nodes, model.features).select(*columns)
    many = out.toPandas()
    pd.testing.assert_frame_equal(whole.sort_values(key, ignore_index=True), many.sort_values(key, ignore_index=True))


def test_registered_queries_run_the_defaults(monkeypatch):
    from verification import models, registry

    assert models.CFG.model == ModelConfig()
    asked = {}
    for name in ("time_series_cv", "param_search"):
        monkeypatch.setattr(tr, name, lambda rows, features, cfg, *given, name=name: asked.update({name: given}))
    monkeypatch.setattr(models, "train_rows", lambda s, d: None)
    monkeypatch.setattr(models, "_features", lambda s, d: None)
    monkeypatch.setattr(registry, "present", lambda df: df)
    for name in ("time_series_cv", "param_search"):
        registry.QUERIES[name](None, "")
    assert asked == {"time_series_cv": (), "param_search": ()}


def test_models_survive_storage(spark, model):
    back = tr.load_models(spark, tr.save_models(model, new_stage(spark, "models")))
    assert back.features == {1: FEATS, 2: FEATS[:3]}
    assert back.nodes.count() == model.nodes.count()


def test_linear_equals_numpy(data):
    coefs = {r.program_id: r for r in linear_per_program(data, FEATS, "sl_actual").collect()}
    pdf = data.toPandas()
    for p, part in pdf.groupby("program_id"):
        x = np.column_stack([np.ones(len(part)), part[FEATS]])
        want = np.linalg.lstsq(x, part["sl_actual"], rcond=None)[0]
        np.testing.assert_allclose(coefs[p].weights, want[1:], atol=1e-8)
    scored = score_linear(data, linear_per_program(data, FEATS, "sl_actual"), FEATS, target_transform=False).toPandas()
    assert (scored["contribs"].map(lambda c: sum(x["impact"] for x in c)) + scored["base_value"] - scored["raw_value"]).abs().max() < 1e-9


def test_ridge_equals_closed_form(data):
    pdf = data.where("program_id = 1").toPandas()
    x, y = pdf[FEATS].to_numpy(dtype=float), pdf["sl_actual"].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 20 * np.eye(4), z.T @ (y - y.mean())) / x.std(0)
    got = linear_per_program(data.where("program_id = 1"), FEATS, "sl_actual", 20.0).first()
    np.testing.assert_allclose(got.weights, want, atol=1e-9)


def test_moments_merge_to_the_covariance(data):
    pdf = data.where("program_id = 2").toPandas()[["hour", "sl_plan"]].to_numpy(dtype=float)
    parts = moments(data.repartition(5), ["hour", "sl_plan"]).where("program_id = 2").toPandas()
    n, means, products = total_moment(parts, 2)
    assert n == len(pdf) and len(parts) > 1
    np.testing.assert_allclose(means, pdf.mean(0), atol=1e-9)
    np.testing.assert_allclose(products / n, np.cov(pdf.T, bias=True), atol=1e-9)


def test_large_means_keep_their_spread(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 2))
    x[:, 1] = 0.7 * x[:, 0] + 0.7 * x[:, 1]
    pdf = pd.DataFrame({"program_id": 1, "a": x[:, 0] + 1e7, "b": x[:, 1] + 1e7, "same": 1e7})
    df = spark.createDataFrame(pdf).repartition(6)
    found = {(r.feature_a, r.feature_b): r["corr"] for r in correlation_matrix(df, ["a", "b", "same"]).collect()}
    assert abs(found["a", "b"] - np.corrcoef(x.T)[0, 1]) < 1e-6 and abs(found["a", "a"] - 1) < 1e-9
    assert found["a", "same"] is None and found["same", "same"] is None
    assert "Python" not in correlation_matrix(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]
    fit = linear_per_program(df, ["a", "same"], "b").first()
    slope = np.polyfit(x[:, 0], x[:, 1], 1)[0]
    np.testing.assert_allclose(fit.weights, [slope, 0.0], atol=1e-6)


def test_missing_features_are_named(spark, data):
    nodes = spark.createDataFrame([], "program_id int")
    with pytest.raises(ValueError, match="program 1: nowhere"):
        explain_trees(data, nodes, {1: [*FEATS, "nowhere"], 2: FEATS})


def test_no_programs(spark, data):
    assert tr.ensemble(data, data, {}, CFG).count() == 0
    assert tr.two_stage(data, data, {}, CFG).count() == 0


def test_cv_and_search(data):
    cv = tr.time_series_cv(data, {1: FEATS, 2: FEATS}, CFG, 2).toPandas()
    assert len(cv) == 4 and (cv["n_rows"] == 40).all() and (cv["r2"] <= 1).all()
    found = tr.param_search(data, {1: FEATS}, replace(CFG, model=replace(CFG.model, search_folds=2)), 2, (1, 2)).toPandas()
    assert found["is_best"].sum() == 1
    best = found.loc[found["cv_mae"].idxmin()]
    assert best["is_best"]
    tuned = tr.best_params(data.sparkSession.createDataFrame(found), CFG.model)
    assert tuned[1].depth == best["depth"] and tuned[1].folds == CFG.model.folds


def test_search_space_is_seeded():
    a, b = (tr.search_space(5, 42, CFG.model) for _ in range(2))
    assert a == b and all(50 <= m.trees <= 300 and 3 <= m.depth <= 7 and 0.01 <= m.step <= 0.2 for m in a)


def test_ensemble_weights(spark, data):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert abs(tr.weighted_sum(df, ["a", "b"], (0.5, 0.3, 0.2)).first().sl_pred - 0.5 / 0.8) < 1e-12
    out = tr.ensemble(data, data, {1: FEATS, 2: FEATS}, CFG).toPandas()
    want = 0.5 * out["boosted"] + 0.3 * out["forest"] + 0.2 * out["ridge"]
    assert len(out) == 240 and (out["sl_pred"] - want).abs().max() < 1e-9


def test_two_stage_routes(data):
    full = data.withColumn("sl_actual", F.when(F.col("hour") >= 12, 1.0).otherwise(F.col("sl_actual")))
    fs = {1: FEATS, 2: FEATS}
    by_label = tr.two_stage(full, full, fs, CFG, "label").toPandas()
    assert (by_label[by_label["sl_actual"] == 1]["sl_pred"] == 1).all() and len(by_label) == 240
    by_vote = tr.two_stage(full, full, fs, CFG).toPandas()
    routed = by_vote["prob_below"] > 0.5
    assert (by_vote[~routed]["sl_pred"] == 1).all() and 0 < routed.sum() < 240
    rare = full.withColumn("sl_actual", F.lit(1.0))
    assert (tr.two_stage(rare, rare, fs, CFG).toPandas()["sl_pred"] - 1).abs().max() < 1e-9
    with pytest.raises(ValueError):
        tr.two_stage(full, full, fs, CFG, "other")


def test_last_fold_or_tail(data):
    short = data.where("program_id = 2").orderBy("slot_ts").limit(15)
    rows = data.where("program_id = 1").unionByName(short)
    out = tr.last_fold(rows, CFG).toPandas()
    assert (out[out["program_id"] == 1]["role"] == "test").sum() == 40
    assert (out[out["program_id"] == 2]["role"] == "test").sum() == 3


def test_final_span():
    assert tr.final_span(CFG).stop(120) == 120 and tr.final_span(CFG).stop(15) == 12
    no_cv = replace(CFG, model=replace(CFG.model, use_cv=False))
    assert tr.final_span(no_cv).stop(120) == 96


def test_holdout_of_residual_target(data):
    cfg = replace(CFG, target="sl_residual")
    rows = data.withColumn("sl_residual", F.col("sl_actual") - F.col("sl_plan"))
    model = tr.train_per_program(rows, {1: FEATS}, cfg)
    out = tr.evaluate_holdout(rows.where("program_id = 1"), rows.where("program_id = 1"), model, cfg).toPandas()
    assert set(out["part"]) == {"train", "test"} and (out["mae_model"] <= 1).all()
