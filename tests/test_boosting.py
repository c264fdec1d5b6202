"""Batched boosting against a plain-Python booster that knows nothing of Spark."""

import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from slotwise.config import EngineConfig, ModelConfig
from slotwise.models import boosting
from slotwise.models import training as tr
from slotwise.models.boosting import Span, Unit, copies, grow, uniform
from slotwise.models.shap import explain_trees
from slotwise.sources import demo

FEATS = ["hour", "vol_plan", "sl_lag_1", "sl_plan"]
PARAMS = ModelConfig(trees=6, depth=3, step=0.3, subsample=1.0, feature_fraction="all", min_instances=3, l1=1.0, l2=2.0, folds=2)
CFG = EngineConfig(as_of=demo.AS_OF, programs=(1, 2), mode="training", features=tuple(FEATS), model=PARAMS)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(1)
    n = 300
    out = pd.DataFrame({
        "program_id": np.repeat([1, 2], n // 2).astype("int32"), "channel_id": np.int32(7),
        "slot_ts": pd.date_range("2024-01-01", periods=n // 2, freq="30min").tolist() * 2,
        "hour": rng.integers(0, 24, n), "vol_plan": rng.integers(0, 6, n), "sl_lag_1": rng.random(n), "sl_plan": rng.random(n)})
    out["sl_actual"] = np.clip(0.2 + 0.05 * out["hour"] + 0.3 * out["sl_lag_1"] * (out["program_id"] == 1) + 0.05 * rng.random(n), 0, 1.0)
    out["weight"] = rng.integers(1, 4, n)
    return out


@pytest.fixture(scope="module")
def data(spark, pdf):
    return spark.createDataFrame(pdf).repartition(5).cache()


def median(values):
    """The smallest value that half of the values do not pass."""
    return sorted(values)[math.ceil(len(values) / 2) - 1]


def bins_of(part):
    """Cuts at the ranks of the quantiles, and the number of cuts below each value."""
    cuts = []
    for f in FEATS:
        values = sorted(part[f].astype(float))
        cuts.append(sorted({values[max(math.ceil(k / boosting.BINS * len(values)) - 1, 0)] for k in range(1, boosting.BINS)}))
    return cuts, np.array([[sum(c < v for c in cs) for cs, v in zip(cuts, row)] for row in part[FEATS].to_numpy(float)])


def plain_tree(bins, rows, g, h, names, unit, depth):
    total = lambda some, values: math.fsum(values[i] for i in some)
    big, many = total(rows, g), total(rows, h)
    l1, l2, least = unit.of("l1"), unit.of("l2"), unit.params.min_instances
    gain = lambda a, b: max(abs(a) - l1, 0) ** 2 / (b + l2) if b + l2 > 0 else 0.0
    best = None
    if depth < unit.of("depth"):
        for k in names:
            for cut in sorted({bins[i][k] for i in rows}):
                left = [i for i in rows if bins[i][k] <= cut]
                a, b = total(left, g), total(left, h)
                if min(b, many - b) >= least and b > 0 and many - b > 0:
                    gained = round(gain(a, b) + gain(big - a, many - b) - gain(big, many), boosting.GAIN_DIGITS)
                    if best is None or gained > best[0]:
                        best = gained, k, cut, left
    if best is None or best[0] <= 0:
        value = -math.copysign(max(abs(big) - l1, 0), big) / (many + l2) if many + l2 > 0 else 0.0
        return lambda row: value
    _, k, cut, left = best
    sides = [plain_tree(bins, some, g, h, names, unit, depth + 1) for some in (left, sorted(set(rows) - set(left)))]
    return lambda row: sides[int(row[k] > cut)](row)


def plain_scores(part, unit, y, w):
    """Scores of all rows of a program after the unit's trees."""
    part = part.sort_values("slot_ts", ignore_index=True)
    cuts, bins = bins_of(part)
    n, number = len(part), np.arange(1, len(part) + 1)
    seen = (number <= unit.span.stop(n)) & ((y < 1) | (not unit.span.below))
    score = np.full(n, median(y[seen]) if unit.objective == "absolute" else 0.0)
    for tree in range(unit.of("trees")):
        g, h = boosting.gradient(unit.objective, score, y)
        if unit.bootstrap:
            weight = w * copies(number, unit.seed_of(tree))
        else:
            weight = np.where(uniform(number, unit.seed_of(tree)) < unit.params.subsample, w, 0.0) if unit.params.subsample < 1 else w
        rows = [i for i in range(n) if seen[i] and weight[i] > 0]
        names = [FEATS.index(f) for f in unit.drawn(tree)]
        grown = plain_tree(bins, rows, g * weight, h * weight, names, unit, 0)
        score = score + unit.of("step") * np.array([grown(row) for row in bins])
    return score


UNITS = {
    "plain": {},
    "no penalty": {"l1": 0.0, "l2": 0.0},
    "drawn rows and features": {"params": replace(PARAMS, subsample=0.6, feature_fraction="0.6")},
    "fold": {"span": Span(1, 3)},
    "squared": {"objective": "squared", "l1": 0.0},
    "logistic": {"objective": "logistic", "l1": 0.0, "params": replace(PARAMS, min_instances=1)},
    "below": {"span": Span(below=True)},
    "tail": {"span": Span(tail=0.2, tail_below=1000)},
    "deep": {"params": replace(PARAMS, trees=2, depth=6, min_instances=1, l1=0.0)},
}


@pytest.mark.parametrize("whole", [True, False])
def test_equals_plain_booster(pdf, data, monkeypatch, whole):
    """All kinds of units of both programs in one run; by levels: stages every two trees, several tasks, pieces of a program."""
    monkeypatch.setattr(boosting, "TREES_PER_STAGE", 2)
    monkeypatch.setattr(boosting, "LEAST_WORK", 500)
    if not whole:
        monkeypatch.setattr(boosting, "WHOLE_ROWS", 40)
    units = [Unit(**({"program_id": p, "features": tuple(FEATS), "params": PARAMS, "member": name} | given)) for p in (1, 2) for name, given in UNITS.items()]
    grown = grow(boosting.prepare(data, {1: FEATS, 2: FEATS}, F.col("sl_actual"), F.col("weight")), units)
    nodes, wanted = grown.nodes().cache(), {}
    for i, unit in enumerate(grown.units):
        part = pdf[pdf["program_id"] == unit.program_id].sort_values("slot_ts", ignore_index=True)
        wanted[i] = plain_scores(part, unit, part["sl_actual"].to_numpy(), part["weight"].to_numpy(float))
        assert np.ptp(wanted[i]) > 0
    for name in UNITS:  # the node table gives the scores from the raw features
        out = explain_trees(data, nodes.where(F.col("member") == name), {1: FEATS, 2: FEATS}, attribute=False)
        out = out.select("program_id", "slot_ts", "raw_value").toPandas().sort_values(["program_id", "slot_ts"])
        want = np.concatenate([wanted[i] for i, u in enumerate(grown.units) if u.member == name])
        np.testing.assert_allclose(out["raw_value"], want, atol=1e-9, err_msg=name)
    tests = grown.fold_scores.toPandas()
    assert set(tests["unit"]) == {i for i, u in enumerate(units) if u.span.fold >= 0}
    for i, part in tests.groupby("unit"):
        span = grown.units[i].span
        np.testing.assert_allclose(sorted(part["score"]), sorted(wanted[i][span.stop(150) : span.test_stop(150)]), atol=1e-9)


def test_forest_equals_plain_trees(pdf, data):
    cfg = replace(CFG, model=replace(PARAMS, trees=6, depth=2))
    units = tr.forest_units({1: FEATS}, cfg)
    assert len(units) == 3 and all(u.of("depth") == 4 for u in units)
    nodes = grow(boosting.prepare(data, {1: FEATS}, F.col("sl_actual")), units).nodes()
    out = tr.member_scores(data.where("program_id = 1"), nodes, "forest", {1: FEATS}).toPandas().sort_values("slot_ts")
    part = pdf[pdf["program_id"] == 1]
    want = sum(plain_scores(part, u, part["sl_actual"].to_numpy(), np.ones(150)) for u in units)
    np.testing.assert_allclose(out["forest"], want, atol=1e-9)
    assert abs(copies(np.arange(100_000), 5).mean() - 1) < 0.02


def test_folds_equal_time_folds(data):
    """A fold as a bound on the row number tests the rows that the copied form tests."""
    from slotwise.operators.history import time_folds

    folds = time_folds(data, 3).groupBy("program_id", "fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("row_num"))).alias("stop"), F.max(F.when(F.col("role") == "test", F.col("row_num"))).alias("end"))
    for r in folds.collect():
        assert (Span(r["fold"], 3).stop(150), Span(r["fold"], 3).test_stop(150)) == (r["stop"], r["end"])


def test_one_program_does_not_change_another(data):
    """Units share passes, not results; and a run repeats."""
    fs = {1: FEATS, 2: FEATS[:3]}
    both, again = (tr.train_per_program(data, fs, CFG).nodes.toPandas() for _ in range(2))
    one = tr.train_per_program(data, {1: FEATS}, CFG).nodes.toPandas()
    key = ["program_id", "tree", "node"]
    tidy = lambda df: df.sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(tidy(both), tidy(again))
    pd.testing.assert_frame_equal(tidy(both[both["program_id"] == 1]), tidy(one))
    assert set(both[both["program_id"] == 2]["feature"].dropna()) <= set(FEATS[:3])


def test_levels_do_not_grow_with_programs(data, monkeypatch):
    """By levels: trees times depth aggregates, whatever the number of programs and folds."""
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 40)
    many = data.where("program_id = 1").withColumn("program_id", F.explode(F.array(*[F.lit(p) for p in range(8)])))
    calls, original = [], boosting.best_cuts
    monkeypatch.setattr(boosting, "best_cuts", lambda *a: calls.append(1) or original(*a))
    cfg = replace(CFG, model=replace(PARAMS, trees=2))
    out = tr.time_series_cv(many, {p: FEATS for p in range(8)}, cfg, 3)
    assert len(calls) <= 2 * PARAMS.depth and out.count() == 24
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 1000)
    whole = tr.time_series_cv(many, {p: FEATS for p in range(8)}, cfg, 3)
    tidy = lambda df: df.orderBy("program_id", "fold").toPandas()
    pd.testing.assert_frame_equal(tidy(out), tidy(whole))


def test_search_halves(data, monkeypatch):
    monkeypatch.setattr(tr, "RUNGS", (2, 4))
    cfg = replace(CFG, model=replace(PARAMS, search_folds=2))
    found = tr.param_search(data, {1: FEATS, 2: FEATS}, cfg, 5, (5, 6)).toPandas()
    assert len(found) == 10 and found.groupby("program_id")["is_best"].sum().tolist() == [1, 1]
    for _, part in found.groupby("program_id"):
        assert sorted(part["grown"].clip(upper=5)) == [2, 2, 4, 5, 5]
        done = part[part["complete"]]
        assert done.loc[done["cv_mae"].idxmin(), "is_best"] and set(part[~part["complete"]]["is_best"]) == {False}
    best = tr.best_params(data.sparkSession.createDataFrame(found), PARAMS)
    assert best[1].l1 == found[found["is_best"] & (found["program_id"] == 1)]["l1"].iloc[0] and best[1].folds == PARAMS.folds


def test_ensemble_members(data):
    fs = {1: FEATS, 2: FEATS}
    for members, weights in ((["forest"], (0.7,)), (["ridge", "boosted"], (0.9, 0.1)), (["boosted", "forest", "ridge", "forest"], (0.4, 0.3))):
        out = tr.ensemble(data, data, fs, CFG, members, weights).toPandas()
        used = [weights[min(i, len(weights) - 1)] for i in range(len(members))]
        want = sum(out[m] * w for m, w in zip(members, used)) / sum(weights[: len(members)])
        np.testing.assert_allclose(out["sl_pred"], want, atol=1e-9)
    with pytest.raises(ValueError):
        tr.ensemble(data, data, fs, CFG, ["nobody"])


def test_labels_without_value_are_left_out(spark, data):
    holes = data.withColumn("sl_actual", F.when(F.col("hour") > 3, F.col("sl_actual")))
    model = tr.train_per_program(holes, {1: FEATS}, CFG)
    n = holes.where("program_id = 1 AND sl_actual IS NOT NULL").count()
    assert model.nodes.where("tree = 0 AND node = 0").first()["cover"] == n
    assert abs(model.importances.agg(F.sum("importance")).first()[0] - 1) < 1e-9
