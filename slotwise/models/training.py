"""Training, cross-validation, search and evaluation per program."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise import catalog
from slotwise.config import EngineConfig, ModelConfig
from slotwise.functions.numbers import clip, from_target_space, to_target_space, total
from slotwise.models.boosting import NODE_SCHEMA, Grown, Prepared, Span, Unit, grow, prepare
from slotwise.models.linear import linear_per_program
from slotwise.models.shap import explain_trees
from slotwise.operators import metrics
from slotwise.operators.columns import ensure_columns
from slotwise.operators.history import time_folds
from slotwise.operators.reports import feature_sets, union_programs
from slotwise.operators.splits import head_tail_split
from slotwise.sources.stages import staged

IMPORTANCES = "program_id int, position int, feature string, importance double"


@dataclass(frozen=True)
class Trained:
    nodes: DataFrame
    importances: DataFrame
    features: dict[int, list[str]]


def features_of(programs: DataFrame, cfg: EngineConfig, exclusions=None) -> dict[int, list[str]]:
    """Model inputs per program; one driver row per program."""
    sets = feature_sets(programs, cfg.features, exclusions).collect()
    return {r["program_id"]: list(r["features"]) for r in sets}


def _transform(cfg: EngineConfig) -> bool:
    return cfg.model.target_transform and cfg.target != "sl_residual"


def label(cfg: EngineConfig) -> Column:
    return to_target_space(cfg.target) if _transform(cfg) else F.col(cfg.target).cast("double")


Tuned = Mapping[int, ModelConfig] | None


def final_units(features: Mapping[int, Sequence[str]], cfg: EngineConfig, tuned: Tuned = None, span: Span = Span()) -> list[Unit]:
    """The model of each program; `tuned` overrides the parameters of single programs."""
    return [Unit(int(p), tuple(fs), (tuned or {}).get(p, cfg.model), span) for p, fs in sorted(features.items())]


def fold_units(features: Mapping[int, Sequence[str]], cfg: EngineConfig, k: int, tuned: Tuned = None, trial: int = 0) -> list[Unit]:
    """One unit per program and expanding-window fold."""
    return [replace(u, span=Span(i, k), trial=trial) for u in final_units(features, cfg, tuned) for i in range(k)]


def trained(grown: Grown | None, features: Mapping[int, Sequence[str]], spark: SparkSession) -> Trained:
    """Nodes of a run, and the share of each feature in the gain of its program's trees."""
    if grown is None:
        return Trained(spark.createDataFrame([], NODE_SCHEMA), spark.createDataFrame([], IMPORTANCES), {})
    nodes = staged(grown.nodes(), "nodes")
    inputs = spark.createDataFrame([(int(p), i, f) for p, fs in features.items() for i, f in enumerate(fs)], "program_id int, position int, feature string")
    gains = nodes.where("feature IS NOT NULL").groupBy("program_id", "feature").agg(F.sum("gain").alias("gain"))
    every = gains.groupBy("program_id").agg(F.sum("gain").alias("total"))
    found = inputs.join(gains, ["program_id", "feature"], "left").join(every, "program_id", "left")
    share = F.coalesce(F.col("gain") / F.col("total"), F.lit(0.0))
    return Trained(nodes, found.select("program_id", "position", "feature", share.alias("importance")), {p: list(f) for p, f in features.items()})


def train_per_program(
    rows: DataFrame, features: Mapping[int, Sequence[str]], cfg: EngineConfig, weight_col: str | None = None, tuned: Tuned = None,
) -> Trained:
    """One boosted regressor per program over all its rows, all grown in the same passes. Eager."""
    weight = F.col(weight_col) if weight_col else None
    grown = grow(prepare(rows, features, label(cfg), weight), final_units(features, cfg, tuned)) if features else None
    return trained(grown, features, rows.sparkSession)


CARRIED = [*catalog.KEYS, "slot_ts", "sl_actual", "sl_plan", "sl_residual", "vol_plan", "vol_actual", "part", "role", "fold"]


def predict(rows: DataFrame, model: Trained, cfg: EngineConfig, clipped: bool = True) -> DataFrame:
    """sl_pred in target units, clipped to [0, 1] for the direct target.

    Only model inputs and the columns that evaluation reads go to Python.
    """
    wanted = {*CARRIED, cfg.target, *(f for fs in model.features.values() for f in fs)}
    rows = rows.select(*[c for c in rows.columns if c in wanted])
    out = explain_trees(rows, model.nodes, model.features, attribute=False)
    level = from_target_space("raw_value") if _transform(cfg) else F.col("raw_value")
    if clipped and cfg.target != "sl_residual":
        level = clip(level)
    return out.withColumn("sl_pred", level).drop("features", "impacts", "base_value", "raw_value")


def fold_metrics(grown: Grown, cfg: EngineConfig) -> DataFrame:
    """R2 and MAE by program, trial and fold, on the original scale and not clipped."""
    spark = grown.fold_scores.sparkSession
    units = [(i, u.program_id, u.trial, u.span.fold) for i, u in enumerate(grown.units) if u.span.fold >= 0]
    named = spark.createDataFrame(units, "_unit int, program_id int, trial int, fold int")
    level = (lambda c: from_target_space(c)) if _transform(cfg) else F.col
    scored = grown.fold_scores.join(named, F.col("unit") == F.col("_unit")).withColumns({"_y": level("y"), "sl_pred": level("score")})
    return scored.groupBy("program_id", "trial", "fold").agg(
        F.count("*").alias("n_rows"), metrics.r2("_y", "sl_pred").alias("r2"), F.avg(F.abs(F.col("_y") - F.col("sl_pred"))).alias("mae"),
    )


def time_series_cv(
    rows: DataFrame, features: Mapping[int, Sequence[str]], cfg: EngineConfig, folds: int | None = None, tuned: Tuned = None,
) -> DataFrame:
    """R2 and MAE of every expanding-window fold. Eager.

    A fold is a bound on the row number, and every (program, fold) is a unit of one run: no row is copied.
    """
    grown = grow(prepare(rows, features, label(cfg)), fold_units(features, cfg, folds or cfg.model.folds, tuned), keep=lambda u: False)
    return fold_metrics(grown, cfg).drop("trial")


# Search ranges.
SEARCH = {
    "trees": (50, 300), "depth": (3, 7), "step": (0.01, 0.2), "min_instances": (1, 20), "l1": (0.0, 30.0), "l2": (0.0, 30.0),
    "feature": (0.5, 1.0), "subsample": (0.5, 1.0),
}
#: After so many trees the better half of a program's trials goes on.
RUNGS = (25, 75, 150)
TUNED = ("trees", "depth", "step", "min_instances", "l1", "l2", "feature_fraction", "subsample")


def search_space(trials: int, seed: int, base: ModelConfig, tree_range: tuple[int, int] | None = None) -> list[ModelConfig]:
    rng = random.Random(seed)
    low, high = tree_range or SEARCH["trees"]
    out = []
    for _ in range(trials):
        step_low, step_high = SEARCH["step"]
        out.append(
            replace(
                base,
                trees=rng.randint(low, high),
                depth=rng.randint(*SEARCH["depth"]),
                step=step_low * (step_high / step_low) ** rng.random(),
                min_instances=rng.randint(*SEARCH["min_instances"]),
                l1=rng.uniform(*SEARCH["l1"]),
                l2=rng.uniform(*SEARCH["l2"]),
                feature_fraction=f"{rng.uniform(*SEARCH['feature']):.3f}",
                subsample=rng.uniform(*SEARCH["subsample"]),
            )
        )
    return out


def param_search(
    rows: DataFrame, features: Mapping[int, Sequence[str]], cfg: EngineConfig, trials: int | None = None,
    tree_range: tuple[int, int] | None = None, prepared: Prepared | None = None,
) -> DataFrame:
    """Seeded random search by successive halving: mean fold MAE of every trial, the best one per program marked. Eager.

    All trials of all programs and folds are units of one run for each rung. After a rung the better half of a program's
    trials, by their fold scores so far, goes on; a trial that stops keeps the score it had (`grown` trees). Only complete
    trials can win.
    """
    spark, space = rows.sparkSession, search_space(trials or cfg.model.search_trials, cfg.model.seed, cfg.model, tree_range)
    prepared = prepared or prepare(rows, features, label(cfg))
    alive = {int(p): list(range(len(space))) for p in features}
    found: dict[tuple[int, int], tuple[float, int]] = {}
    most = max(m.trees for m in space)
    for rung in [*[r for r in RUNGS if r < most], most]:
        units = [
            u for t, m in enumerate(space) for u in fold_units(features, replace(cfg, model=replace(m, trees=min(m.trees, rung))), m.search_folds, trial=t)
            if t in alive[u.program_id] and found.get((u.program_id, t), (0, 0))[1] < m.trees
        ]
        scores = fold_metrics(grow(prepared, units, keep=lambda u: False), cfg).groupBy("program_id", "trial").agg(F.avg("mae").alias("cv_mae"))
        found |= {(r["program_id"], r["trial"]): (r["cv_mae"], min(rung, space[r["trial"]].trees)) for r in scores.collect()}
        for p, ts in alive.items():
            alive[p] = sorted(ts, key=lambda t: (found.get((p, t), (float("inf"), 0))[0], t))[: (len(ts) + 1) // 2]
    kinds = {"trees": "int", "depth": "int", "min_instances": "int", "feature_fraction": "string"}
    schema = ", ".join(["program_id int, trial int, cv_mae double, grown int", *[f"{c} {kinds.get(c, 'double')}" for c in TUNED]])
    rows_of = [(p, t, mae, n, *[getattr(space[t], c) for c in TUNED]) for (p, t), (mae, n) in sorted(found.items())]
    table = spark.createDataFrame(rows_of, schema).withColumn("complete", F.col("grown") == F.col("trees"))
    best = table.where("complete").groupBy("program_id").agg(F.min_by("trial", F.struct("cv_mae", "trial")).alias("best"))
    return table.join(best, "program_id").withColumn("is_best", F.col("complete") & (F.col("trial") == F.col("best"))).drop("best")


def best_params(search: DataFrame, base: ModelConfig) -> dict[int, ModelConfig]:
    """Winning parameters per program; one driver row per program."""
    return {r["program_id"]: replace(base, **{c: r[c] for c in TUNED}) for r in search.where("is_best").collect()}


def weighted_sum(df: DataFrame, members: Sequence[str], weights: Sequence[float], out: str = "sl_pred") -> DataFrame:
    """Weighted mean of member columns; weights are renormalised over the members present."""
    used = [weights[i] if i < len(weights) else weights[-1] for i in range(len(members))]
    norm = sum(weights[: len(members)])
    return df.withColumn(out, total([F.col(m) * F.lit(w / norm) for m, w in zip(members, used)]))


MEMBERS = ("boosted", "forest", "ridge")
SCORED = ["features", "impacts", "base_value", "raw_value"]


def forest_units(features: Mapping[int, Sequence[str]], cfg: EngineConfig) -> list[Unit]:
    """Half the trees, two levels deeper (at most 10), all features at every split, rows drawn with replacement; the trees are averaged."""
    n, depth = max(1, int(cfg.model.trees * 0.5)), min(cfg.model.depth + 2, 10)
    own = {"member": "forest", "objective": "squared", "bootstrap": True, "trees": 1, "depth": depth, "step": 1.0 / n, "l1": 0.0, "l2": 0.0}
    return [replace(u, **own, first_tree=t) for u in final_units(features, cfg) for t in range(n)]


def member_scores(test: DataFrame, nodes: DataFrame, member: str, features: Mapping[int, Sequence[str]]) -> DataFrame:
    """test with the raw value of one member as a column of its name."""
    scored = explain_trees(test, nodes.where(F.col("member") == member), dict(features), attribute=False)
    return scored.withColumn(member, F.col("raw_value")).drop(*SCORED)


def ensemble(
    train: DataFrame, test: DataFrame, features: Mapping[int, Sequence[str]], cfg: EngineConfig,
    members: Sequence[str] | None = None, weights: Sequence[float] | None = None,
) -> DataFrame:
    """Members fitted on `train` and predicted on `test`, each as a column, and their weighted mean. Eager.

    `members` is any list of boosted, forest and ridge; the last weight serves those without one. Boosting and forests of all
    programs grow in one run; a forest tree is a unit of one tree.
    """
    members = list(cfg.model.ensemble_members if members is None else members)
    if not members or set(members) - set(MEMBERS):
        raise ValueError(f"members are some of {', '.join(MEMBERS)}")
    if not features:
        return test.limit(0).withColumns({c: F.lit(None).cast("double") for c in (*members, "sl_pred")})
    units = final_units(features, cfg) * ("boosted" in members) + (forest_units(features, cfg) if "forest" in members else [])
    out = test.where(F.col("program_id").isin(sorted(features)))
    if units:
        nodes = staged(grow(prepare(train, features, F.col(cfg.target).cast("double")), units).nodes(), "nodes")
        for member in [m for m in MEMBERS[:2] if m in members]:
            out = member_scores(out, nodes, member, features)
    if "ridge" in members:
        out = add_linear(out, train, cfg, "ridge", cfg.model.l2)
    return weighted_sum(out, members, cfg.model.ensemble_weights if weights is None else weights)


def add_linear(out: DataFrame, train: DataFrame, cfg: EngineConfig, name: str, ridge: float) -> DataFrame:
    feats = list(cfg.features)
    coefs = linear_per_program(train, feats, cfg.target, ridge)
    joined = out.join(coefs.select("program_id", "weights", "centers", F.col("base_value").alias("_base")), "program_id")
    terms = [F.col("weights")[i] * (F.col(f).cast("double") - F.col("centers")[i]) for i, f in enumerate(feats)]
    return joined.withColumn(name, F.col("_base") + total(terms)).drop("weights", "centers", "_base")


def two_stage(
    train: DataFrame, test: DataFrame, features: Mapping[int, Sequence[str]], cfg: EngineConfig,
    route: str = "predicted", min_below: int = 10,
) -> DataFrame:
    """Classifier 'below full service' first, then a regressor fitted on rows below 1.

    route='predicted' sends a row to the regressor by the classifier's vote;
    route='label' uses the true label of the test row. Programs with fewer than
    `min_below` rows below 1 use one plain regressor. Eager: classifiers and regressors grow in one run.
    """
    if route not in ("predicted", "label"):
        raise ValueError("route is 'predicted' or 'label'")
    if not features:
        return test.limit(0).withColumns({"sl_pred": F.lit(None).cast("double")})
    y = F.col(cfg.target)
    counts = {r["program_id"]: r for r in train.groupBy("program_id").agg(F.count_if(y < 1).alias("below"), F.count(y).alias("n")).collect()}
    below = {p: counts[p]["below"] if p in counts else 0 for p in features}
    staged_fit = {p for p in features if below[p] >= min_below}
    voted = {p for p in staged_fit if below[p] < counts[p]["n"]}
    units = [replace(u, member="regressor", span=Span(below=u.program_id in staged_fit)) for u in final_units(features, cfg)]
    units += [replace(u, member="classifier", objective="logistic") for u in final_units({p: features[p] for p in voted}, cfg)]
    nodes = staged(grow(prepare(train, features, y.cast("double")), units).nodes(), "nodes")
    out = member_scores(test, nodes, "regressor", features).withColumnRenamed("regressor", "_reg")
    rest = out.where(~F.col("program_id").isin(sorted(voted))).withColumn("prob_below", F.lit(1.0))
    if voted:
        asked = member_scores(out.where(F.col("program_id").isin(sorted(voted))), nodes, "classifier", {p: features[p] for p in voted})
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("classifier")))
        out = asked.withColumn("prob_below", prob).drop("classifier").unionByName(rest)
    else:
        out = rest
    plain = sorted(set(features) - staged_fit)
    to_regressor = y < 1 if route == "label" else F.col("prob_below") > 0.5
    if plain:
        to_regressor = to_regressor | F.col("program_id").isin(plain)
    return out.withColumn("sl_pred", F.when(to_regressor, F.col("_reg")).otherwise(F.lit(1.0))).drop("_reg")


def last_fold(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Rows with role train/test: the last fold, or the tail split without folds or with too few rows for them."""
    k, share = cfg.model.folds, cfg.model.validation_share
    sizes = rows.groupBy("program_id").agg(F.count("*").alias("_size"))
    sized = rows.join(sizes, "program_id")
    folded = (F.col("_size") >= k * cfg.model.rows_per_fold) & F.lit(cfg.model.use_cv)
    many = time_folds(sized.where(folded), k).where(F.col("fold") == k - 1).drop("fold")
    few = head_tail_split(sized.where(~folded), share)
    few = few.withColumn("role", F.when(F.col("is_validation"), "test").otherwise("train")).drop("is_validation")
    return many.unionByName(few).drop("_size")


def final_span(cfg: EngineConfig) -> Span:
    """What the final model sees: all rows after cross-validation, the head of the tail split of programs too small for it."""
    m = cfg.model
    return Span(tail=m.validation_share, tail_below=m.folds * m.rows_per_fold if m.use_cv else float("inf"))


def evaluate_holdout(train: DataFrame, test: DataFrame, model: Trained, cfg: EngineConfig) -> DataFrame:
    """Metrics of model and plan per program on both sets; the residual target is rebuilt to service level."""
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")), allowMissingColumns=True
    )
    scored = predict(both, model, cfg)
    if cfg.target == "sl_residual":
        scored = metrics.residual_final(scored.withColumnRenamed("sl_pred", "residual_pred"), cfg.model.residual_limit)
    return metrics.metrics_by_program(scored, ["program_id", "part"])


def backtest(test: DataFrame, model: Trained, cfg: EngineConfig) -> DataFrame:
    """Test rows with their clipped prediction; summarise with metrics_by_program."""
    needed = sorted({f for fs in model.features.values() for f in fs} - set(test.columns))
    return predict(ensure_columns(test, needed), model, cfg).withColumn("sl_actual", clip("sl_actual"))


def trainable_programs(readiness: DataFrame) -> DataFrame:
    return readiness.where("status = 'trainable'").select("program_id")


def save_models(model: Trained, path: str) -> str:
    """Nodes and importances as tables under one folder."""
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    model.importances.write.mode("overwrite").parquet(f"{path}/importances")
    return path


def load_models(spark: SparkSession, path: str) -> Trained:
    """Feature order per program comes back from the importance table."""
    imp = spark.read.parquet(f"{path}/importances")
    feats = imp.groupBy("program_id").agg(F.sort_array(F.collect_list(F.struct("position", "feature"))).alias("f"))
    features = {r["program_id"]: [x["feature"] for x in r["f"]] for r in feats.collect()}
    return Trained(spark.read.parquet(f"{path}/nodes"), imp, features)
