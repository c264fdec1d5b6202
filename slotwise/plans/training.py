"""Training run: features, split, fit, drift, hold-out metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.config import EngineConfig
from slotwise.functions.numbers import clip
from slotwise.models import boosting
from slotwise.models import training as tr
from slotwise.operators import cleaning, encoding, metrics, splits, windows
from slotwise.operators.columns import MAP_PROGRAMS
from slotwise.operators.reports import union_programs
from slotwise.plans.history import feature_table
from slotwise.sources.stages import stage_sink, staged
from slotwise.sources.stores import save_encoding


@dataclass(frozen=True)
class TrainingRun:
    model: tr.Trained
    encoding: DataFrame
    readiness: DataFrame
    summary: DataFrame
    metrics: DataFrame  # (program_id, metric, value)
    train: DataFrame
    test: DataFrame
    future: DataFrame

    def save(self, path: str) -> str:
        """Models, encoding, metrics and readiness as tables under one folder."""
        tr.save_models(self.model, path)
        save_encoding(self.encoding, f"{path}/encoding")
        stage_sink(self.metrics, f"{path}/metrics")
        stage_sink(self.readiness, f"{path}/readiness")
        return path


def long_metrics(df: DataFrame, suffix: str | Column = "") -> DataFrame:
    """Wide metric columns -> (program_id, metric, value) rows."""
    names = [c for c in df.columns if c not in ("program_id", "part")]
    pairs = F.array(
        *[
            F.struct(F.concat(F.lit(n), F.lit(suffix) if isinstance(suffix, str) else suffix).alias("metric"),
                     F.col(n).cast("double").alias("value"))
            for n in names
        ]
    )
    return df.select("program_id", F.inline(pairs))


def training_run(
    history: DataFrame, programs: DataFrame, cfg: EngineConfig, exclusions=None, cross_validate: bool | None = None,
    tune: bool | None = None, tree_range: tuple[int, int] | None = None,
) -> TrainingRun:
    """Eager: writes the feature stage and fits one model per trainable program.

    The encoding is fitted before the split, as the reference results require. Search, cross-validation and ensemble follow
    the configuration. The final models and the folds grow in one run. With an ensemble, its members are fitted on the rows
    before the last fold and give the test metrics.
    """
    tune = cfg.model.optimize if tune is None else tune
    cross_validate = cfg.model.use_cv if cross_validate is None else cross_validate
    cfg = cfg.with_mode("training")
    many = len(cfg.programs) > MAP_PROGRAMS
    window = windows.program_filter(history.where(windows.config_window("ref_date", cfg)), cfg.programs, cfg.channel)
    feats = staged(feature_table(cleaning.clean(window, cfg), cfg), "features", "program_id")
    flagged = splits.future_split(feats, cfg.as_of)
    future = flagged.where("is_future").drop("is_future")
    past = splits.date_split(flagged.where("NOT is_future").drop("is_future"), cfg.test_share)
    train = windows.recent_window(past.where("NOT is_test"), days=cfg.model.window_days, per_program=True, many=many)
    train, test = train.drop("is_test"), past.where("is_test").drop("is_test")
    train = staged(train, "train", "program_id")
    readiness = metrics.training_readiness(train, programs, cfg.model.min_operational)
    features = tr.features_of(tr.trainable_programs(readiness), cfg, exclusions)
    parts, tuned, grown = [], None, None
    if features:
        ready = boosting.prepare(train, features, tr.label(cfg))
        least = cfg.model.folds * cfg.model.rows_per_fold
        folded = {p: f for p, f in features.items() if ready.sizes.get(p, 0) >= least}
        if tune and folded:
            tuned = tr.best_params(tr.param_search(train, folded, cfg, None, tree_range, ready), cfg.model)
        folded = folded if cross_validate else {}
        units = tr.final_units(features, cfg, tuned, tr.final_span(cfg)) + tr.fold_units(folded, cfg, cfg.model.folds, tuned)
        grown = boosting.grow(ready, units, keep=lambda u: u.span.fold < 0)
        if folded:
            parts.append(long_metrics(metrics.cv_summary(tr.fold_metrics(grown, cfg).drop("trial"))))
    model = tr.trained(grown, features, history.sparkSession)
    if features:
        folds = staged(tr.last_fold(train, cfg), "last_fold", "program_id")
        drift = metrics.psi_drift(folds, "role", cfg.target, 10, cfg.model.drift_threshold, many=many)
        drift = drift.where(F.col("n_actual") >= cfg.model.min_drift_rows)
        parts.append(long_metrics(drift.select("program_id", "psi", (F.col("drift") == "DRIFT").cast("int").alias("has_drift"))))
        seen = folds.where("role = 'train'").drop("role", "row_num", "n_rows")
        holdout = tr.evaluate_holdout(seen, with_service(test), model, cfg)
        if cfg.model.use_ensemble:
            together = clipped_ensemble(seen, with_service(test), features, cfg)
            own = metrics.metrics_by_program(together.withColumn("part", F.lit("test")), ["program_id", "part"])
            holdout = holdout.where("part = 'train'").unionByName(own)
        parts.append(long_metrics(holdout, F.concat(F.lit("_"), "part")))
        scored = tr.predict(folds.where("role = 'test'").drop("row_num", "n_rows"), model, cfg)
        if cfg.target == "sl_residual":
            scored = metrics.residual_final(
                scored.withColumnRenamed("sl_pred", "residual_pred"), cfg.model.residual_limit)
        parts.append(long_metrics(metrics.metrics_by_program(scored, ["program_id"]), "_in_sample_last_fold"))
    rows = union_programs(parts) if parts else history.sparkSession.createDataFrame(
        [], "program_id int, metric string, value double")
    return TrainingRun(
        model, encoding.target_encoding_fit(feats), readiness, metrics.training_summary(readiness), rows, train, test,
        future,
    )


def clipped_ensemble(train: DataFrame, test: DataFrame, features, cfg: EngineConfig) -> DataFrame:
    """Ensemble predictions as service levels: rebuilt from the residual, or clipped to [0, 1]."""
    out = tr.ensemble(train, test, features, cfg)
    if cfg.target == "sl_residual":
        return metrics.residual_final(out.withColumnRenamed("sl_pred", "residual_pred"), cfg.model.residual_limit)
    return out.withColumn("sl_pred", clip("sl_pred"))


def with_service(test: DataFrame) -> DataFrame:
    """Test rows of programs that had any service level above 0 in the test dates."""
    served = test.where("sl_actual > 0").select("program_id").distinct()
    return test.join(served, "program_id", "left_semi")
