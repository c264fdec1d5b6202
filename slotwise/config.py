"""Explicit configuration, passed by argument; nothing is rewritten on disk."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

from slotwise import catalog


@dataclass(frozen=True)
class ModelConfig:
    trees: int = 200
    depth: int = 4
    step: float = 0.05
    subsample: float = 0.75
    feature_fraction: str = "0.7"
    min_instances: int = 10
    l1: float = 15.0
    l2: float = 20.0
    seed: int = 42
    target_transform: bool = True
    use_cv: bool = True
    optimize: bool = True
    use_ensemble: bool = False
    ensemble_members: tuple[str, ...] = ("boosted", "forest", "ridge")
    folds: int = 5
    rows_per_fold: int = 10  # programs with fewer rows than folds * rows_per_fold get a tail split
    validation_share: float = 0.2
    min_drift_rows: int = 11
    search_trials: int = 20
    search_folds: int = 3
    window_days: int = 90
    min_operational: int = 50
    drift_threshold: float = 0.15
    residual_limit: float = 0.15
    ensemble_weights: tuple[float, ...] = (0.5, 0.3, 0.2)


@dataclass(frozen=True)
class EngineConfig:
    as_of: dt.datetime
    programs: tuple[int, ...]
    channel: int = 7
    mode: str = "inference"
    target: str = "sl_actual"
    window_days: int = 90
    inference_window_days: int = 30
    future_days: int = 7
    cutoff: str | None = None  # dd/mm/yyyy, training only
    test_share: float = 0.2
    operational_filter: bool = True
    min_volume: int = 1
    features: tuple[str, ...] = tuple(catalog.FEATURES)
    plan_sla_scale: float = 1.0
    model: ModelConfig = field(default_factory=ModelConfig)

    def with_mode(self, mode: str) -> "EngineConfig":
        return replace(self, mode=mode)

    @property
    def today(self) -> dt.date:
        return self.as_of.date()
