"""Parameters of the analysis; every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Defaults of the published analysis; override per dataset."""

    seed: int = 42
    churn_days: int = 180
    k_final: int = 4
    k_range: tuple[int, ...] = (2, 3, 4, 5, 6)
    quantiles: tuple[float, ...] = (0.25, 0.5, 0.75, 0.95)
    pareto_points: tuple[int, ...] = (1, 5, 10, 20, 50)
    min_state_mature: int = 500
    min_category_mature: int = 300
    min_test_group: int = 100
    freight_cap: float = 2.0
    repeat_frequency: float = 1.5
    lost_recency: float = 300.0
    recent_recency: float = 150.0
    train_share: float = 0.8
    logistic_rounds: int = 100
    forest_trees: int = 100
    forest_depth: int = 8
    boosted_rounds: int = 50
    boosted_depth_churn: int = 5
    boosted_depth_repeat: int = 4
    uplift_points: tuple[float, ...] = (0.005, 0.01, 0.02)
    uplift_spend: tuple[float, ...] = (0.05, 0.10, 0.20)
    money_tolerance: float = 0.5
    source_gap: float = 0.02
