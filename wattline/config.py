"""Settings records.

The defaults are the published ones, with two exceptions: features stay doubles
(``narrow_floats`` makes them floats), and boosting has at most 100 rounds of
MLlib trees instead of 1,000 of another library.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CleaningSettings:
    # The published quantile, outage length and unit conversion.
    cap_quantile: float = 0.999
    min_zero_streak: int = 48
    converted_site: int = 0
    converted_meter: int = 0
    conversion_factor: float = 0.293071


@dataclass(frozen=True)
class FeatureSettings:
    lags: tuple[int, ...] = (24, 168)
    windows: tuple[int, ...] = (24, 168)
    narrow_floats: bool = False


@dataclass(frozen=True)
class BoosterSettings:
    """MLlib counterparts of 63 leaves, rate .05, 80 % rows and features, 20 rows per leaf, and a patience of 50 rounds."""

    max_depth: int = 6
    step_size: float = 0.05
    rounds: int = 100
    patience: int = 50
    forest_trees: int = 20
    row_fraction: float = 0.8
    feature_fraction: float = 0.8
    min_rows_per_leaf: int = 20
    stopping_fraction: float = 0.1
    seed: int = 42


@dataclass(frozen=True)
class AnomalySettings:
    threshold: float = 3.5
    min_rows: int = 10
    fallback: str = "median"


@dataclass(frozen=True)
class AuditSettings:
    # The published minimum and weights.
    min_hours: int = 100
    weights: dict[str, float] = field(
        default_factory=lambda: {
            "anomaly_rate": 0.3,
            "max_anomaly_score": 0.25,
            "excess_per_sqft": 0.25,
            "streak_severity": 0.2,
        }
    )


@dataclass(frozen=True)
class Settings:
    holdout: str = "INTERVAL 3 MONTHS"
    cleaning: CleaningSettings = field(default_factory=CleaningSettings)
    features: FeatureSettings = field(default_factory=FeatureSettings)
    booster: BoosterSettings = field(default_factory=BoosterSettings)
    anomaly: AnomalySettings = field(default_factory=AnomalySettings)
    audit: AuditSettings = field(default_factory=AuditSettings)
