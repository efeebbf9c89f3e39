"""Column names, knobs and split bounds of a weekly panel."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PanelSpec:
    group: str = "code_agence"
    item: str = "code_article"
    week: str = "semaine"
    target: str = "quantite"

    @property
    def keys(self) -> list[str]:
        return [self.group, self.item]


@dataclass(frozen=True)
class CleaningSpec:
    """``accuracy`` is percentile_approx's; at a million, percentiles are exact up to about as many rows of a group."""

    percentile: float = 0.995
    median_multiple: float = 2.0
    anomaly_multiple: float = 10.0
    anomaly_window: int = 26
    smooth_window: int = 13
    accuracy: int = 1_000_000
    min_quantity: int = 0
    max_quantity: int = 25_000
    first_year: int = 2020
    last_year: int = 2026


@dataclass(frozen=True)
class FeatureSpec:
    """``group_frame``: ``range`` looks at earlier weeks only; ``rows`` also at rows of the same week that happen to come first."""

    lags: tuple[int, ...] = (1, 2, 4, 8, 13, 26, 52, 104)
    means: tuple[int, ...] = (4, 8, 13, 26, 52)
    medians: tuple[int, ...] = (4, 13)
    zero_rates: tuple[int, ...] = (26, 52)
    recent: int = 4
    trend_clamp: float = 5.0
    trend_offset: float = 1.0
    cv_epsilon: float = 1e-6
    group_frame: str = "range"
    accuracy: int = 1_000_000


@dataclass(frozen=True)
class SplitSpec:
    """Bounds as ``YYYY-WW``; training ends before the first week of validation."""

    val_start: str = "2025-01"
    val_end: str = "2025-26"
    test_start: str = "2025-27"
    test_end: str = "2025-52"


@dataclass(frozen=True)
class EvaluationSpec:
    wape_epsilon: float = 1e-10
    ratio_epsilon: float = 1e-9
    log_clip: float = 1e-7
    blend: tuple[float, float] = (0.6, 0.4)
    thresholds: tuple[float, ...] = (0.30, 0.40, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90)
    top_items: int = 20
    worst_groups: int = 5


BILLING_SHIFT_MONTHS = 2
WEEKS_PER_MONTH, WEEKS_PER_YEAR = 4.333, 52.0
SEED = 42

ITEM_CODES = {"specialite": "art_specialite_enc", "famille": "art_famille_enc", "marque": "art_marque_enc", "article_mdd": "art_mdd_enc"}
GROUP_CODE = "ag_region_enc"
BILLING_COLUMNS = ("fac_prix_unit", "fac_pct_pro", "fac_nb_chantiers", "fac_nb_achats")
#: Names of features, in model order.
HISTORY_FEATURES = (
    "pair_zero_rate_expanding", "trend_8", "ratio_n1_vs_mean", "yoy_ratio", "pair_mean", "pair_median", "pair_max", "pair_count", "pair_cv",
    "sem_mean", "sem_max", "sem_median", "agence_mean", "agence_median", "article_mean", "article_median", "n_active_weeks",
)
CALENDAR_FEATURES = ("annee", "num_sem", "sin_sem", "cos_sem", "is_summer_trough", "is_xmas_trough")
BASE_COLUMNS = ("semaine", "week_id", "code_agence", "code_article", "quantite", "quantite_raw", "quantite_smooth", "is_anomaly", "is_capped", "is_dead_pair")


def numeric_features(spec: FeatureSpec = FeatureSpec()) -> list[str]:
    """Names of the numeric model features, in model order."""
    return [
        *(f"lag_{n}" for n in spec.lags),
        *(f"roll_mean_{n}" for n in spec.means),
        *(f"roll_std_{n}" for n in spec.means),
        *(f"roll_median_{n}" for n in spec.medians),
        *(f"zero_rate_{n}" for n in spec.zero_rates),
        *HISTORY_FEATURES,
        *BILLING_COLUMNS,
        *CALENDAR_FEATURES,
    ]


def all_features(spec: FeatureSpec = FeatureSpec()) -> list[str]:
    return [*numeric_features(spec), *ITEM_CODES.values(), GROUP_CODE]


@dataclass(frozen=True)
class ForecastSpec:
    panel: PanelSpec = field(default_factory=PanelSpec)
    cleaning: CleaningSpec = field(default_factory=CleaningSpec)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    splits: SplitSpec = field(default_factory=SplitSpec)
    evaluation: EvaluationSpec = field(default_factory=EvaluationSpec)
