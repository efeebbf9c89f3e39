"""Forecast baselines: the same calendar week a year before, the pair's mean, and their blend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EvaluationSpec, PanelSpec, SplitSpec
from ..functions.columns import week_plus_years
from . import metrics
from .windows import PANEL


def before_validation(cleaned: DataFrame, s: SplitSpec) -> DataFrame:
    """Training rows by the integer week."""
    return cleaned.filter(F.col("week_id") < int(s.val_start.replace("-", "")))


def pair_means(train: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    return train.groupBy(*p.keys).agg(F.avg(p.target).alias("pair_mean_train"))


def calendar_lag(train: DataFrame, years: int = 1, p: PanelSpec = PANEL) -> DataFrame:
    """Quantities keyed by the same week number ``years`` later: an exact calendar lag, unlike a row lag."""
    return train.select(week_plus_years(F.col("annee"), F.col("num_sem"), years).alias(p.week), *p.keys, F.col(p.target).alias("lag52_pred"))


def baseline_predictions(cleaned: DataFrame, s: SplitSpec = SplitSpec(), e: EvaluationSpec = EvaluationSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """Validation rows with ``lag52_pred``, ``pair_mean_train`` and ``blend_pred``; what is unknown counts as 0."""
    train = before_validation(cleaned, s)
    rows = cleaned.filter(F.col(p.week).between(s.val_start, s.val_end) & F.col(p.target).isNotNull()).select(p.week, *p.keys, p.target)
    joined = rows.join(calendar_lag(train, 1, p), [p.week, *p.keys], "left").join(pair_means(train, p), p.keys, "left")
    filled = joined.withColumns({"lag52_pred": F.coalesce(F.col("lag52_pred").cast("double"), F.lit(0.0)), "pair_mean_train": F.coalesce("pair_mean_train", F.lit(0.0))})
    return filled.withColumn("blend_pred", F.col("lag52_pred") * e.blend[0] + F.col("pair_mean_train") * e.blend[1])


def wape_summary(predicted: DataFrame, columns: dict[str, str], y: str = "quantite") -> DataFrame:
    """(model, wape) of several prediction columns in one pass, best first."""
    cells = predicted.agg(*(metrics.wape(F.col(y), F.col(c)).alias(m) for m, c in columns.items()))
    rows = F.array(*(F.struct(F.lit(m).alias("model"), F.col(m).alias("wape")) for m in columns))
    return cells.select(F.inline(rows)).orderBy("wape", "model")


BASELINES = {"naive_lag52": "lag52_pred", "pair_mean": "pair_mean_train", "blend_seasonal": "blend_pred"}


def baseline_wape(cleaned: DataFrame, s: SplitSpec = SplitSpec()) -> DataFrame:
    return wape_summary(baseline_predictions(cleaned, s), BASELINES)
