"""Forecast metrics as aggregates: one pass, a row or a row for each slice."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EvaluationSpec

SPEC = EvaluationSpec()


def wape(y: Column, predicted: Column, where: Column | None = None, s: EvaluationSpec = SPEC) -> Column:
    """Aggregate: sum |y - predicted| / (sum |y| + epsilon)."""
    y, predicted = y.cast("double"), predicted.cast("double")
    keep = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    return F.sum(keep(F.abs(y - predicted))) / (F.sum(keep(F.abs(y))) + s.wape_epsilon)


def wape_spark(df: DataFrame, y: str = "quantite", predicted: str = "prediction") -> float:
    """WAPE as a number; null predictions are left out of the numerator only."""
    found = df.agg(wape(F.col(y), F.col(predicted)).alias("w")).first()["w"]
    return float("nan") if found is None else float(found)


def wape_numpy(y, predicted, s: EvaluationSpec = SPEC) -> float:
    y, predicted = np.asarray(y, float), np.asarray(predicted, float)
    return float(np.abs(y - predicted).sum() / (np.abs(y).sum() + s.wape_epsilon))


def wape_feval(predicted, y) -> tuple[str, float, bool]:
    """(name, value, higher is better), as boosting libraries call a metric of their own."""
    return "wape", wape_numpy(y, predicted), False


def wape_by(df: DataFrame, key: str, y: str = "quantite", predicted: str = "prediction") -> DataFrame:
    """(key, wape, n, sum_actual), worst first."""
    return df.groupBy(key).agg(wape(F.col(y), F.col(predicted)).alias("wape"), F.count("*").alias("n"), F.sum(F.col(y).cast("double")).alias("sum_actual")).orderBy(F.desc("wape"), key)


def wape_by_slices(df: DataFrame, keys: list[str], y: str = "quantite", predicted: str = "prediction") -> DataFrame:
    """(slice, value, wape, n, sum_actual) of several keys in one pass, by grouping sets."""
    sets = [[k] for k in keys]
    grouped = df.groupingSets(sets, *keys).agg(wape(F.col(y), F.col(predicted)).alias("wape"), F.count("*").alias("n"), F.sum(F.col(y).cast("double")).alias("sum_actual"), *(F.grouping(k).alias(f"_{k}") for k in keys))
    kind = F.coalesce(*(F.when(F.col(f"_{k}") == 0, F.lit(k)) for k in keys))
    value = F.coalesce(*(F.when(F.col(f"_{k}") == 0, F.col(k).cast("string")) for k in keys))
    return grouped.select(kind.alias("slice"), value.alias("value"), "wape", "n", "sum_actual")


def top_items(df: DataFrame, item: str = "code_article", y: str = "quantite", k: int = SPEC.top_items) -> DataFrame:
    return df.groupBy(item).agg(F.sum(y).alias("_volume")).orderBy(F.desc("_volume"), item).limit(k).select(item)


def wape_top_items(df: DataFrame, item: str = "code_article", y: str = "quantite", predicted: str = "prediction", k: int = SPEC.top_items) -> DataFrame:
    best = top_items(df, item, y, k)  # k rows
    return wape_by(df.join(F.broadcast(best), item, "left_semi"), item, y, predicted)


def wape_zero_split(df: DataFrame, y: str = "quantite", predicted: str = "prediction") -> DataFrame:
    """WAPE of the rows at zero and of those above."""
    c, p = F.col(y), F.col(predicted)
    return df.agg(wape(c, p, c == 0).alias("wape_zero"), wape(c, p, c > 0).alias("wape_nonzero"), F.count_if(c == 0).alias("n_zero"), F.count_if(c > 0).alias("n_nonzero"))


def confusion_matrix(df: DataFrame, threshold: float, y: str = "quantite", p_zero: str = "p_zero", s: EvaluationSpec = SPEC) -> DataFrame:
    """tp, tn, fp, fn of "is zero" called where p_zero > threshold; precision and recall."""
    truth, called = F.col(y) == 0, F.col(p_zero) > threshold
    counts = df.agg(*(F.count_if(c).alias(n) for n, c in (("tp", truth & called), ("tn", ~truth & ~called), ("fp", ~truth & called), ("fn", truth & ~called))))
    return counts.withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp") + s.ratio_epsilon), "recall": F.col("tp") / (F.col("tp") + F.col("fn") + s.ratio_epsilon)})


def threshold_sweep(df: DataFrame, y: str = "quantite", p_zero: str = "p_zero", quantity: str = "qty_pred", s: EvaluationSpec = SPEC) -> DataFrame:
    """(threshold, wape) for each threshold of the grid: conditional sums of one pass."""
    gated = lambda t: F.when(F.col(p_zero) > t, 0.0).otherwise(F.greatest(F.col(quantity), F.lit(0.0)))
    cells = df.agg(*(wape(F.col(y), gated(t), s=s).alias(f"w{k}") for k, t in enumerate(s.thresholds)))
    rows = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"w{k}").alias("wape")) for k, t in enumerate(s.thresholds)))
    return cells.select(F.inline(rows))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The first of the thresholds with the lowest WAPE."""
    return sweep.orderBy("wape", "threshold").limit(1)


def log_loss(df: DataFrame, y: str = "quantite", p_zero: str = "p_zero", s: EvaluationSpec = SPEC) -> DataFrame:
    p = F.least(F.greatest(F.col(p_zero), F.lit(s.log_clip)), F.lit(1 - s.log_clip))
    return df.agg(F.avg(-F.when(F.col(y) == 0, F.ln(p)).otherwise(F.ln(1 - p))).alias("logloss"))


def zero_rate(df: DataFrame, y: str = "quantite") -> DataFrame:
    return df.agg(F.avg((F.col(y) == 0).cast("double")).alias("zero_rate"))


def prediction_summary(df: DataFrame, predicted: str = "prediction") -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(predicted) > 0).alias("n_positive"), F.avg(predicted).alias("mean_prediction"))


def worst(df: DataFrame, key: str, k: int = SPEC.worst_groups) -> DataFrame:
    return df.orderBy(F.desc("wape"), key).limit(k)
