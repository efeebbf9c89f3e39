"""From the feature table to forecasts: train both stages, tune the gate, evaluate, store the model, score, write."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import all_features
from ..operators import hurdle, metrics, splits
from ..sources.runlog import RunLog
from ..sources.tables import VALIDATION_SCHEMA, scalar

EXPERIMENT, MODEL = "demand", "hurdle"


def evaluation(scored: DataFrame, threshold: float) -> dict[str, DataFrame]:
    """Reports on validation rows with ``p_zero``, ``qty_pred`` and ``prediction``, each of bounded size."""
    return {
        "wape_by_agency": metrics.wape_by(scored, "code_agence"),
        "worst_agencies": metrics.worst(metrics.wape_by(scored, "code_agence"), "code_agence"),
        "wape_top_articles": metrics.wape_top_items(scored),
        "wape_zero_split": metrics.wape_zero_split(scored),
        "confusion_matrix": metrics.confusion_matrix(scored, threshold),
        "logloss": metrics.log_loss(scored),
        "zero_rate": metrics.zero_rate(scored),
        "prediction_summary": metrics.prediction_summary(scored),
    }


def train(spark: SparkSession, path: str, log: RunLog, names: list[str] | None = None, spec: hurdle.HurdleSpec = hurdle.HurdleSpec()) -> str:
    """Trains on the splits materialised below ``path``, writes ``path/val_predictions`` and gives the run's id.

    The run holds the threshold and scores, the model's next version, and as artifacts the threshold sweep, the importance of
    features and the evaluation of the stored validation rows.
    """
    names = names or all_features()
    train_rows, val_rows = spark.read.parquet(f"{path}/gold_train"), spark.read.parquet(f"{path}/gold_validation")
    splits.assert_disjoint(train_rows, val_rows)
    model = hurdle.train_hurdle(train_rows, val_rows, names, spec)
    # Scored once: the sweep and all reports read the stored rows.
    keys = ["semaine", "code_agence", "code_article", "quantite"]
    model.score(val_rows).select(*keys, "p_zero", "qty_pred").write.mode("overwrite").parquet(f"{path}/_val_scores")
    scores = spark.read.parquet(f"{path}/_val_scores")
    sweep = metrics.threshold_sweep(scores)
    best = metrics.best_threshold(sweep).first()
    gated = scores.withColumn("prediction", hurdle.gate(F.col("p_zero"), F.col("qty_pred"), best["threshold"]))
    gated.select(*(F.col(f.name).cast(f.dataType) for f in VALIDATION_SCHEMA)).write.mode("overwrite").parquet(f"{path}/val_predictions")
    stored = spark.read.parquet(f"{path}/val_predictions")
    found = {"val_wape": hurdle.WapeEvaluator().evaluate(stored), "val_logloss": scalar(metrics.log_loss(stored))}
    params = {"best_zero_threshold": best["threshold"], "n_features": len(names), "train_rows": train_rows.count(), "val_rows": stored.count(), **asdict(spec)}
    artifacts = {"threshold_sweep": sweep, "importance": model.importance(spark), **evaluation(stored, best["threshold"])}
    return log.log(EXPERIMENT, "train", params, found, MODEL, save=model.save, artifacts=artifacts)


def predict(spark: SparkSession, path: str, log: RunLog) -> DataFrame:
    """Scores the weeks to predict by the newest model and threshold; writes and gives ``path/predictions_final``."""
    threshold = log.latest(EXPERIMENT, "train")["params"]["best_zero_threshold"]
    version = log.latest_version(MODEL)
    model = hurdle.load_model(log.model_path(MODEL, version))
    rows = hurdle.impute_short_horizon(spark.read.parquet(f"{path}/gold_test_features"))
    hurdle.final_predictions(model.score(rows), threshold).write.mode("overwrite").parquet(f"{path}/predictions_final")
    final = spark.read.parquet(f"{path}/predictions_final")
    summary = metrics.prediction_summary(final).first()
    log.log(EXPERIMENT, "inference", {"zero_threshold": threshold, "model_version": version}, {"n_test_rows": summary["n"], "n_positive_preds": summary["n_positive"], "mean_pred": summary["mean_prediction"]})
    return final


def run(spark: SparkSession, graph, path: str, log: RunLog, names: list[str] | None = None, spec: hurdle.HurdleSpec = hurdle.HurdleSpec()) -> DataFrame:
    """Materialises ``graph`` (:func:`.forecast.forecast_graph`) below ``path``, trains and predicts."""
    graph.materialize(spark, path)
    train(spark, path, log, names, spec)
    return predict(spark, path, log)
