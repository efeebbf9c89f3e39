"""The library's operators as queries over the driver's tables (Spark side)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import FeatureSpec, ForecastSpec, all_features
from .functions import columns as C
from .operators import baselines, billing, cleaning, encoding, features, hurdle, metrics, profile, splits
from .plans.forecast import forecast_graph
from .plans.quality import drop_failed, report, rules_for
from .sources import driver_tables as D
from .sources.tables import VALIDATION_SCHEMA, stored

KEYS = ["semaine", "code_agence", "code_article"]
THRESHOLD = 0.5


#: Prices of two decimals by powers of two end on a 5 at the seventh digit; this much takes them off the edge in either engine.
OFF_EDGE = {"fac_prix_unit": 1e-9}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(F.col(c) + OFF_EDGE.get(c, 0.0), digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))


def panel(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.panel_union(cleaning.clean_sales(D.known_sales(spark, d)), D.weeks_to_predict(spark, d))


def windowed(make: Callable[[], dict], spark: SparkSession, d: str) -> DataFrame:
    """Keys and one family of features over the whole panel."""
    made = make()
    return rounded(features.with_target(panel(spark, d)).withColumns(made).select(*KEYS, *made))


def group_expanding(column: str, prefix: str, spark: SparkSession, d: str) -> DataFrame:
    made = features.with_group_history(features.with_target(panel(spark, d)), {column: prefix})
    return rounded(made.select(*KEYS, f"{prefix}_mean", f"{prefix}_median"))


def graph(d: str):
    return forecast_graph(lambda s, name: D.raw_table(s, d, name), ForecastSpec(splits=D.SPLITS))


def gold(spark: SparkSession, d: str, name: str = "gold_feature_table") -> DataFrame:
    return rounded(graph(d).plan(spark, name))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Validation rows with a closed-form stand-in for the two stages, so that SQL can follow the gate."""
    rows = splits.validation_rows(features.with_target(panel(spark, d)).withColumns(features.zero_rate_columns() | features.rolling_columns(FeatureSpec(means=(13,)))), D.SPLITS)
    p, q = F.coalesce("zero_rate_52", F.lit(0.5)), F.coalesce("roll_mean_13", F.lit(0.0))
    known = rows.filter("quantite is not null").select(*KEYS, "quantite", "is_dead_pair", F.round(p, 6).alias("p_zero"), F.round(q, 6).alias("qty_pred"))
    return known.withColumn("prediction", hurdle.gate(F.col("p_zero"), F.col("qty_pred"), THRESHOLD))


def val_predictions(spark: SparkSession, d: str) -> DataFrame:
    """The stored form of scored validation rows, by the stand-in."""
    return scored(spark, d).select(*VALIDATION_SCHEMA.names)


def week_table(spark: SparkSession, d: str) -> DataFrame:
    weeks = D._read(spark, d, "lineitem", D.week_of(F.col("l_shipdate")).alias("semaine")).distinct()
    return C.add_time_columns(weeks)


def week_minus_years(spark: SparkSession, d: str) -> DataFrame:
    w = week_table(spark, d)
    return w.select("semaine", C.week_minus_years("semaine", 1).alias("minus_1"), C.week_minus_years("semaine", 2).alias("minus_2"), C.week_plus_years(F.col("annee"), F.col("num_sem")).alias("plus_1"))


def calendar_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(week_table(spark, d).withColumns(features.calendar_columns()).withColumn("month", C.month_of_week(F.col("num_sem"))).drop("week_id"))


def label_encoder_map(spark: SparkSession, d: str) -> DataFrame:
    items = D.articles(spark, d)
    mapping = encoding.collect_label_encoder(items, "specialite")  # six types
    return items.select("code_agence", "code_article", "specialite", encoding.apply_label_encoder("specialite", mapping).alias("code"), encoding.apply_label_encoder(F.concat("specialite", F.lit("?")), mapping).alias("unknown"))


def billing_joined(spark: SparkSession, d: str) -> DataFrame:
    rows = C.add_time_columns(D.dense_sales(spark, d))
    return rounded(billing.join_billing(rows, billing.billing_lagged(D.billing(spark, d))).select(*KEYS, "fac_prix_unit", "fac_pct_pro", "fac_nb_chantiers", "fac_nb_achats"))


def expectation_report(spark: SparkSession, d: str) -> DataFrame:
    return report(cleaning.clean_sales(D.known_sales(spark, d)), rules_for()["silver_ventes"])


def expect_drop(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a null key go: here every pair of group 3 has lost its group."""
    rows = D.known_sales(spark, d).withColumn("code_agence", F.when(F.col("code_agence") != 3, F.col("code_agence")))
    return drop_failed(C.add_time_columns(rows), rules_for()["silver_ventes"]).groupBy("code_agence").agg(F.count("*").alias("n"))


def group_means(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.expanding_means(features.with_target(panel(spark, d)), "code_agence", "agence_mean"))


def baseline_rows(spark: SparkSession, d: str) -> DataFrame:
    return rounded(baselines.baseline_predictions(cleaning.clean_sales(D.known_sales(spark, d)), D.SPLITS))


def baseline_wape(spark: SparkSession, d: str) -> DataFrame:
    return rounded(baselines.baseline_wape(cleaning.clean_sales(D.known_sales(spark, d)), D.SPLITS))


def wape_specialty(spark: SparkSession, d: str) -> DataFrame:
    items = D.articles(spark, d).select("code_agence", "code_article", "specialite")
    return rounded(metrics.wape_by(scored(spark, d).join(items, ["code_agence", "code_article"], "left"), "specialite"))


def impute(spark: SparkSession, d: str) -> DataFrame:
    made = features.lag_columns() | features.rolling_columns() | features.rolling_median_columns() | {"pair_mean": features.pair_columns()["pair_mean"]}
    rows = splits.test_rows(features.with_target(panel(spark, d)).withColumns(made), D.SPLITS)
    return rounded(hurdle.impute_short_horizon(rows).select(*KEYS, *made))


def hurdle_combine(spark: SparkSession, d: str) -> DataFrame:
    rows = scored(spark, d)
    return rows.select(*KEYS, hurdle.gate(F.col("p_zero"), F.col("qty_pred"), THRESHOLD).alias("gated"), C.nonneg_round(F.col("qty_pred")).alias("half_up"), C.nonneg_round_even(F.col("qty_pred")).alias("half_even"))


def final_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Weeks to predict, scored by the closed-form stand-in after imputation, gated and rounded."""
    made = features.zero_rate_columns() | features.rolling_columns(FeatureSpec(means=(13, 26)))
    rows = splits.test_rows(features.with_target(panel(spark, d)).withColumns(made), D.SPLITS)
    filled = hurdle.impute_short_horizon(rows).withColumns({"p_zero": F.round(F.coalesce("zero_rate_52", F.lit(0.5)), 6), "qty_pred": F.round(F.coalesce("roll_mean_13", F.lit(0.0)), 6)})
    return hurdle.final_predictions(filled, THRESHOLD)


def hurdle_gbt(spark: SparkSession, d: str, spec: hurdle.HurdleSpec = hurdle.HurdleSpec()) -> DataFrame:
    """Both stages trained on all features of the feature table, the threshold tuned on validation, weeks to predict scored."""
    # Boosting runs thousands of tasks; the feature table is computed once, and nothing of its plan stays in the driver meanwhile.
    rows = stored(graph(d).plan(spark, "gold_feature_table"), "features")
    known = rows.filter("quantite is not null")
    train, val = splits.train_rows(known, D.SPLITS), splits.validation_rows(known, D.SPLITS)
    model = hurdle.train_hurdle(train, val, all_features(), spec)
    best = metrics.best_threshold(metrics.threshold_sweep(model.score(val))).first()["threshold"]
    return hurdle.final_predictions(model.score(hurdle.impute_short_horizon(splits.test_rows(rows, D.SPLITS))), best)


def _clean(f: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: rounded(f(cleaning.clean_sales(D.known_sales(spark, d))))


def _sales(f: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: rounded(f(D.known_sales(spark, d)))


def _scored(f: Callable[[DataFrame], DataFrame]):
    return lambda spark, d: rounded(f(scored(spark, d)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "weekly_panel": D.dense_sales,
    "week_parse": week_table,
    "week_minus_years": week_minus_years,
    "calendar_features": calendar_features,
    "lags": partial(windowed, features.lag_columns),
    "rolling_mean_std": partial(windowed, features.rolling_columns),
    "rolling_median": partial(windowed, features.rolling_median_columns),
    "zero_rates": partial(windowed, features.zero_rate_columns),
    "trend_yoy": partial(windowed, features.trend_columns),
    "pair_expanding": partial(windowed, features.pair_columns),
    "seasonal_expanding": partial(windowed, features.seasonal_columns),
    "agency_expanding": partial(group_expanding, "code_agence", "agence"),
    "article_expanding": partial(group_expanding, "code_article", "article"),
    "agency_means": group_means,
    "clean_sales": _sales(cleaning.clean_sales),
    "dead_pairs": _sales(cleaning.pair_statistics),
    "panel_union": lambda s, d: rounded(panel(s, d)),
    "encode_articles": lambda s, d: encoding.encode_items(D.articles(s, d)),
    "encode_agencies": lambda s, d: encoding.encode_groups(D.agencies(s, d)),
    "label_encoder_map": label_encoder_map,
    "billing_lagged": lambda s, d: rounded(billing.billing_lagged(D.billing(s, d))),
    "billing_joined": billing_joined,
    "gold_features": gold,
    "gold_train": lambda s, d: gold(s, d, "gold_train"),
    "gold_validation": lambda s, d: gold(s, d, "gold_validation"),
    "gold_test": lambda s, d: gold(s, d, "gold_test_features"),
    "split_overlap": lambda s, d: (lambda t: splits.split_overlap(splits.train_rows(t, D.SPLITS), splits.validation_rows(t, D.SPLITS)))(C.add_time_columns(D.known_sales(s, d))),
    "expectation_report": expectation_report,
    "expect_drop": expect_drop,
    "baseline_predictions": baseline_rows,
    "baseline_wape": baseline_wape,
    "wape_by_agency": _scored(lambda v: metrics.wape_by(v, "code_agence")),
    "wape_by_slice": _scored(lambda v: metrics.wape_by_slices(v, ["code_agence", "semaine"])),
    "wape_by_specialty": wape_specialty,
    "wape_top_articles": _scored(metrics.wape_top_items),
    "wape_worst_agencies": _scored(lambda v: metrics.worst(metrics.wape_by(v, "code_agence"), "code_agence")),
    "wape_zero_split": _scored(metrics.wape_zero_split),
    "confusion_matrix": _scored(lambda v: metrics.confusion_matrix(v, THRESHOLD)),
    "threshold_sweep": _scored(metrics.threshold_sweep),
    "best_threshold": _scored(lambda v: metrics.best_threshold(metrics.threshold_sweep(v))),
    "logloss": _scored(metrics.log_loss),
    "zero_rate": _scored(metrics.zero_rate),
    "prediction_summary": _scored(metrics.prediction_summary),
    "val_predictions": val_predictions,
    "impute_short_horizon": impute,
    "hurdle_combine": hurdle_combine,
    "final_predictions": final_predictions,
    "hurdle_gbt": hurdle_gbt,
    "profile_nulls": lambda s, d: profile.profile_nulls(D.articles(s, d)),
    "profile_target": _sales(profile.profile_target),
    "profile_trend": _sales(profile.profile_trend),
    "profile_seasonality": _sales(profile.profile_seasonality),
    "top_weeks": _sales(profile.top_weeks),
    "profile_agency": _sales(profile.profile_groups),
    "profile_region": lambda s, d: profile.profile_region(D.known_sales(s, d), D.agencies(s, d)),
    "pareto_articles": _sales(profile.pareto_items),
    "profile_category": lambda s, d: rounded(profile.profile_category(D.known_sales(s, d), D.articles(s, d), "specialite")),
    "profile_family": lambda s, d: rounded(profile.profile_category(D.known_sales(s, d), D.articles(s, d), "famille")),
    "profile_brand": lambda s, d: rounded(profile.profile_category(D.known_sales(s, d), D.articles(s, d), "marque")),
    "share_mdd": lambda s, d: rounded(profile.profile_category(D.known_sales(s, d), D.articles(s, d), "article_mdd")),
    "coverage_antijoin": lambda s, d: profile.coverage(splits.train_rows(D.sparse_sales(s, d), D.SPLITS), D.weeks_to_predict(s, d)),
    "pair_distribution": _sales(profile.pair_distribution),
    "billing_stats": lambda s, d: rounded(profile.billing_stats(D.billing(s, d))),
    "lag_correlation": _sales(profile.lag_correlation),
}

#: The flagship: the whole feature table of the smallest data.
ENTRY_FOLDER = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return gold(spark, ENTRY_FOLDER)
