"""The exact-semantics rules on small hand-made panels."""

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loomcast.config import CleaningSpec, FeatureSpec, SplitSpec
from loomcast.functions import columns as C
from loomcast.operators import baselines, billing, cleaning, encoding, features, hurdle, metrics, splits


def panel(spark, rows):
    """rows: (semaine, agence, article, quantite)."""
    df = spark.createDataFrame(rows, "semaine string, code_agence long, code_article long, quantite long")
    return features.with_target(C.add_time_columns(df))


def one(df, name, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    return df.first()[name]


def test_lags_count_rows_and_baselines_count_weeks(spark):
    rows = [("2023-50", 1, 1, 1), ("2023-52", 1, 1, 2), ("2024-01", 1, 1, 3), ("2024-52", 1, 1, 4)]
    df = panel(spark, rows).withColumns(features.lag_columns(FeatureSpec(lags=(1,))))
    assert one(df, "lag_1", semaine="2024-52") == 3.0
    lag = baselines.calendar_lag(df)
    assert one(lag, "lag52_pred", semaine="2024-52") == 2


def test_empty_history(spark):
    df = panel(spark, [("2024-01", 1, 1, 5)]).withColumns(features.pair_columns())
    row = df.first()
    assert row["pair_mean"] is None and row["pair_max"] is None and row["n_active_weeks"] is None and row["pair_count"] == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_group_windows_dont_see_their_own_week_or_row_order(spark, seed):
    rows = [(f"2024-{w:02d}", 1, a, w * a) for w in range(1, 5) for a in (1, 2, 3)]
    made = features.expanding_columns("code_agence", "agence")
    want = {}
    for w in range(1, 5):
        past = [q for s, _, _, q in rows if int(s[5:]) < w]
        want[f"2024-{w:02d}"] = sum(past) / len(past) if past else None
    got = panel(spark, rows).orderBy(F.rand(seed)).withColumns(made).collect()
    assert {(r["semaine"], r["agence_mean"]) for r in got} == set(want.items())
    means = features.expanding_means(panel(spark, rows), "code_agence", "m").collect()
    assert {r["week_id"]: r["m"] for r in means} == {202400 + int(k[5:]): v for k, v in want.items()}


def test_group_history_from_counts_equals_plain_means_and_medians(spark):
    import random

    rnd = random.Random(4)
    rows = [(f"2024-{w:02d}", g, a, rnd.choice([None, 0, 0, 1, 2, 3, 7])) for w in range(1, 9) for g in (1, 2) for a in (1, 2, 3) if rnd.random() < 0.8]
    got = features.with_group_history(panel(spark, rows), {"code_agence": "agence", "code_article": "article"}).collect()
    assert len(got) == len(rows)
    for r in got:
        for column, prefix, at in (("code_agence", "agence", 1), ("code_article", "article", 2)):
            past = sorted(float(x[3]) for x in rows if x[at] == r[column] and x[0] < r["semaine"] and x[3] is not None)
            mean, median = (sum(past) / len(past), past[(len(past) + 1) // 2 - 1]) if past else (None, None)
            assert r[f"{prefix}_mean"] == (None if mean is None else pytest.approx(mean)) and r[f"{prefix}_median"] == median


def test_row_frames_see_earlier_pairs_of_the_same_week(spark):
    rows = [("2024-01", 1, 1, 10), ("2024-01", 1, 2, 20)]
    df = panel(spark, rows).withColumns(features.expanding_columns("code_agence", "agence", FeatureSpec(group_frame="rows")))
    assert one(df, "agence_mean", code_article=2) == 10.0


def test_trend_with_unknown_recent_weeks(spark):
    rows = [(f"2024-{w:02d}", 1, 1, 5) for w in range(1, 5)] + [(f"2024-{w:02d}", 1, 1, None) for w in range(5, 10)]
    df = panel(spark, rows).withColumns(features.trend_columns())
    assert one(df, "trend_8", semaine="2024-09") == -5.0
    assert one(df, "trend_8", semaine="2024-04") is None


def test_trend_of_negative_quantities_does_not_divide_by_zero(spark):
    rows = [(f"2024-{w:02d}", 1, 1, -1) for w in range(1, 5)] + [(f"2024-{w:02d}", 1, 1, 2) for w in range(5, 10)]
    assert one(panel(spark, rows).withColumns(features.trend_columns()), "trend_8", semaine="2024-09") == -5.0


def test_unknown_target_counts_as_sold_in_zero_rates(spark):
    df = panel(spark, [("2024-01", 1, 1, None), ("2024-02", 1, 1, 0), ("2024-03", 1, 1, 1)]).withColumns(features.zero_rate_columns())
    assert one(df, "pair_zero_rate_expanding", semaine="2024-03") == 0.5


def test_codes_of_null_categories(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("a",)], "c string")
    got = {(r["c"], r["k"]) for r in encoding.encode_column(df, "c", "k").collect()}
    assert got == {("a", 1), ("b", 2), (None, None)}
    assert encoding.collect_label_encoder(df, "c") == {"a": 0, "b": 1}
    applied = df.select("c", encoding.apply_label_encoder("c", {"a": 0}).alias("k"), encoding.apply_label_encoder("c", {}).alias("none"))
    assert {tuple(r) for r in applied.collect()} == {("a", 0, -1), ("b", -1, -1), (None, -1, -1)}
    assert encoding.encode_column(df, "missing", "k").first()["k"] == -1


def test_cleaning_caps_imputes_and_truncates(spark):
    rows = [(f"{2023 + w // 50}-{w % 50 + 1:02d}", 1, 1, 3 if w % 2 else 2) for w in range(60)]
    rows[40] = (rows[40][0], 1, 1, 500)
    df = cleaning.clean_sales(spark.createDataFrame(rows, "semaine string, code_agence long, code_article long, quantite long"))
    row = df.filter(F.col("semaine") == rows[40][0]).first()
    assert row["quantite_raw"] == 500 and row["is_anomaly"] == 1 and row["quantite"] == 2
    assert df.first()["is_dead_pair"] == 0 and df.agg(F.sum("is_capped")).first()[0] == 0
    low = CleaningSpec(percentile=0.5)
    capped = cleaning.clean_sales(spark.createDataFrame(rows, "semaine string, code_agence long, code_article long, quantite long"), low)
    assert one(capped, "is_capped", semaine=rows[40][0]) == 1


def test_dead_pairs_reach_weeks_to_predict(spark):
    sales = spark.createDataFrame([(f"2024-{w:02d}", 1, 1, 0) for w in range(1, 31)], "semaine string, code_agence long, code_article long, quantite long")
    future = spark.createDataFrame([("2024-31", 1, 1), ("2024-32", 2, 2)], "semaine string, code_agence long, code_article long")
    df = cleaning.panel_union(cleaning.clean_sales(sales), future)
    assert {(r["semaine"], r["is_dead_pair"]) for r in df.filter("quantite is null").collect()} == {("2024-31", 1), ("2024-32", 0)}
    assert cleaning.pair_statistics(sales).first()["is_dead_pair"] == 1


def test_bad_weeks_are_null_not_errors(spark):
    df = C.add_time_columns(spark.createDataFrame([("2024",), ("x1-02",), (None,), ("2024-53",), ("",)], "semaine string"))
    assert [(r["annee"], r["num_sem"], r["week_id"]) for r in df.collect()] == [(2024, None, None), (None, 2, None), (None, None, None), (2024, 53, 202453), (None, None, None)]
    assert df.filter("semaine = '2024-53'").select(C.week_minus_years("semaine", 2)).first()[0] == "2022-53"


def test_months(spark):
    df = spark.createDataFrame([(1,), (4,), (5,), (26,), (27,), (52,), (53,), (None,)], "w int")
    assert [r[0] for r in df.select(C.month_of_week(F.col("w"))).collect()] == [1, 1, 2, 7, 7, 12, 12, 1]
    moved = spark.createDataFrame([(2024, 11), (2024, 12), (2024, 1), (2024, 10)], "y int, m int").select(*C.shifted_month(F.col("y"), F.col("m")))
    assert [tuple(r) for r in moved.collect()] == [(2025, 1), (2025, 2), (2024, 3), (2024, 12)]


def test_billing_guards_and_names(spark):
    rows = [(1, 1, 2024, 11, 10.0, 0.0, 4), (1, 1, 2024, 12, 10.0, None, 0), (1, 1, 2024, 12, 6.0, 4.0, 0)]
    df = spark.createDataFrame(rows, "code_agence long, code_article long, year int, month int, sum_montant double, sum_quantite double, nb_achats long")
    got = {(r["_join_annee"], r["_join_mois"]): (r["fac_prix_unit"], r["fac_pct_pro"], r["fac_nb_chantiers"]) for r in billing.billing_lagged(df).collect()}
    assert got == {(2025, 1): (None, 0.0, 0.0), (2025, 2): (4.0, None, 0.0)}


def test_rounding_and_gate(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.2,), (None,)], "x double")
    assert [tuple(r) for r in df.select(C.nonneg_round(F.col("x")), C.nonneg_round_even(F.col("x"))).collect()] == [(1, 0), (2, 2), (3, 2), (0, 0), (0, 0)]
    rows = spark.createDataFrame([(0.6, 5.0, 0), (0.4, 2.5, 0), (0.4, -3.0, 0), (0.1, 9.0, 1)], "p double, q double, d int")
    assert [r[0] for r in rows.select(hurdle.final_prediction(F.col("p"), F.col("q"), F.col("d"), 0.5)).collect()] == [0, 2, 0, 0]


def test_wape_edges(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "quantite long, prediction double")
    assert math.isclose(metrics.wape_spark(df), 3e10)
    assert metrics.wape_numpy([1, 2], [1, 2]) == 0.0
    assert hurdle.WapeEvaluator().evaluate(df) == metrics.wape_spark(df) and not hurdle.WapeEvaluator().isLargerBetter()


def test_equal_thresholds_keep_the_first(spark):
    df = spark.createDataFrame([(5, 0.1, 5.0)], "quantite long, p_zero double, qty_pred double")
    assert metrics.best_threshold(metrics.threshold_sweep(df)).first()["threshold"] == 0.30


def test_splits_are_disjoint_or_raise(spark):
    s = SplitSpec("2024-03", "2024-04", "2024-05", "2024-06")
    df = panel(spark, [(f"2024-{w:02d}", 1, 1, w) for w in range(1, 8)])
    train, val = splits.train_rows(df, s, year="annee"), splits.validation_rows(df, s)
    assert (train.count(), val.count(), splits.test_rows(df, s, year="annee").count()) == (2, 2, 2)
    splits.assert_disjoint(train, val)
    with pytest.raises(ValueError):
        splits.assert_disjoint(val, train)


def test_the_future_does_not_change_the_past(spark):
    rows = [(f"2024-{w:02d}", g, a, (w * 7 + g * 3 + a) % 11) for w in range(1, 21) for g in (1, 2) for a in (1, 2)]
    changed = [(s, g, a, q + 100 if s >= "2024-12" else q) for s, g, a, q in rows]
    made = features.rolling_columns() | features.rolling_median_columns() | features.pair_columns() | features.seasonal_columns() | features.expanding_columns("code_agence", "agence") | features.expanding_columns("code_article", "article")

    def rows_of(x):
        df = panel(spark, x).withColumns(made).filter("semaine <= '2024-12'").select("semaine", "code_agence", "code_article", *made)
        return sorted(tuple(r) for r in df.collect())

    key = lambda rs: [tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v) for v in r) for r in rs]
    assert key(rows_of(rows)) == key(rows_of(changed))


def test_lags_and_rolling_match_a_plain_model(spark):
    ys = [3, 0, 5, 8, 1, 0, 9, 2, 4]
    df = panel(spark, [(f"2024-{i + 1:02d}", 1, 1, y) for i, y in enumerate(ys)]).withColumns(features.rolling_columns(FeatureSpec(means=(4,))) | features.lag_columns(FeatureSpec(lags=(2,))))
    for r in df.collect():
        i = r["num_sem"] - 1
        past = ys[max(0, i - 4) : i]
        assert r["lag_2"] == (ys[i - 2] if i >= 2 else None)
        assert (r["roll_mean_4"] is None) == (not past) and (not past or math.isclose(r["roll_mean_4"], sum(past) / len(past)))
        assert (r["roll_std_4"] is None) == (len(past) < 2)


def test_densify_and_dates(spark):
    sparse = spark.createDataFrame([("2024-01", 1, 1, 5), ("2024-02", 1, 2, 7)], "semaine string, code_agence long, code_article long, quantite long")
    full = cleaning.densify(sparse, sparse.select("semaine").distinct())
    assert full.count() == 4 and full.agg(F.sum("quantite")).first()[0] == 12
    from loomcast.sources.driver_tables import week_of

    assert spark.createDataFrame([(datetime(2021, 1, 3),)], "t timestamp").select(week_of(F.col("t"))).first()[0] == "2020-53"
