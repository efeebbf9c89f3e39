"""Leakage-safe panel features. Expressions of one window specification stand together, so that one sort serves them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BASE_COLUMNS, FeatureSpec, PanelSpec, all_features
from ..functions.columns import clamped_trend, cyclic, guarded_ratio, is_christmas, is_summer, with_missing, zero_indicator
from .billing import join_billing
from .windows import PANEL, expanding_by, median, pair_expanding, pair_lookback, pair_order, seasonal_expanding


def with_target(panel: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    y = F.col(p.target).cast("double")
    return panel.withColumns({"y": y, "_zero": zero_indicator(y)})


def lag_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    return {f"lag_{n}": F.lag("y", n).over(pair_order(p)) for n in s.lags}


def rolling_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    means = {f"roll_mean_{n}": F.avg("y").over(pair_lookback(n, p=p)) for n in s.means}
    return means | {f"roll_std_{n}": F.stddev_samp("y").over(pair_lookback(n, p=p)) for n in s.means}


def rolling_median_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    return {f"roll_median_{n}": median("y", s.accuracy).over(pair_lookback(n, p=p)) for n in s.medians}


def zero_rate_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    rates = {f"zero_rate_{n}": F.avg("_zero").over(pair_lookback(n, p=p)) for n in s.zero_rates}
    return rates | {"pair_zero_rate_expanding": F.avg("_zero").over(pair_expanding(p))}


def trend_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    recent, before = (F.avg("y").over(pair_lookback(s.recent, skip, p)) for skip in (0, s.recent))
    year, two = (F.lag("y", n).over(pair_order(p)) for n in (52, 104))
    return {"trend_8": clamped_trend(recent, before, s.trend_clamp, s.trend_offset), "yoy_ratio": guarded_ratio(year, two)}


def pair_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    w = pair_expanding(p)
    mean = F.avg("y").over(w)
    return {
        "pair_mean": mean,
        "pair_median": median("y", s.accuracy).over(w),
        "pair_max": F.max("y").over(w),
        "pair_count": F.count("y").over(w),
        "pair_cv": guarded_ratio(F.stddev_samp("y").over(w), mean, s.cv_epsilon),
        "ratio_n1_vs_mean": guarded_ratio(F.lag("y", 52).over(pair_order(p)), mean),
        "n_active_weeks": F.sum((F.col("y") > 0).cast("double")).over(w),
    }


def seasonal_columns(s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    w = seasonal_expanding(p)
    return {"sem_mean": F.avg("y").over(w), "sem_max": F.max("y").over(w), "sem_median": median("y", s.accuracy).over(w)}


def expanding_columns(column: str, prefix: str, s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> dict[str, Column]:
    """Mean and median over all earlier rows of a group as window columns: one task holds a group (see :func:`group_history`)."""
    w = expanding_by(column, s.group_frame, p)
    return {f"{prefix}_mean": F.avg("y").over(w), f"{prefix}_median": median("y", s.accuracy).over(w)}


def group_history(panel: DataFrame, prefixes: dict[str, str]) -> dict[str, DataFrame]:
    """For each group column of ``prefixes``: (column, week_id, prefix_mean, prefix_median) over all earlier weeks.

    Values are counted by group, week and value in one pass over the panel, aggregated before the shuffle; the windows run
    over these counts. No task holds a group's rows: what it holds is bounded by weeks times distinct values (whole numbers
    up to the cleaning's limit), however many rows there are.

    The median is the value at rank ceil(n / 2), as everywhere here. ``percentile`` interpolates; with every count doubled and
    one value put below all others, the middle of what is then an odd number of values is just that one.
    """
    by = list(prefixes)
    counted = panel.groupingSets([[c, "week_id", "y"] for c in by], *by, "week_id", "y").agg(F.count("y").alias("_n"), *(F.grouping(c).alias(f"_not_{c}") for c in by))
    found = {}
    for c, prefix in prefixes.items():
        counts = counted.filter(F.col(f"_not_{c}") == 0).select(c, F.col("week_id").cast("long").alias("week_id"), "y", "_n", (2 * F.col("_n")).alias("_weight"))
        lowest = counts.select(c, F.lit(-1).cast("long").alias("week_id"), F.lit(float("-inf")).alias("y"), F.lit(0).cast("long").alias("_n"), F.lit(1).cast("long").alias("_weight")).distinct()
        past = Window.partitionBy(c).orderBy("week_id").rangeBetween(Window.unboundedPreceding, -1)
        middle = F.percentile(F.when(F.col("_weight") > 0, F.col("y")), 0.5, F.col("_weight")).over(past)
        mean = F.try_divide(F.sum(F.when(F.col("_n") > 0, F.col("y") * F.col("_n"))).over(past), F.sum("_n").over(past))
        running = counts.unionByName(lowest).select(c, "week_id", mean.alias("_mean"), F.when(middle > float("-inf"), middle).alias("_median"))
        weekly = running.filter("week_id >= 0").groupBy(c, F.col("week_id").cast("int").alias("week_id"))
        found[c] = weekly.agg(F.max("_mean").alias(f"{prefix}_mean"), F.max("_median").alias(f"{prefix}_median"))
    return found


def with_group_history(panel: DataFrame, prefixes: dict[str, str], s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """``panel`` with the means and medians of its groups' earlier weeks."""
    if s.group_frame != "range":
        for c, prefix in prefixes.items():
            panel = panel.withColumns(expanding_columns(c, prefix, s, p))
        return panel
    for c, history in group_history(panel, prefixes).items():
        panel = panel.join(history, [c, "week_id"], "left")
    return panel


def expanding_means(panel: DataFrame, column: str, name: str) -> DataFrame:
    """(column, week_id, name): mean of y over all earlier weeks, for large groups.

    Sums and counts by week are aggregated before the shuffle, and the running window sees one row for each group and
    week: no task holds a group's rows.
    """
    weekly = panel.groupBy(column, "week_id").agg(F.sum("y").alias("_s"), F.count("y").alias("_n"))
    past = Window.partitionBy(column).orderBy("week_id").rowsBetween(Window.unboundedPreceding, -1)
    return weekly.select(column, "week_id", F.try_divide(F.sum("_s").over(past), F.sum("_n").over(past)).alias(name))


def calendar_columns() -> dict[str, Column]:
    week = F.col("num_sem")
    sin, cos = cyclic(week)
    return {"sin_sem": sin, "cos_sem": cos, "is_summer_trough": is_summer(week), "is_xmas_trough": is_christmas(week)}


def window_features(panel: DataFrame, s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """All window and calendar features; windows of one shuffle key follow each other."""
    df = with_target(panel, p)
    df = df.withColumns(seasonal_columns(s, p))
    pair = lag_columns(s, p) | rolling_columns(s, p) | rolling_median_columns(s, p) | zero_rate_columns(s, p) | trend_columns(s, p) | pair_columns(s, p)
    return with_group_history(df.withColumns(pair | calendar_columns()), {p.group: "agence", p.item: "article"}, s, p)


def gold_features(panel: DataFrame, item_codes: DataFrame, group_codes: DataFrame, billing: DataFrame, s: FeatureSpec = FeatureSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """The feature table: base columns and all model features, absent ones null. Dimensions join without hints: their
    size decides (automatic broadcast below the session's threshold, else by shuffle)."""
    df = window_features(panel, s, p).join(item_codes, p.keys, "left").join(group_codes, p.group, "left")
    names = all_features(s)
    return with_missing(join_billing(df, billing, p), names).select(*BASE_COLUMNS, *names)
