"""Descriptive analytics of a sales panel: distributions, trends, seasons, profiles, coverage, correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PanelSpec
from ..functions.columns import add_time_columns
from .windows import PANEL, pair_order


def profile_nulls(df: DataFrame) -> DataFrame:
    """(column, n_null, n_rows) of every column, in one pass."""
    cells = df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)))
    return cells.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_null"), F.col("n_rows").alias("n_rows")) for i, c in enumerate(df.columns)))))


def profile_target(sales: DataFrame, y: str = "quantite") -> DataFrame:
    q = F.percentile(y, F.array(*(F.lit(x) for x in (0.5, 0.75, 0.9, 0.95, 0.99))))
    row = sales.agg(F.avg((F.col(y) == 0).cast("double")).alias("zero_share"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("stddev"), F.max(y).alias("max"), q.alias("_q"))
    return row.select("zero_share", "mean", "stddev", "max", *(F.col("_q")[i].alias(n) for i, n in enumerate(("median", "p75", "p90", "p95", "p99"))))


def profile_trend(sales: DataFrame, y: str = "quantite") -> DataFrame:
    """Lowest, highest and mean weekly average of each year."""
    weekly = add_time_columns(sales).groupBy("annee", "week_id").agg(F.avg(y).alias("_w"))
    return weekly.groupBy("annee").agg(F.min("_w").alias("min_week"), F.max("_w").alias("max_week"), F.avg("_w").alias("mean_week"))


def profile_seasonality(sales: DataFrame, y: str = "quantite") -> DataFrame:
    return add_time_columns(sales).groupBy("num_sem").agg(F.avg(y).alias("mean"), F.count("*").alias("n"))


def top_weeks(sales: DataFrame, k: int = 5, y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    """The k weeks of largest volume and the k of smallest, ties to the earlier week."""
    weekly = sales.groupBy(p.week).agg(F.sum(y).alias("volume"))
    high = weekly.orderBy(F.desc("volume"), p.week).limit(k).withColumn("side", F.lit("top"))
    return high.unionByName(weekly.orderBy("volume", p.week).limit(k).withColumn("side", F.lit("bottom")))


def profile_groups(sales: DataFrame, y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    return sales.groupBy(p.group).agg(F.sum(y).alias("volume"), F.avg(y).alias("mean"), F.countDistinct(p.item).alias("n_articles"), F.avg((F.col(y) == 0).cast("double")).alias("zero_share"))


def profile_region(sales: DataFrame, groups: DataFrame, y: str = "quantite", region: str = "region", p: PanelSpec = PANEL) -> DataFrame:
    """Volume and number of groups of each region; sales are summed by group before the join."""
    by = sales.groupBy(p.group).agg(F.sum(y).alias("_v"))
    return by.join(groups.select(p.group, region).distinct(), p.group).groupBy(region).agg(F.sum("_v").alias("volume"), F.countDistinct(p.group).alias("n_agences"))


def pareto_items(sales: DataFrame, share: float = 0.8, y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    """How many items, largest first, make up ``share`` of the volume. The running sum sees one row for each item."""
    volumes = sales.groupBy(p.item).agg(F.sum(y).alias("volume"))
    order = Window.orderBy(F.desc("volume"), p.item).rowsBetween(Window.unboundedPreceding, -1)
    ranked = volumes.select("volume", F.coalesce(F.sum("volume").over(order), F.lit(0)).alias("_before"))
    total = volumes.agg(F.sum("volume").alias("_total"))  # 1 row
    both = ranked.crossJoin(F.broadcast(total))
    return both.agg(F.count_if(F.col("_before") < F.col("_total") * share).alias("n_items_80"), F.count("*").alias("n_items"))


def profile_category(sales: DataFrame, items: DataFrame, category: str, y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    """Volume, share, pairs and items of each value of an item attribute."""
    pairs = sales.groupBy(*p.keys).agg(F.sum(y).alias("_v"))
    found = pairs.join(items.select(*p.keys, category).dropDuplicates(p.keys), p.keys, "left")
    grouped = found.groupBy(category).agg(F.sum("_v").alias("volume"), F.count("*").alias("n_pairs"), F.countDistinct(p.item).alias("n_articles"))
    return grouped.withColumn("share", F.try_divide(F.col("volume"), F.sum("volume").over(Window.partitionBy())))


def coverage(train: DataFrame, test: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    """(level, n_train, n_test, n_cold): distinct pairs, groups and items, and those of the test that training lacks."""
    out = None
    for level, keys in (("pair", p.keys), (p.group, [p.group]), (p.item, [p.item])):
        a, b = train.select(*keys).distinct(), test.select(*keys).distinct()
        row = a.agg(F.count("*").alias("n_train")).crossJoin(b.agg(F.count("*").alias("n_test"))).crossJoin(b.join(a, keys, "left_anti").agg(F.count("*").alias("n_cold")))  # 1-row sides
        row = row.select(F.lit(level).alias("level"), "n_train", "n_test", "n_cold")
        out = row if out is None else out.unionByName(row)
    return out


def pair_distribution(sales: DataFrame, y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    pairs = sales.groupBy(*p.keys).agg(F.sum(y).alias("_s"), F.avg(y).alias("_a"), F.avg((F.col(y) == 0).cast("double")).alias("_z"), F.count_if(F.col(y) > 0).alias("_n"))
    tests = {"n_dead": F.col("_s") == 0, "n_mostly_zero": F.col("_z") > 0.9, "n_over_10": F.col("_a") > 10, "n_over_100": F.col("_a") > 100, "n_single_week": F.col("_n") == 1}
    return pairs.agg(F.count("*").alias("n_pairs"), *(F.count_if(c).alias(n) for n, c in tests.items()))


def billing_stats(billing: DataFrame, columns: tuple[str, ...] = ("nb_achats", "sum_quantite", "sum_montant")) -> DataFrame:
    """(measure, median, mean, max), and the same of the unit price."""
    priced = billing.withColumn("prix_unit", F.when(F.col("sum_quantite") != 0, F.col("sum_montant") / F.col("sum_quantite")))
    names = [*columns, "prix_unit"]
    cells = priced.agg(*(f(F.col(c).cast("double")).alias(f"{k}_{c}") for c in names for k, f in (("a", lambda x: F.percentile(x, 0.5)), ("b", F.avg), ("c", F.max))))
    return cells.select(F.inline(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(f"a_{c}").alias("median"), F.col(f"b_{c}").alias("mean"), F.col(f"c_{c}").alias("max")) for c in names))))


def lag_correlation(sales: DataFrame, lags: tuple[int, ...] = (1, 4, 12, 26, 52), y: str = "quantite", p: PanelSpec = PANEL) -> DataFrame:
    """(lag, correlation, n): correlation of the target with itself n rows earlier."""
    w = pair_order(p)
    lagged = add_time_columns(sales).select(F.col(y).cast("double").alias("y"), *(F.lag(F.col(y).cast("double"), n).over(w).alias(f"l{n}") for n in lags))
    cells = lagged.agg(*(F.corr("y", f"l{n}").alias(f"c{n}") for n in lags), *(F.count(f"l{n}").alias(f"n{n}") for n in lags))
    return cells.select(F.inline(F.array(*(F.struct(F.lit(n).alias("lag"), F.col(f"c{n}").alias("correlation"), F.col(f"n{n}").alias("n")) for n in lags))))
