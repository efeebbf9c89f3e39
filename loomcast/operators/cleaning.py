"""Sales cleaning: dead pairs, outlier cap, anomaly imputation, smoothing; and the train-test panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CleaningSpec, PanelSpec
from ..functions.columns import add_time_columns, flag, typed_nulls
from .windows import PANEL, median, pair_lookback, whole_pair

#: The columns of the cleaned panel, in order.
CLEAN_COLUMNS = (
    "semaine", "annee", "num_sem", "week_id", "code_agence", "code_article", "quantite_raw", "quantite", "quantite_smooth", "is_anomaly", "is_capped", "is_dead_pair",
)


def pair_statistics(sales: DataFrame, spec: CleaningSpec = CleaningSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """Sum, high percentile, median and the dead flag of each pair; partial aggregation before the shuffle."""
    q = F.col(p.target)
    found = sales.groupBy(*p.keys).agg(
        F.sum(q).alias("pair_sum"),
        F.percentile_approx(q, spec.percentile, spec.accuracy).alias("pair_p995"),
        F.percentile_approx(q, 0.5, spec.accuracy).alias("pair_median"),
    )
    return found.withColumn("is_dead_pair", flag(F.col("pair_sum") == 0))


def clean_sales(sales: DataFrame, spec: CleaningSpec = CleaningSpec(), p: PanelSpec = PANEL) -> DataFrame:
    """The cleaned panel: columns :data:`CLEAN_COLUMNS`.

    Pair statistics are window aggregates over the pair, so that the pair's rows are shuffled once for these, the anomaly
    baseline and the smoothing; joining an aggregate back would shuffle them again.
    """
    raw = add_time_columns(sales, p.week).withColumn("quantite_raw", F.col(p.target).cast("long"))
    own = whole_pair(p)
    stats = raw.withColumns({
        "_sum": F.sum("quantite_raw").over(own),
        "_high": F.percentile_approx("quantite_raw", spec.percentile, spec.accuracy).over(own),
        "_mid": F.percentile_approx("quantite_raw", 0.5, spec.accuracy).over(own),
    })
    dead = flag(F.col("_sum") == 0)
    # greatest() skips a null side; a dead pair has no cap
    cap = F.when(F.col("_sum") == 0, F.lit(None)).otherwise(F.greatest(F.col("_high").cast("double"), F.col("_mid") * spec.median_multiple))
    capped = stats.withColumns({"is_dead_pair": dead, "_cap": cap}).withColumn("is_capped", flag(F.coalesce(F.col("quantite_raw") > F.col("_cap"), F.lit(False))))
    value = capped.withColumn("_value", F.when(F.col("is_capped") == 1, F.col("_cap")).otherwise(F.col("quantite_raw").cast("double")))
    past = value.withColumn("_past", median("_value", spec.accuracy).over(pair_lookback(spec.anomaly_window, p=p)))
    odd = past.withColumn("is_anomaly", flag(F.coalesce((F.col("_past") > 0) & (F.col("_value") > F.col("_past") * spec.anomaly_multiple), F.lit(False))))
    done = odd.withColumn("quantite", F.when(F.col("is_anomaly") == 1, F.col("_past")).otherwise(F.col("_value")).cast("long"))
    return done.withColumn("quantite_smooth", F.avg("quantite").over(pair_lookback(spec.smooth_window, p=p))).select(*CLEAN_COLUMNS)


def panel_union(cleaned: DataFrame, to_predict: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    """Cleaned rows and rows to predict (targets null), each pair's dead flag on all of its rows."""
    unknown = {"quantite_raw": "long", "quantite": "long", "quantite_smooth": "double"}
    zeros = {c: F.lit(0).cast("tinyint") for c in ("is_anomaly", "is_capped", "is_dead_pair")}
    future = add_time_columns(to_predict, p.week).withColumns(typed_nulls(unknown) | zeros).select(*cleaned.columns)
    return cleaned.unionByName(future).withColumn("is_dead_pair", F.max("is_dead_pair").over(whole_pair(p)).cast("tinyint"))


def densify(sparse: DataFrame, weeks: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    """Every pair in every week of ``weeks``, missing quantities 0. ``weeks`` is a calendar: 53 rows a year at most."""
    grid = sparse.select(*p.keys).distinct().crossJoin(F.broadcast(weeks))
    return grid.join(sparse, [*p.keys, p.week], "left").withColumn(p.target, F.coalesce(p.target, F.lit(0).cast("long")))
