"""Two-stage forecast: probability of zero, quantity where not zero, and the gate between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import GROUP_CODE, ITEM_CODES, SEED, FeatureSpec, all_features
from ..functions.columns import nonneg_round_even
from . import metrics

#: What stands in for a missing short-window statistic.
SHORT_TO_LONG = {
    "roll_mean_4": "roll_mean_26", "roll_mean_8": "roll_mean_26", "roll_mean_13": "roll_mean_26",
    "roll_std_4": "roll_std_26", "roll_std_8": "roll_std_26", "roll_std_13": "roll_std_26", "roll_median_4": "roll_median_13",
}
SHORT_LAG = 26
CATEGORICAL = frozenset([*ITEM_CODES.values(), GROUP_CODE])
#: Codes from which a categorical feature is taken as a number: each costs a bin in every split.
MOST_CODES = 256
#: Bytes of rows (as the planner estimates them) of a task of training.
TASK_BYTES = 32 << 20


def impute_short_horizon(df: DataFrame, s: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Missing lags under 26 rows become the pair's mean, missing short-window statistics the longer window's."""
    lags = {f"lag_{n}": F.coalesce(f"lag_{n}", "pair_mean") for n in s.lags if n < SHORT_LAG and f"lag_{n}" in df.columns}
    windows = {a: F.coalesce(a, b) for a, b in SHORT_TO_LONG.items() if a in df.columns and b in df.columns}
    return df.withColumns(lags | windows)


def gate(p_zero: Column, quantity: Column, threshold: float | Column) -> Column:
    """0 where zero is likelier than ``threshold``, else the quantity, at least 0."""
    return F.when(p_zero > threshold, F.lit(0.0)).otherwise(F.greatest(quantity, F.lit(0.0)))


def final_prediction(p_zero: Column, quantity: Column, dead: Column, threshold: float | Column) -> Column:
    """The gated quantity as a whole number, half-even; dead pairs get 0."""
    return nonneg_round_even(F.when(dead == 1, F.lit(0.0)).otherwise(gate(p_zero, quantity, threshold)))


def final_predictions(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("semaine", "code_agence", "code_article", final_prediction(F.col("p_zero"), F.col("qty_pred"), F.col("is_dead_pair"), threshold).alias("prediction"))


class WapeEvaluator(Evaluator):
    """WAPE for model selection; lower is better."""

    def __init__(self, y: str = "quantite", predicted: str = "prediction"):
        super().__init__()
        self.y, self.predicted = y, predicted

    def _evaluate(self, dataset: DataFrame) -> float:
        return metrics.wape_spark(dataset, self.y, self.predicted)

    def isLargerBetter(self) -> bool:  # noqa: N802
        return False


@dataclass(frozen=True)
class HurdleSpec:
    """Boosting budgets; much smaller than a dedicated library's, whose trees grow by leaves and take missing values."""

    zero_rounds: int = 20
    quantity_rounds: int = 20
    depth: int = 5
    zero_step: float = 0.1
    quantity_step: float = 0.1
    feature_share: str = "0.8"
    row_share: float = 0.85
    zero_weight: float = 1.5
    bins: int = 64


def categories(train: DataFrame, names: list[str], most: int) -> dict[str, int]:
    """How many codes each categorical feature has in ``train`` (codes count from 0), of those with fewer than ``most``.

    A feature with more codes than a tree can bin stays a number.
    """
    coded = [c for c in names if c in CATEGORICAL]
    row = train.agg(*(F.max(c).alias(c) for c in coded)).first() if coded else {}
    return {c: int(row[c]) + 1 for c in coded if row[c] is not None and 0 <= row[c] < most - 1}


def design(df: DataFrame, names: list[str], codes: dict[str, int] | None = None) -> DataFrame:
    """``features``: each feature with missing values as 0 and an indicator of what was missing (trees here reject nulls).

    Features in ``codes`` are categories, by their number of codes; missing and unknown codes share one more.
    """
    codes = codes or {}

    def value(c: str) -> Column:
        if c not in codes:
            return F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_x_{c}")
        known = F.when(F.col(c).between(0, codes[c] - 1), F.col(c)).otherwise(codes[c]).cast("double")
        return known.alias(f"_x_{c}", metadata={"ml_attr": {"type": "nominal", "num_vals": codes[c] + 1}})

    filled = df.select("*", *(value(c) for c in names), *(F.col(c).isNull().cast("double").alias(f"_m_{c}") for c in names))
    made = VectorAssembler(inputCols=[f"_x_{c}" for c in names] + [f"_m_{c}" for c in names], outputCol="features").transform(filled)
    return made.select(*df.columns, "features")


def few_tasks(df: DataFrame, each: int = TASK_BYTES) -> DataFrame:
    """``df`` in as many partitions as its bytes ask for, one for each core at least, and never more than it has.

    Boosting runs two jobs for each level of a tree, of one task a partition and stage, and the driver keeps a record of every task.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, min(size // each, 1 << 30)))


class HurdleModel:
    def __init__(self, zero, quantity, names: list[str], codes: dict[str, int] | None = None):
        self.zero, self.quantity, self.names, self.codes = zero, quantity, names, codes or {}

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``p_zero`` and ``qty_pred`` (at least 0)."""
        x = self.zero.transform(design(df, self.names, self.codes)).withColumn("p_zero", vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")
        return self.quantity.transform(x).withColumn("qty_pred", F.greatest("prediction", F.lit(0.0))).drop("prediction", "features")

    def importance(self, spark) -> DataFrame:
        """(stage, feature, importance) of both stages, highest first; indicators count to their feature."""
        rows = []
        n = len(self.names)
        for stage, model in (("zero", self.zero), ("quantity", self.quantity)):
            v = model.featureImportances.toArray()
            rows += [(stage, c, float(v[i] + v[i + n])) for i, c in enumerate(self.names)]
        return spark.createDataFrame(rows, "stage string, feature string, importance double").orderBy("stage", F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self.zero.write().overwrite().save(f"{path}/zero")
        self.quantity.write().overwrite().save(f"{path}/quantity")
        spark = SparkSession.active()
        rows = [(i, c, self.codes.get(c)) for i, c in enumerate(self.names)]
        spark.createDataFrame(rows, "place int, feature string, codes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_model(path: str) -> HurdleModel:
    """A model as saved, with its features and their codes."""
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import GBTRegressionModel

    rows = SparkSession.active().read.parquet(f"{path}/features").orderBy("place").collect()
    codes = {r["feature"]: r["codes"] for r in rows if r["codes"] is not None}
    return HurdleModel(GBTClassificationModel.load(f"{path}/zero"), GBTRegressionModel.load(f"{path}/quantity"), [r["feature"] for r in rows], codes)


def train_hurdle(train: DataFrame, validation: DataFrame, names: list[str] | None = None, s: HurdleSpec = HurdleSpec(), y: str = "quantite") -> HurdleModel:
    """Stage 1 learns y = 0 on all rows, stage 2 absolute error on rows above 0; validation rows stop the rounds early.

    Of stage 2's validation rows, absolute error is WAPE but for a constant factor, so that WAPE decides its rounds.
    """
    names = names or all_features()
    codes = categories(train, names, MOST_CODES)
    both = train.withColumn("_val", F.lit(False)).unionByName(validation.withColumn("_val", F.lit(True)))
    target = F.col(y).cast("double")
    x = design(few_tasks(both), names, codes).select("features", "_val", target.alias("_y"), (target == 0).cast("double").alias("_zero"), F.when(target == 0, s.zero_weight).otherwise(1.0).alias("_w"))
    common = {"featuresCol": "features", "validationIndicatorCol": "_val", "maxDepth": s.depth, "subsamplingRate": s.row_share, "featureSubsetStrategy": s.feature_share, "seed": SEED, "maxBins": max([s.bins, *(n + 1 for n in codes.values())])}
    zero = GBTClassifier(labelCol="_zero", weightCol="_w", maxIter=s.zero_rounds, stepSize=s.zero_step, **common)
    quantity = GBTRegressor(labelCol="_y", lossType="absolute", maxIter=s.quantity_rounds, stepSize=s.quantity_step, **common)
    return HurdleModel(Pipeline(stages=[zero]).fit(x).stages[0], Pipeline(stages=[quantity]).fit(x.filter("_y > 0")).stages[0], names, codes)
