"""The star-schema tables as the forecasting inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SplitSpec
from ..functions.columns import week_string
from ..operators.cleaning import densify

SPLITS = SplitSpec(val_start="2001-01", val_end="2001-22", test_start="2001-23", test_end="2001-44")


def _read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def week_of(ts: Column) -> Column:
    """ISO week as ``YYYY-WW``."""
    return week_string(F.extract(F.lit("YEAROFWEEK"), ts), F.weekofyear(ts))


def _item() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("long")


def _lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    lines = _read(spark, folder, "lineitem", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", *columns)
    suppliers = _read(spark, folder, "supplier", "s_suppkey", F.col("s_nationkey").cast("long").alias("code_agence"))
    parts = _read(spark, folder, "part", "p_partkey", _item().alias("code_article"))
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))


def sparse_sales(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lines(spark, folder).withColumn("semaine", week_of(F.col("l_shipdate")))
    return rows.groupBy("semaine", "code_agence", "code_article").agg(F.sum("l_quantity").cast("long").alias("quantite"))


def dense_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Every pair in every observed week, zeros included."""
    sparse = sparse_sales(spark, folder)
    weeks = _read(spark, folder, "lineitem", week_of(F.col("l_shipdate")).alias("semaine")).distinct()
    return densify(sparse, weeks).select("semaine", "code_agence", "code_article", "quantite")


def known_sales(spark: SparkSession, folder: str) -> DataFrame:
    return dense_sales(spark, folder).filter(F.col("semaine") <= SPLITS.val_end)


def weeks_to_predict(spark: SparkSession, folder: str) -> DataFrame:
    return dense_sales(spark, folder).filter(F.col("semaine").between(SPLITS.test_start, SPLITS.test_end)).drop("quantite")


def agencies(spark: SparkSession, folder: str) -> DataFrame:
    nations = _read(spark, folder, "nation", F.col("n_nationkey").cast("long").alias("code_agence"), "n_regionkey")
    regions = _read(spark, folder, "region", "r_regionkey", F.col("r_name").alias("region"))
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("code_agence", "region")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    """Attributes of each pair that ever sold: those of its lowest part."""
    lines = _read(spark, folder, "lineitem", "l_partkey", "l_suppkey")
    suppliers = _read(spark, folder, "supplier", "s_suppkey", F.col("s_nationkey").cast("long").alias("code_agence"))
    parts = _read(spark, folder, "part", "p_partkey", "p_type", "p_size", "p_name", _item().alias("code_article"))
    joined = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    lowest = F.min(F.struct("p_partkey", "p_type", "p_size", "p_name"))
    return joined.groupBy("code_agence", "code_article").agg(lowest.alias("_p")).select(
        "code_agence", "code_article", F.col("_p.p_type").alias("specialite"), F.col("_p.p_size").cast("string").alias("famille"), F.col("_p.p_name").alias("marque"), (F.col("code_article") % 2).alias("article_mdd"),
    )


def billing(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder, "l_orderkey", "l_extendedprice", "l_discount")
    orders = _read(spark, folder, "orders", "o_orderkey", "o_custkey")
    customers = _read(spark, folder, "customer", "c_custkey", "c_mktsegment")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("code_agence", "code_article", F.year("l_shipdate").alias("annee"), F.month("l_shipdate").alias("mois")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("sum_montant"), F.sum("l_quantity").alias("sum_quantite"), F.count("*").alias("nb_achats"),
        F.count_if(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).alias("nb_achats_par_professionnels"), F.countDistinct("o_custkey").alias("nb_chantiers"),
    )


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    made = {"bronze_ventes": known_sales, "bronze_ventes_test": weeks_to_predict, "bronze_agences": agencies, "bronze_articles": articles, "bronze_facturation": billing}
    return made[name](spark, folder)
