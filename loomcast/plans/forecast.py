"""The forecasting graph: raw tables, cleaned and encoded ones, features, splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import ForecastSpec
from ..operators import billing, cleaning, encoding, features, splits
from .graph import Graph
from .quality import rules_for

SOURCES = ("bronze_ventes", "bronze_ventes_test", "bronze_agences", "bronze_articles", "bronze_facturation")


def forecast_graph(read: Callable[[SparkSession, str], DataFrame], spec: ForecastSpec = ForecastSpec()) -> Graph:
    """``read(spark, name)`` gives each of the five raw tables, passed through as the first layer."""
    g = Graph()
    rules = rules_for(spec.cleaning)
    silver, gold = {"quality": "silver"}, {"quality": "gold"}
    for raw in SOURCES:
        g.source(raw, lambda spark, raw=raw: read(spark, raw))

    def add(name, inputs, build, comment, properties, **more):
        g.dataset(*inputs, name=name, comment=comment, table_properties=properties, expect=rules.get(name), **more)(build)

    p = spec.panel
    add("silver_ventes", ["bronze_ventes"], lambda s: cleaning.clean_sales(s, spec.cleaning, p), "cleaned sales", silver)
    add("silver_articles_encoded", ["bronze_articles"], lambda a: encoding.encode_items(a, p), "item codes", silver)
    add("silver_agences_encoded", ["bronze_agences"], lambda a: encoding.encode_groups(a, p), "group codes", silver)
    add("silver_facturation_lagged", ["bronze_facturation"], lambda f: billing.billing_lagged(f, p=p), "billing two months on", silver)
    add("silver_panel", ["silver_ventes", "bronze_ventes_test"], lambda v, t: cleaning.panel_union(v, t, p), "known and unknown weeks", silver)
    add("gold_feature_table", ["silver_panel", "silver_articles_encoded", "silver_agences_encoded", "silver_facturation_lagged"], lambda *x: features.gold_features(*x, spec.features, p), "all features", gold, partition_cols=["annee"])
    for name, rows, comment in (("gold_train", splits.train_rows, "before validation"), ("gold_validation", splits.validation_rows, "validation weeks"), ("gold_test_features", splits.test_rows, "weeks to predict")):
        add(name, ["gold_feature_table"], lambda f, rows=rows: rows(f, spec.splits, p.week, "annee"), comment, gold)
    return g
