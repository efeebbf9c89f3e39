"""Monthly billing, made joinable two months later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BILLING_COLUMNS, BILLING_SHIFT_MONTHS, PanelSpec
from ..functions.columns import first_column, guarded_ratio, month_of_week, shifted_month
from .windows import PANEL


def billing_lagged(billing: DataFrame, by: int = BILLING_SHIFT_MONTHS, p: PanelSpec = PANEL) -> DataFrame:
    """Pair, ``_join_annee``, ``_join_mois`` and the ``fac_*`` columns: each month's figures, keyed ``by`` months later.

    Columns that the source lacks count as 0; year and month go by either name.
    """
    measures = ("sum_montant", "sum_quantite", "nb_achats", "nb_achats_par_professionnels", "nb_chantiers")
    named = billing.select(*p.keys, first_column(billing, "annee", "year").cast("int").alias("_y"), first_column(billing, "mois", "month").cast("int").alias("_m"), *(first_column(billing, c, default=0.0).alias(c) for c in measures))
    monthly = named.groupBy(*p.keys, "_y", "_m").agg(*(F.sum(c).alias(c) for c in measures))
    year, month = shifted_month(F.col("_y"), F.col("_m"), by)
    return monthly.select(
        *p.keys, year.alias("_join_annee"), month.alias("_join_mois"),
        guarded_ratio(F.col("sum_montant"), F.col("sum_quantite")).cast("double").alias("fac_prix_unit"),
        guarded_ratio(F.col("nb_achats_par_professionnels"), F.col("nb_achats")).cast("double").alias("fac_pct_pro"),
        F.col("nb_chantiers").cast("double").alias("fac_nb_chantiers"), F.col("nb_achats").cast("double").alias("fac_nb_achats"),
    )


def join_billing(panel: DataFrame, lagged: DataFrame, p: PanelSpec = PANEL) -> DataFrame:
    """Left equi-join on pair, year and the month of the week."""
    keyed = panel.withColumns({"_join_annee": F.col("annee"), "_join_mois": month_of_week(F.col("num_sem"))})
    return keyed.join(lagged.select(*p.keys, "_join_annee", "_join_mois", *BILLING_COLUMNS), [*p.keys, "_join_annee", "_join_mois"], "left").drop("_join_annee", "_join_mois")
