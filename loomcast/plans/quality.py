"""Data-quality rules on a dataset's output rows: warn, drop or fail.

A predicate that is null counts as failed. Rules see rows after all windows: what is dropped has already been part of
the statistics of other rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import CleaningSpec


class ExpectationFailed(Exception):
    """A rule with action ``fail`` met rows that break it."""


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action}")

    @property
    def holds(self):
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """(name, action, n_rows, n_failed) of all rules, in one pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], "name string, action string, n_rows long, n_failed long")
    cells = df.agg(F.count("*").alias("n_rows"), *(F.count_if(~r.holds).alias(f"f{i}") for i, r in enumerate(rules)))
    return cells.select(F.inline(F.array(*(F.struct(F.lit(r.name).alias("name"), F.lit(r.action).alias("action"), F.col("n_rows").alias("n_rows"), F.col(f"f{i}").alias("n_failed")) for i, r in enumerate(rules)))))


def drop_failed(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    for r in rules:
        if r.action == "drop":
            df = df.filter(r.holds)
    return df


def enforce(df: DataFrame, rules: list[Expectation]) -> tuple[DataFrame, list]:
    """The rows that stay, and the report, counted by a pass of its own. A ``fail`` rule that is broken raises at once."""
    rows = report(df, rules).collect()  # a row for each rule
    broken = [r["name"] for r in rows if r["action"] == "fail" and r["n_failed"]]
    if broken:
        raise ExpectationFailed(", ".join(broken))
    return drop_failed(df, rules), rows


class Watched:
    """A dataset whose rules are counted while it is written: ``rows`` are those that stay, ``report`` is known after the write."""

    def __init__(self, df: DataFrame, rules: list[Expectation]):
        self.rules, self.seen = rules, Observation() if rules else None
        counts = [F.count(F.lit(1)).alias("n_rows"), *(F.count_if(~r.holds).alias(f"f{i}") for i, r in enumerate(rules))]
        self.rows = drop_failed(df.observe(self.seen, *counts) if rules else df, rules)

    def report(self) -> list[dict]:
        """A dict for each rule: name, action, n_rows, n_failed."""
        found = self.seen.get if self.rules else {}
        return [{"name": r.name, "action": r.action, "n_rows": found["n_rows"], "n_failed": found[f"f{i}"]} for i, r in enumerate(self.rules)]

    def broken(self) -> list[str]:
        return [r["name"] for r in self.report() if r["action"] == "fail" and r["n_failed"]]


def guard(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Lazy form: ``drop`` rules filter, ``fail`` rules raise while rows are read."""
    for r in rules:
        if r.action == "fail":
            df = df.filter(F.when(r.holds, F.lit(True)).otherwise(F.raise_error(F.lit(f"expectation {r.name} failed")).cast("boolean")))
    return drop_failed(df, rules)


def not_null(column: str, action: str, name: str | None = None) -> Expectation:
    return Expectation(name or f"{column}_not_null", f"{column} IS NOT NULL", action)


def rules_for(c: CleaningSpec = CleaningSpec()) -> dict[str, list[Expectation]]:
    """The rules of each dataset."""
    keys = "code_agence IS NOT NULL AND code_article IS NOT NULL"
    return {
        "silver_ventes": [
            *(not_null(x, "drop") for x in ("semaine", "code_agence", "code_article")),
            Expectation("quantite_non_negative", f"quantite >= {c.min_quantity}"),
            Expectation("quantite_reasonable", f"quantite <= {c.max_quantity}"),
            Expectation("annee_in_range", f"annee BETWEEN {c.first_year} AND {c.last_year}"),
        ],
        "silver_articles_encoded": [Expectation("articles_unique_pair", keys, "fail")],
        "silver_panel": [not_null("semaine", "drop"), Expectation("keys_not_null", keys, "drop")],
        "gold_train": [not_null("quantite", "drop")],
        "gold_validation": [not_null("quantite", "drop")],
        "gold_test_features": [Expectation("quantite_is_null", "quantite IS NULL", "fail")],
    }
