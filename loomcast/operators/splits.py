"""Temporal splits. ``YYYY-WW`` is zero-padded, so that string order is time order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SplitSpec


def _within(first: str | None, last: str | None, before: str | None, week: str, year: str | None) -> Column:
    """The week bounds, and what follows from them for a partition column ``year``, so that partitions are pruned."""
    c, out = F.col(week), F.lit(True)
    if first:
        out &= c >= first
    if last:
        out &= c <= last
    if before:
        out &= c < before
    if year:
        if first:
            out &= F.col(year) >= int(first[:4])
        if last or before:
            out &= F.col(year) <= int((last or before)[:4])
    return out


def train_rows(df: DataFrame, s: SplitSpec = SplitSpec(), week: str = "semaine", year: str | None = None) -> DataFrame:
    return df.filter(_within(None, None, s.val_start, week, year))


def validation_rows(df: DataFrame, s: SplitSpec = SplitSpec(), week: str = "semaine", year: str | None = None) -> DataFrame:
    return df.filter(_within(s.val_start, s.val_end, None, week, year))


def test_rows(df: DataFrame, s: SplitSpec = SplitSpec(), week: str = "semaine", year: str | None = None) -> DataFrame:
    return df.filter(_within(s.test_start, s.test_end, None, week, year))


test_rows.__test__ = False


def split_overlap(train: DataFrame, validation: DataFrame) -> DataFrame:
    """One row: ``train_max``, ``val_min`` and ``disjoint``."""
    both = train.agg(F.max("week_id").alias("train_max")).crossJoin(validation.agg(F.min("week_id").alias("val_min")))  # 1 x 1 rows
    return both.withColumn("disjoint", F.col("train_max") < F.col("val_min"))


def assert_disjoint(train: DataFrame, validation: DataFrame) -> None:
    row = split_overlap(train, validation).first()
    if row["disjoint"] is False:
        raise ValueError(f"training ends at {row['train_max']}, validation begins at {row['val_min']}")
