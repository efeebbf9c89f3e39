"""Label encoding: dense 0-based ranks of distinct values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import GROUP_CODE, ITEM_CODES, PanelSpec
from .windows import PANEL


def label_codes(df: DataFrame, source: str, code: str) -> DataFrame:
    """(source, code): rank of each distinct value from 0, nulls first (a null takes a rank).

    The window is over distinct values only; map-side distinct keeps what reaches its one task to the size of the domain.
    """
    return df.select(source).distinct().withColumn(code, (F.dense_rank().over(Window.orderBy(F.col(source).asc_nulls_first())) - 1).cast("int"))


def encode_column(df: DataFrame, source: str, code: str) -> DataFrame:
    """Adds the code; -1 if there is no such column, null where the value is null."""
    if source not in df.columns:
        return df.withColumn(code, F.lit(-1).cast("int"))
    return df.join(label_codes(df, source, code), source, "left")


def encode_items(items: DataFrame, p: PanelSpec = PANEL, codes: dict[str, str] = ITEM_CODES) -> DataFrame:
    """One row of codes for each pair; of several, the one whose codes sort first."""
    for source, code in codes.items():
        items = encode_column(items, source, code)
    names = list(codes.values())
    first = F.min(F.struct(*(F.col(c) for c in names)))
    return items.groupBy(*p.keys).agg(first.alias("_first")).select(*p.keys, *(F.col(f"_first.{c}").alias(c) for c in names))


def encode_groups(groups: DataFrame, p: PanelSpec = PANEL, names: tuple[str, ...] = ("region", "ag_region"), code: str = GROUP_CODE) -> DataFrame:
    source = next((n for n in names if n in groups.columns), names[-1])
    return encode_column(groups, source, code).groupBy(p.group).agg(F.min(code).alias(code))


def collect_label_encoder(df: DataFrame, column: str) -> dict:
    """value -> code on the driver; for domains of bounded size."""
    return {r[0]: r[1] for r in label_codes(df.filter(F.col(column).isNotNull()), column, "_code").orderBy("_code").collect()}


def apply_label_encoder(column: Column | str, mapping: dict, default: int = -1) -> Column:
    """The code by a constant map; ``default`` for null and unknown values."""
    if not mapping:
        return F.lit(default).cast("int")
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    value = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.when(value.isNotNull(), F.try_element_at(table, value)), F.lit(default)).cast("int")
