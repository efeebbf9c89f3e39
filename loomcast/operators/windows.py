"""Window specifications over a panel. Every frame ends before the current row, or week."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import PanelSpec

PANEL = PanelSpec()


def pair_order(p: PanelSpec = PANEL) -> WindowSpec:
    return Window.partitionBy(*p.keys).orderBy("week_id")


def pair_lookback(n: int, skip: int = 0, p: PanelSpec = PANEL) -> WindowSpec:
    """The n rows before the last ``skip`` ones."""
    return pair_order(p).rowsBetween(-(n + skip), -(1 + skip))


def pair_expanding(p: PanelSpec = PANEL) -> WindowSpec:
    return pair_order(p).rowsBetween(Window.unboundedPreceding, -1)


def seasonal_expanding(p: PanelSpec = PANEL) -> WindowSpec:
    """The same week number in earlier years."""
    return Window.partitionBy(*p.keys, "num_sem").orderBy("annee").rowsBetween(Window.unboundedPreceding, -1)


def expanding_by(column: str, frame: str = "range", p: PanelSpec = PANEL) -> WindowSpec:
    """All pairs of one group or item. ``range``: earlier weeks only, whatever the row order.

    ``rows`` takes in rows of the same week that sort first (by pair), as a row frame ordered by week alone would at random.
    """
    if frame == "range":
        return Window.partitionBy(column).orderBy("week_id").rangeBetween(Window.unboundedPreceding, -1)
    return Window.partitionBy(column).orderBy("week_id", *p.keys).rowsBetween(Window.unboundedPreceding, -1)


def group_expanding(frame: str = "range", p: PanelSpec = PANEL) -> WindowSpec:
    return expanding_by(p.group, frame, p)


def item_expanding(frame: str = "range", p: PanelSpec = PANEL) -> WindowSpec:
    return expanding_by(p.item, frame, p)


def whole_pair(p: PanelSpec = PANEL) -> WindowSpec:
    return Window.partitionBy(*p.keys)


def lag(column: str, n: int, p: PanelSpec = PANEL) -> Column:
    """The value n rows (not weeks) earlier in the pair."""
    return F.lag(column, n).over(pair_order(p))


def median(column: str, accuracy: int) -> Column:
    """Discrete median: always a value that occurs."""
    return F.percentile_approx(column, 0.5, accuracy)
