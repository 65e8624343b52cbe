"""Aggregate helpers shared by queries, marts and reports.

Averages run on the decimal columns (exact sum, result rounded half-up at
scale + 4, as a database AVG over DECIMAL does), then ``round`` to the
reporting precision and cast to DOUBLE for a stable result type.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def avg_round(col: str | Column, digits: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.avg(c), digits).cast("double")


def avg_round_or_zero(col: str | Column, digits: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(F.coalesce(F.avg(c), F.lit(0)), digits).cast("double")


def share_pct(part: Column, whole: Column, digits: int = 1) -> Column:
    """part * 100 / whole, exact decimal arithmetic, rounded half-up; NULL on 0."""
    ratio = F.try_divide(part * F.lit(100.0).cast("decimal(4,1)"), whole)
    return F.round(ratio, digits).cast("double")


def count_where(cond: Column) -> Column:
    """Conditional count: 0 on empty input, NULL conditions not counted."""
    return F.count_if(cond).cast("bigint")
