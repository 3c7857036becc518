"""Numeric display helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def ceil_avg(c: Column) -> Column:
    return F.ceil(F.avg(c)).cast("long")


def kpi_int(c: Column) -> Column:
    """Display value: NULL -> 0, integer."""
    return F.coalesce(c, F.lit(0)).cast("long")


def kpi_decimal(c: Column, scale: int = 1) -> Column:
    """Display value: NULL -> 0, rounded to ``scale`` decimals."""
    return F.round(F.coalesce(c.cast("double"), F.lit(0.0)), scale)
