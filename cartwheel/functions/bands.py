"""Threshold bands and value maps of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwheel import constants as C


def _banded(value: Column, bands) -> Column:
    expr = None
    default = None
    for bound, colour in bands:
        if bound is None:
            default = F.lit(colour)
            continue
        cond = value >= F.lit(bound)
        expr = F.when(cond, F.lit(colour)) if expr is None else expr.when(cond, F.lit(colour))
    return expr.otherwise(default) if expr is not None else default


def alert_count_status(count: Column) -> Column:
    """0 green, >= 1 orange, >= 5 red."""
    return _banded(count, C.ALERT_COUNT_BANDS)


def conversion_status(rate: Column) -> Column:
    """< 0.05 red, < 0.15 orange, >= 0.15 green."""
    return _banded(rate, C.CONVERSION_BANDS)


def segment_colour(segment: Column) -> Column:
    expr = None
    for name, colour in C.SEGMENT_COLOURS:
        cond = segment == F.lit(name)
        expr = F.when(cond, F.lit(colour)) if expr is None else expr.when(cond, F.lit(colour))
    return expr
