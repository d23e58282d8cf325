"""Rates as columns, usable in ``select`` and ``agg`` alike."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded; 0.0 when there is nothing to divide by."""
    return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), digits)


def share_true(flag: str, digits: int = 4) -> Column:
    """Share of the rows in which ``flag`` is true; NULL counts as not true."""
    return F.round(F.avg(F.when(F.col(flag), 1).otherwise(0)), digits)
