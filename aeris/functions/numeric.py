"""Rounding.

Spark's ``round`` on a double is HALF_UP on the decimal text of the double;
other engines round the binary value, so ties such as 23.385 can differ. For
results that must agree with an outside engine we round through a decimal
first (``decimal(38,6)``), which makes both sides round the same decimal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """Spark's own ``round`` (the original job's behaviour)."""
    return F.round(c, digits)


def stable_round(c: Column, digits: int) -> Column:
    """Round through ``decimal(38,6)`` and return a double."""
    return F.round(c.cast("double").cast("decimal(38,6)"), digits).cast("double")


def rounder(exact: bool):
    """Pick the rounding used by an operator: ``exact=True`` → ``stable_round``."""
    return stable_round if exact else round_half_up
