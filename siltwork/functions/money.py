"""Sums and averages of amounts in whole cents, which any order of addition leaves equal."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(c: Column) -> Column:
    return F.round(c.cast("decimal(18,2)") * 100).cast("long")


def total(c: Column) -> Column:
    """Aggregate: the sum, exact to the cent."""
    return F.sum(cents(c)).cast("double") / 100


def average(c: Column) -> Column:
    """Aggregate: the mean, rounded half up to the cent, away from zero for negative sums."""
    s, n = F.sum(cents(c)), F.count(c)
    return F.signum(s.cast("double")) * F.floor((2 * F.abs(s) + n).cast("double") / (2 * n).cast("double")) / 100
