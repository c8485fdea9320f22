"""Banding and exactly rounded ratios."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(c: Column, bounds: Sequence, labels: Sequence[str], null_label: str) -> Column:
    """Label of the first bound the value lies below; the last label has no bound."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label per bound and one for the rest")
    out = F.when(c.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        out = out.when(c < F.lit(bound), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def ratio(total: Column, n: Column, digits: int) -> Column:
    """total / n in decimal arithmetic, rounded half away from zero; NULL when n is 0."""
    return F.round(total / F.nullif(n, F.lit(0)).cast("decimal(18,0)"), digits)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole, rounded half away from zero; NULL when whole is 0."""
    return ratio(F.lit(Decimal("100.0")) * part.cast("decimal(18,0)"), whole, digits)
