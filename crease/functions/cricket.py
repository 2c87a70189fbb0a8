"""Delivery-level expressions: wicket flag and wicket description."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crease.functions.core import col_or


def has_elements(arr: str | Column) -> Column:
    """True when the array is non-null and non-empty (same under ANSI on or off)."""
    a = col_or(arr)
    return a.isNotNull() & (F.size(a) > 0)


def wicket_flag(wickets: str | Column) -> Column:
    """1 when the delivery carries at least one wicket, else 0 (once per ball)."""
    return F.when(has_elements(wickets), F.lit(1)).otherwise(F.lit(0))


def wicket_details(wickets: str | Column) -> Column:
    """``"player - kind"`` per wicket joined by ``", "``; null when no wicket.

    An element with a null part yields null from ``concat`` and is skipped by
    ``concat_ws``, so a lone wicket with a null kind gives an empty string.
    """
    w = col_or(wickets)
    described = F.transform(w, lambda x: F.concat(x["player_out"], F.lit(" - "), x["kind"]))
    return F.when(has_elements(w), F.concat_ws(", ", described)).otherwise(F.lit(None).cast("string"))
