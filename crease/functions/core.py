"""Generic expression helpers shared by the statistics and the live operators."""

from __future__ import annotations

import functools

from pyspark.errors import PySparkAttributeError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def built_once(fn):
    """Build a set of column expressions once per Spark application.

    Expressions that name columns (not DataFrames) can be reused by every
    DataFrame; building them costs one JVM round trip per function call, which
    adds up for the wide live-snapshot projections.  Keyed by application, so
    a new session rebuilds them; without a classic SparkContext (a client
    session) they are cheap and simply rebuilt.
    """
    built: dict = {}

    @functools.wraps(fn)
    def wrapper():
        session = SparkSession.getActiveSession()
        try:
            key = session.sparkContext.applicationId if session is not None else None
        except PySparkAttributeError:  # a client session
            key = None
        if key is None:
            return fn()
        if key not in built:
            built[key] = fn()
        return built[key]

    return wrapper


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_default(c: str | Column, value) -> Column:
    """``c`` or a literal default when null (the reference's coalesce-to-literal)."""
    return F.coalesce(col_or(c), F.lit(value))


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; null instead of a DIVIDE_BY_ZERO error under ANSI."""
    return F.try_divide(col_or(num).cast("double"), col_or(den))


def percentage(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``round((num / den) * 100, scale)`` in that evaluation order."""
    return F.round(ratio(num, den) * F.lit(100), scale)


def count_if(cond: Column) -> Column:
    """``sum(when(cond, 1).otherwise(0))`` -- a conditional count (bigint)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def first_element(arr: str | Column) -> Column:
    """Element 0 of an array, null when the array is null or empty (never raises)."""
    return F.get(col_or(arr), 0)


def short_id(c: str | Column) -> Column:
    """A text id as bytes that differ where the ids do, to group by: the 32 hex digits
    that a content id begins with as 16 bytes, which nearly halves what is shuffled, and
    what follows as it is; any other text as it is, after another first byte."""
    c = col_or(c)
    short = F.concat(F.lit(b"\x00"), F.unhex(F.substr(c, F.lit(1), F.lit(32))), F.substr(c, F.lit(33)).cast("binary"))
    return F.when(c.rlike("^[0-9a-f]{32}"), short).otherwise(F.concat(F.lit(b"\x01"), c.cast("binary")))
