"""Aggregate column functions that only look at positive values.

Every statistic of the stock job skips values ``<= 0`` without dropping the
key: a key whose values are all nonpositive still gets a row, with NULL
statistics. Each function returns an ordinary aggregate expression, so it can
be mixed with others in one ``agg`` and runs as a partial (map-side) plus a
final aggregate: state per key is a handful of numbers, never a value list,
so a key holding a third of all rows costs no more memory than any other.

NaN handling follows the original comparisons: ``NaN <= 0`` is false, so NaN
reaches the mean and the variance (which become NaN), while ``NaN < m`` and
``NaN > m`` are false, so min and max ignore it. Spark orders NaN above every
number, so min/max exclude it explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def positive(x: Column | str) -> Column:
    """``x`` where ``x > 0`` (NaN included), else NULL."""
    x = _col(x)
    return F.when(x > 0, x)


def _scaled(x: Column, scale: Column | str | float | None) -> Column:
    if scale is None:
        return x
    k = F.lit(scale) if isinstance(scale, (int, float)) else _col(scale)
    return x * k


def positive_mean(x: Column | str, scale: Column | str | float | None = None) -> Column:
    """Mean of ``x * scale`` over rows with ``x > 0``; NULL if there are none."""
    x = _col(x)
    return F.avg(F.when(x > 0, _scaled(x, scale)))


def positive_min(x: Column | str) -> Column:
    x = _col(x)
    return F.min(F.when((x > 0) & ~F.isnan(x), x))


def positive_max(x: Column | str) -> Column:
    x = _col(x)
    return F.max(F.when((x > 0) & ~F.isnan(x), x))


def positive_var_pop(x: Column | str, scale: Column | str | float | None = None) -> Column:
    """Population variance (divide by n) of ``x * scale`` over ``x > 0``."""
    x = _col(x)
    return F.var_pop(F.when(x > 0, _scaled(x, scale)))


def positive_count(x: Column | str) -> Column:
    x = _col(x)
    return F.count(F.when(x > 0, F.lit(1)))


def is_defined(x: Column | str) -> Column:
    """True when a statistic is neither NULL nor NaN."""
    x = _col(x)
    return x.isNotNull() & ~F.isnan(x)
