"""String functions: Java-compatible splitting and the legacy text renderings.

All of these are built-in Spark expressions (no Python UDF), so they stay in
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original output for identical results.
NO_GENRES = "(no genres listed)"          # genre of a movie without a genres cell
DECIMAL_PATTERN = "#.################"    # DecimalFormat pattern of the genre report
DOUBLE_MAX_VALUE = 1.7976931348623157e308  # Double.MAX_VALUE: start value of the min loop
DOUBLE_MIN_VALUE = 4.9e-324               # Double.MIN_VALUE: start value of the max loop


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def java_split(s: Column | str, sep_regex: str) -> Column:
    """``String.split(regex)`` with Java's limit-0 rule: trailing empty
    strings are removed, leading and inner ones kept; ``""`` gives ``[""]``
    and an input made only of separators gives ``[]``.
    """
    s = _col(s)
    trimmed = F.regexp_replace(s, f"(?:{sep_regex})+$", "")
    return (F.when(s.isNull(), F.lit(None))
            .when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, sep_regex)))


def split_pipes(s: Column | str) -> Column:
    return java_split(s, "[|]")


def float_text(x: Column | str) -> Column:
    """Text of ``(float) x`` as ``Float.toString`` writes it (``11.0``,
    ``1.23456788E10``, ``NaN``, ``Infinity``)."""
    return _col(x).cast("float").cast("string")


def decimal_text(x: Column | str) -> Column:
    """``DecimalFormat("#.################").format(x)``; NULL becomes ``NaN``."""
    formatted = F.call_function("format_number", _col(x).cast("double"), F.lit(DECIMAL_PATTERN))
    return F.coalesce(formatted, F.lit("NaN"))


def pair_line(key: Column | str, text: Column) -> Column:
    """``Tuple2.toString``: ``(key,text)``."""
    return F.concat(F.lit("("), _col(key), F.lit(","), text, F.lit(")"))
