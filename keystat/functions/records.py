"""Records in text lines: comma-separated fields, unquoted and quoted, as column expressions.

The readers and the queries over text columns share them, so a line parses alike wherever
it comes from.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keystat.functions.text import java_split

QUOTE = '"'
#: How a quoted record is written and read: a quote within a field is doubled.
QUOTED_OPTIONS = {"sep": ",", "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE"}


def comma_fields(line: Column | str) -> Column:
    """The fields of an unquoted line: cut at every comma, empty fields at the end
    dropped (so an empty last field and a short line are the same)."""
    return java_split(line, ",")


def field_at(fields: Column, place: int) -> Column:
    """The field at a place (from 0), NULL past the end."""
    return F.get(fields, F.lit(place))


def comma_line(*fields: Column) -> Column:
    """An unquoted line of fields, NULL being empty."""
    return F.concat_ws(",", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def quoted_line(*fields: Column) -> Column:
    """A line of quoted fields: quotes doubled, commas and line ends kept; NULL is an
    empty field without quotes."""
    def quoted(f: Column) -> Column:
        text = f.cast("string")
        return F.coalesce(F.concat(F.lit(QUOTE), F.replace(text, F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE)), F.lit(""))

    return F.concat_ws(",", *[quoted(f) for f in fields])


def quoted_fields(line: Column | str, schema: str) -> Column:
    """A struct of a quoted line's fields (``schema`` as DDL, all text): doubled quotes are one, commas and
    line ends within quotes belong to the field. A short line's missing fields are NULL."""
    return F.from_csv(line, schema, QUOTED_OPTIONS)
