"""Order-keeping binary form of cell keys and versions.

A byte-ordered store sorts by bytes alone. Here texts and versions become bytes whose order is
theirs, and back, by built-in expressions:

* a text is its UTF-8 bytes, a NUL within it followed by 01, and ends with 00 00: no text's bytes
  begin another's, a shorter text sorts before its continuations, and fields written one
  after another sort field by field;
* a version text sorts as :func:`keystat.operators.cells.version_key`: digits only above all
  others, by their number, however long; then by the text itself;
* a long is eight bytes with the sign bit turned over.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the format.
NUL = "\x00"
END = NUL + NUL
ESCAPED = NUL + "\x01"


def text_key(*texts: Column) -> Column:
    """Bytes of the texts, one after another; NULL if one is NULL."""
    parts = [F.concat(F.replace(t, F.lit(NUL), F.lit(ESCAPED)), F.lit(END)) for t in texts]
    return F.encode(F.concat(*parts), "UTF-8")


def key_texts(key: Column, n: int) -> list[Column]:
    """The ``n`` texts of a :func:`text_key`."""
    fields = F.split(F.decode(key, "UTF-8"), END)
    return [F.replace(F.get(fields, F.lit(i)), F.lit(ESCAPED), F.lit(NUL)) for i in range(n)]


def long_key(x: Column) -> Column:
    """Eight bytes in the order of the number."""
    return F.unhex(F.lpad(F.hex(x.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def key_long(key: Column) -> Column:
    """The number of a :func:`long_key`."""
    high, low = (F.conv(F.hex(F.substring(key, i, 4)), 16, 10).cast("long") for i in (1, 5))
    return F.shiftleft(high, 32).bitwiseOR(low).bitwiseXOR(F.lit(-(1 << 63)))
