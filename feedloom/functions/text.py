"""Small null/empty helpers used by every Column builder.

Definitions treat a value as true when it is a non-empty string; Spark ``concat``
returns null if any input is null. ``s`` and ``truthy`` keep both rules in one place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def lit_str(x) -> Column:
    """A literal string Column (many 4.x functions read bare strings as column names)."""
    return x if isinstance(x, Column) else F.lit(x)


def s(c) -> Column:
    """null -> ''."""
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def nz(c) -> Column:
    """'' -> null."""
    c = col_of(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def truthy(c) -> Column:
    """Non-null, non-empty text is true (the template truth rule)."""
    return s(c) != F.lit("")


def let(value, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value worked out once a row, however often ``of`` names it: a Column
    named twice is an expression that Spark may run twice, and one built in steps doubles with each."""
    return F.transform(F.array(col_of(value)), of)[0]
