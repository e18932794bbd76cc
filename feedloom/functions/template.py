"""Template functions (T1-T9) as Column builders.

Definitions compute fields with a small template language (if/and/or/eq/join/range/
re_replace/variables). Here each construct is a Column expression, so a computed field
is ordinary Catalyst code rather than a string rendered per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col_of, lit_str, nz, s, truthy


def tpl_if(c, a, b) -> Column:
    """``a`` when ``c`` is non-empty text, else ``b``."""
    return F.when(truthy(lit_str(c)), lit_str(a)).otherwise(lit_str(b))


def tpl_and(*cs) -> Column:
    """Every argument non-empty."""
    out = F.lit(True)
    for c in cs:
        out = out & truthy(lit_str(c))
    return out


def tpl_or(*cs, as_value: bool = False) -> Column:
    """As a test, any argument non-empty; as a value, the first non-empty one ('' if none)."""
    if as_value:
        return F.coalesce(*[nz(lit_str(c)) for c in cs], F.lit(""))
    out = F.lit(False)
    for c in cs:
        out = out | truthy(lit_str(c))
    return out


def tpl_eq(a, b) -> Column:
    """T4: text equality; null compares as ''."""
    return s(lit_str(a)) == s(lit_str(b))


def tpl_ne(a, b) -> Column:
    return s(lit_str(a)) != s(lit_str(b))


def tpl_join(arr, sep: str) -> Column:
    """T5: join a list with a separator (nulls skipped)."""
    return F.array_join(col_of(arr), sep)


def tpl_range(arr, fn: Callable[[Column], Column]) -> Column:
    """Render each element with ``fn`` and concatenate."""
    return F.array_join(F.transform(col_of(arr), lambda x: s(fn(x))), "")


def tpl_re_replace(c, pattern: str, replacement: str) -> Column:
    """Inline regex replace."""
    return F.regexp_replace(s(c), pattern, replacement)


def tpl_vars(df: DataFrame, params: dict, as_of=None) -> DataFrame:
    """Make query parameters / settings / today's year available as columns.

    Parameters are literals (folded into the plan), not a joined frame, so nothing
    is shuffled. ``as_of`` supplies ``.Today.Year``.
    """
    cols = {f"param_{k}": F.lit(v) for k, v in params.items()}
    if as_of is not None:
        from .dates import as_of_col

        cols["param_today_year"] = F.year(as_of_col(as_of))
    cols["param_true"] = F.lit("True")
    cols["param_false"] = F.lit("")
    return df.withColumns(cols)


def tpl_concat(*cs) -> Column:
    """Literal text around values; a null value renders as ''."""
    return F.concat(*[s(lit_str(c)) for c in cs])
