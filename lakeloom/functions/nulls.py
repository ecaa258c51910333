"""NULL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col, lit_or_col


def nvl(c, default) -> Column:
    return F.coalesce(as_col(c), lit_or_col(default))


def coalesce(*cols) -> Column:
    return F.coalesce(*[as_col(c) if isinstance(c, str) else lit_or_col(c) for c in cols])


def nvl2(c, if_not_null, if_null) -> Column:
    return F.nvl2(as_col(c), lit_or_col(if_not_null), lit_or_col(if_null))


def nullif(c, value) -> Column:
    return F.nullif(as_col(c), lit_or_col(value))


def when_null(c, value) -> Column:
    c = as_col(c)
    return F.when(c.isNull(), lit_or_col(value)).otherwise(c)


def null_indicator(c) -> Column:
    """1 when NULL, else 0."""
    return F.when(as_col(c).isNull(), 1).otherwise(0)


def any_null(cols: Sequence[str]) -> Column:
    """True when at least one of the columns is NULL."""
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def no_null(cols: Sequence[str]) -> Column:
    """True when none of the columns is NULL (AND over all of them)."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out
