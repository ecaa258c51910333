"""Conditional columns, banding and value mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeloom.functions._util import as_col


def case_when(branches: Sequence[tuple[Column, object]], otherwise=None,
              null_value=None, null_check=None) -> Column:
    """``CASE WHEN`` chain. When ``null_check`` is given, NULL input is
    tested first and yields ``null_value`` instead of falling into ELSE."""
    expr = None
    if null_check is not None:
        expr = F.when(as_col(null_check).isNull(), F.lit(null_value))
    for cond, value in branches:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr


def band(c, thresholds: Sequence[tuple[float, str]], top_label: str,
         null_label: str | None = None) -> Column:
    """Banding on ascending upper bounds: ``value < bound -> label``; values
    at or above the last bound get ``top_label``. NULL -> ``null_label``."""
    c = as_col(c)
    branches = [(c < b, label) for b, label in thresholds]
    return case_when(branches, otherwise=top_label, null_value=null_label, null_check=c)


def bucketize(c, edges: Sequence[float], labels: Sequence[str] | None = None,
              right: bool = True) -> Column:
    """pandas ``cut``: intervals ``(lo, hi]`` (``[lo, hi)`` when
    ``right=False``); values outside the edges and NULL give NULL."""
    c = as_col(c)
    if labels is None:
        labels = list(range(len(edges) - 1))
    assert len(labels) == len(edges) - 1, "need one label per interval"
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (c > lo) & (c <= hi) if right else (c >= lo) & (c < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def map_values(c, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup (pandas ``Series.map``); unmapped -> ``default``."""
    if not mapping:
        return F.lit(default)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, as_col(c))
    return F.coalesce(v, F.lit(default)) if default is not None else v


def literal(value, name: str | None = None) -> Column:
    c = F.lit(value)
    return c.alias(name) if name else c
