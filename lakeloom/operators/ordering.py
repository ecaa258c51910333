"""Sort, limit and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.operators._order import as_specs, sort_key, sort_keys


def sort(df: DataFrame, order_by) -> DataFrame:
    """Distributed sort. Spark's default NULL order is first for ascending
    and last for descending; pass Columns such as
    ``F.col('x').desc_nulls_last()`` to state it explicitly."""
    return df.orderBy(*sort_keys(order_by))


def top_k(df: DataFrame, order_by, k: int, tie_break=None) -> DataFrame:
    """First ``k`` rows by ``order_by`` plus tie-break keys (planned as
    ``TakeOrderedAndProject``: each task keeps its own k best)."""
    keys = sort_keys(order_by) + (sort_keys(tie_break) if tie_break else [])
    return df.orderBy(*keys).limit(k)


def head(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    return df.orderBy(*sort_keys(order_by)).limit(n)


def tail(df: DataFrame, order_by, n: int = 5) -> DataFrame:
    """Last ``n`` rows under ``order_by`` (returned in that order)."""
    rev = []
    for s in as_specs(order_by):
        if isinstance(s, str):
            rev.append(F.col(s).desc_nulls_last())
        elif isinstance(s, tuple):
            rev.append(F.col(s[0]).asc_nulls_first() if s[1].lower().startswith("desc")
                       else F.col(s[0]).desc_nulls_last())
        else:
            raise TypeError("tail needs column names or (name, direction)")
    return df.orderBy(*rev).limit(n).orderBy(*sort_keys(order_by))


def sort_by_length(df: DataFrame, col: str, descending: bool = False) -> DataFrame:
    key = F.length(col)
    return df.orderBy(key.desc() if descending else key.asc(), F.col(col))


def sort_case_insensitive(df: DataFrame, col: str) -> DataFrame:
    return df.orderBy(F.lower(col), F.col(col))
