"""Shared helpers for the named reports.

Money columns in the test tables are doubles holding cents. Sums are taken in
whole units (bigint halves, put together as DECIMAL once a group) and only then
turned into double; averages are that exact sum divided by the count. Both keep
results identical however the rows are split over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.aggregates import exact_sum

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register a report under ``name`` with its equivalent SQL text (run
    by an independent engine as the oracle), or ``None`` when no SQL
    equivalent exists."""
    def deco(fn):
        if name in REGISTRY:
            raise KeyError(f"duplicate report {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def alias(name: str, target: str) -> None:
    """Register an inventory id that is answered by an existing report."""
    REGISTRY[name] = REGISTRY[target]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(18,2)")


def cents(c, scale: int = 2) -> Column:
    """A money double (at most ``scale`` decimals) as an exact integer count
    of ``10**-scale`` units. Integer sums are exact, independent of how rows
    are split over tasks, and far cheaper than DECIMAL sums (whose wide
    buffers fall back to BigDecimal arithmetic)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c * (10 ** scale)).cast("long")


def dsum(c, scale: int = 2) -> Column:
    """Exact sum of a money column, as double (the exact total, correctly
    rounded once)."""
    return exact_sum(cents(c, scale)).cast("double") / float(10 ** scale)


def total(c: str) -> Column:
    """Sum of partial sums (bigint or DECIMAL) as DECIMAL(38,0)."""
    return F.sum(F.col(c).cast("decimal(38,0)"))


def davg(c, scale: int = 2) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return dsum(c, scale) / F.count(c)


def net_units() -> Column:
    """Discounted line amount ``extendedprice * (1 - discount)`` in exact
    1e-4 units (cents times discount percent points)."""
    return cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))


def net_price() -> Column:
    """Discounted line amount as double (exact value, rounded once)."""
    return net_units() / 1e4


def net_sum() -> Column:
    return exact_sum(net_units()).cast("double") / 1e4


# SQL twins of the helpers above
def sql_dsum(expr: str, scale: int = 2) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(18,{scale}))) AS DOUBLE)"


def sql_davg(expr: str, scale: int = 2) -> str:
    return f"({sql_dsum(expr, scale)} / COUNT({expr}))"


SQL_NET = "(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))))"
