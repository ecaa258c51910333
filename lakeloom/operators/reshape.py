"""Reshape and time-series operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.dates import week_end_sunday


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def pivot(df: DataFrame, index, columns: str, values: str, pivot_values: Sequence,
          agg: str = "sum") -> DataFrame:
    """Pivot table. ``pivot_values`` fixes the output schema and saves a job
    that discovers the values; a value of ``columns`` that is not listed (NULL
    included, unless listed) raises when the result is read, so no row is
    dropped in silence. Missing cells are NULL."""
    fn = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
          "count": F.count, "first": F.first}[agg]
    return _listed(df, columns, pivot_values).groupBy(*_cols(index)).pivot(columns, list(pivot_values)).agg(fn(values))


def _listed(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """``df`` whose ``column`` raises on a value that is not in ``values``."""
    c, known = F.col(column), [v for v in values if v is not None]
    listed = c.isin(known) if None not in values else c.isNull() | c.isin(known)
    unlisted = F.raise_error(F.concat(F.lit(f"pivot: {column} has a value that is not listed: "), F.coalesce(c.cast("string"), F.lit("NULL"))))
    return df.withColumn(column, F.when(F.coalesce(listed, F.lit(False)), c).otherwise(unlisted.cast(df.schema[column].dataType)))


def unstack(df: DataFrame, index, level: str, values: str, level_values: Sequence) -> DataFrame:
    """Move one key level to columns. Like pandas, duplicate
    ``(index, level)`` entries are an error: the result carries a check
    column that raises when any cell would hold more than one value."""
    idx = _cols(index)
    df = _listed(df, level, level_values)
    checked = df.groupBy(*idx, level).agg(F.count(F.lit(1)).alias("_n"), F.first(values).alias(values))
    checked = checked.withColumn(values, F.when(
        F.col("_n") == 1, F.col(values)).otherwise(
        F.raise_error(F.lit("unstack: index has duplicate entries"))))
    return checked.groupBy(*idx).pivot(level, list(level_values)).agg(F.first(values))


def stack(df: DataFrame, index, value_cols: Sequence[str], var_name: str = "variable",
          value_name: str = "value", dropna: bool = True) -> DataFrame:
    """Columns to rows (pandas ``stack`` drops NULL cells by default)."""
    out = df.unpivot(_cols(index), list(value_cols), var_name, value_name)
    return out.where(F.col(value_name).isNotNull()) if dropna else out


def resample_weekly(df: DataFrame, date_col: str, value_cols: Sequence[str], how: str = "mean",
                    by=None, fill_gaps: bool = True, out_col: str = "week_end") -> DataFrame:
    """pandas ``resample('W')``: weeks end on Sunday and are labelled by that
    Sunday. With ``fill_gaps`` empty weeks between the first and last week
    of each group appear with NULL values."""
    fn = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[how]
    by = _cols(by)
    weekly = (df.withColumn(out_col, week_end_sunday(F.col(date_col)))
              .groupBy(*by, out_col).agg(*[fn(c).alias(c) for c in value_cols]))
    if not fill_gaps:
        return weekly
    bounds = weekly.groupBy(*by).agg(F.min(out_col).alias("_a"), F.max(out_col).alias("_b"))
    grid = bounds.select(*by, F.explode(F.sequence("_a", "_b", F.expr("interval 7 days"))).alias(out_col))
    return grid.join(weekly, by + [out_col], "left")


def key_grid(dims: Sequence[DataFrame]) -> DataFrame:
    """All combinations of the distinct rows of each frame, of any number: few
    are broadcast, many are combined block by block."""
    from lakeloom.operators.joins import cross_product
    grid = dims[0].distinct()
    for d in dims[1:]:
        grid = cross_product(grid, d.distinct())
    return grid


def with_expression(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Row-wise function over several columns as an expression."""
    return df.withColumn(name, expr)
