"""Table-level NULL handling.

Profiles are one aggregate pass over all columns; fills with a statistic
compute a one-row aggregate first and use its values as literals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions.nulls import any_null, no_null


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, scale: int | None = 2) -> DataFrame:
    """One row per column: rows, nulls, non-nulls and null percent.
    A single aggregate pass computes every count."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
                               for i, c in enumerate(cols)]))
    pct = F.col("nulls") * 100.0 / F.col("rows")
    return (agg.select(F.col("_rows").alias("rows"), stack)
            .select("column", "rows", "nulls", (F.col("rows") - F.col("nulls")).alias("non_nulls"),
                    (F.round(pct, scale) if scale is not None else pct).alias("null_pct")))


def fill(df: DataFrame, value=None, subset: Sequence[str] | None = None,
         mapping: Mapping[str, object] | None = None) -> DataFrame:
    """``fillna`` by constant (columns of a matching type only) or dict."""
    if mapping is not None:
        return df.fillna(dict(mapping))
    return df.fillna(value, subset=list(subset) if subset else None)


def fill_with_stat(df: DataFrame, cols: Sequence[str], stat: str = "mean") -> DataFrame:
    """Fill NULLs with the column mean or (exact) median; one number a column
    comes back as a literal. All columns' medians come from one percentile pass
    over (column, value) rows. An integer column whose statistic has a fraction becomes double, as in pandas."""
    if stat == "median":
        from lakeloom.operators.quantiles import exact_median
        stacked = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_column", "_value")
        found = exact_median(stacked, "_value", ["_column"]).collect()  # one row a column
        values = {c: None for c in cols} | {r["_column"]: r["median"] for r in found}
    else:
        values = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    whole = ("tinyint", "smallint", "int", "bigint")
    types = dict(df.dtypes)
    for c in cols:
        if values[c] is not None:
            value = float(values[c])
            kept = F.col(c).cast("double") if types[c] in whole and not value.is_integer() else F.col(c)
            df = df.withColumn(c, F.coalesce(kept, F.lit(int(value) if types[c] in whole and value.is_integer() else value)))
    return df


def drop_null_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None,
                   thresh: int | None = None) -> DataFrame:
    return df.dropna(how=how, thresh=thresh, subset=list(subset) if subset else None)


def drop_null_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """Drop columns holding any (or only) NULLs, found in one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    rows = row["_rows"]
    drop = [c for c in df.columns if (row[c] > 0 if how == "any" else row[c] == rows and rows > 0)]
    return df.drop(*drop)


def rows_with_any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.where(any_null(list(cols or df.columns)))


def rows_without_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.where(no_null(list(cols or df.columns)))


def null_indicators(df: DataFrame, cols: Sequence[str], suffix: str = "_is_null") -> DataFrame:
    for c in cols:
        df = df.withColumn(f"{c}{suffix}", F.when(F.col(c).isNull(), 1).otherwise(0))
    return df


def treat_nulls(df: DataFrame, threshold_pct: float, numeric_fill: str = "mean",
                text_fill: str = "unknown") -> tuple[DataFrame, list[str]]:
    """Drop columns whose null percent is >= ``threshold_pct``; fill the
    others (numeric with mean/median, text with ``text_fill``).
    Returns the treated frame and the dropped column names."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    rows = row["_rows"] or 1
    dropped = [c for c in df.columns if row[c] * 100.0 / rows >= threshold_pct]
    kept = df.drop(*dropped)
    numeric = [f.name for f in kept.schema.fields
               if isinstance(f.dataType, T.NumericType) and row[f.name] > 0]
    text = [f.name for f in kept.schema.fields
            if isinstance(f.dataType, T.StringType) and row[f.name] > 0]
    if numeric:
        kept = fill_with_stat(kept, numeric, numeric_fill)
    if text:
        kept = kept.fillna(text_fill, subset=text)
    return kept, dropped
