"""Profiling, data quality and audit (Q1-Q12).

Checks return DataFrames (one row per check/table/column) rather than
printing, so they can be stored as audit tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.aggregates import describe_by
from lakeloom.operators._store import small_side, stored, stored_side
from lakeloom.operators.quantiles import exact_percentiles


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# Q1 / Q2 ----------------------------------------------------------------
def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """pandas-style describe with exact quartiles, one row per column.
    The columns are stacked into ``(column, value)`` rows so one grouped
    aggregate and one percentile pass serve all of them."""
    cols = list(cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    stacked = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value")
    return describe_by(stacked, "value", "column")


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by=None, approx: bool = False) -> DataFrame:
    if approx:
        from lakeloom.operators.quantiles import approx_percentiles
        return approx_percentiles(df, col, probs, _cols(by))
    return exact_percentiles(df, col, probs, _cols(by))


def _attach(df: DataFrame, stats: DataFrame, by: list[str]) -> DataFrame:
    """Attach per-group statistics to every row; with no group the single row
    comes in as literals. Give statistics with a broadcast hint where they are
    counted to be few, so that rows are not shuffled to a few keys."""
    if by:
        from lakeloom.operators.joins import join
        return join(df, stats, by, "inner", null_safe=True)
    row = stats.first()
    if row is None:
        return df.select("*", *[F.lit(None).alias(c) for c in stats.columns]).where(F.lit(False))
    return df.select("*", *[F.lit(row[c]).alias(c) for c in stats.columns])


# Q3 ---------------------------------------------------------------------
def iqr_bounds(df: DataFrame, col: str, by=None, k: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, IQR and the ``k``-IQR fences per group (exact by default;
    ``approx=True`` uses a bounded sketch for very large groups)."""
    if approx:
        from lakeloom.operators.quantiles import approx_percentiles
        q = approx_percentiles(df, col, [0.25, 0.75], _cols(by), ["q1", "q3"])
    else:
        q = exact_percentiles(df, col, [0.25, 0.75], _cols(by), ["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return (q.withColumn("iqr", iqr)
            .withColumn("lower", F.col("q1") - k * iqr)
            .withColumn("upper", F.col("q3") + k * iqr))


def iqr_outliers(df: DataFrame, col: str, by=None, k: float = 1.5, flag_only: bool = False,
                 approx: bool = False) -> DataFrame:
    """Rows outside ``[Q1 - k*IQR, Q3 + k*IQR]`` (per group when ``by``).
    The bounds are a small per-group table joined on the group key."""
    by = _cols(by)
    out = _attach(df, iqr_bounds(df, col, by, k, approx).select(*by, "lower", "upper"), by)
    flag = (F.col(col) < F.col("lower")) | (F.col(col) > F.col("upper"))
    if flag_only:
        return out.withColumn("is_outlier", flag).drop("lower", "upper")
    return out.where(flag).drop("lower", "upper")


# Q4 ---------------------------------------------------------------------
def histogram(df: DataFrame, col: str, bins: int, by=None) -> DataFrame:
    """Equal-width bins between the column min and max (numpy/pandas
    ``hist``: the maximum belongs to the last bin). Returns bin number
    (1..bins), its edges and the count."""
    by = _cols(by)
    mm = df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = F.col(col).cast("double")
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((x - lo) / width).cast("int") + 1, F.lit(bins)))
    joined = _attach(df.where(F.col(col).isNotNull()), stored_side(mm, "ranges") if by else mm, by)
    counted = joined.withColumn("bin", b).groupBy(*by, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(*by, "bin", (F.col("_lo") + (F.col("bin") - 1) * w).alias("bin_start"),
                          (F.col("_lo") + F.col("bin") * w).alias("bin_end"), "count")


# Q5 ---------------------------------------------------------------------
def box_stats(df: DataFrame, col: str, by=None, k: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers (most extreme values
    inside the fences) and outlier count."""
    by = _cols(by)
    if not by:
        return box_stats(df.withColumn("_all", F.lit(0)), col, ["_all"], k).drop("_all")
    b = stored_side(iqr_bounds(df, col, by, k), "fences")
    j = _attach(df, b, by)
    x = F.col(col)
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    stats = j.groupBy(*by).agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(x.isNotNull() & ~inside).alias("n_outliers"))
    from lakeloom.operators.joins import join
    return join(b, stats, by, "inner", null_safe=True)


# Q6 ---------------------------------------------------------------------
def grouped_mean(df: DataFrame, x: str, y: str, hue: str | None = None, out: str | None = None) -> DataFrame:
    return df.groupBy(*([x] + ([hue] if hue else []))).agg(F.avg(y).alias(out or f"mean_{y}"))


# Q7 ---------------------------------------------------------------------
# Integer type limits (two's complement) and float32 range.
INT_RANGES = [("tinyint", -128, 127), ("smallint", -32768, 32767),
              ("int", -2147483648, 2147483647), ("bigint", -9223372036854775808, 9223372036854775807)]
FLOAT32_MAX = 3.4028234663852886e38


def suggest_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Smallest safe type per numeric column from its min/max. Integral
    columns get the narrowest integer type; fractional columns are
    ``float`` only when every value survives a float32 round trip."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols or [c for c, t in fields.items() if isinstance(t, T.NumericType)])
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
        if isinstance(fields[c], (T.FloatType, T.DoubleType, T.DecimalType)):
            x = F.col(c).cast("double")
            aggs.append(F.count_if(x.cast("float").cast("double") != x).alias(f"lossy{i}"))
    stats = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        mn, mx = F.col(f"mn{i}"), F.col(f"mx{i}")
        if isinstance(fields[c], T.IntegralType):
            expr = None
            for name, lo, hi in INT_RANGES:
                cond = (mn >= lo) & (mx <= hi)
                expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
            expr = expr.otherwise(F.lit("bigint"))
        else:
            fits = (F.abs(mn.cast("double")) <= FLOAT32_MAX) & (F.abs(mx.cast("double")) <= FLOAT32_MAX)
            expr = F.when(fits & (F.col(f"lossy{i}") == 0), F.lit("float")).otherwise(F.lit("double"))
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(fields[c].simpleString()).alias("current_type"),
                             mn.cast("double").alias("min"), mx.cast("double").alias("max"),
                             expr.alias("suggested_type")))
    return stats.select(F.inline(F.array(*rows)))


# Q8-Q10 -----------------------------------------------------------------
def _each(spark: SparkSession, rows: list[DataFrame], schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for r in rows:
        out = out.unionAll(r)
    return out


def validate_load(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Row count and SUCCESS/FAILED per table. A table that cannot be opened
    does not stop the others and carries the whole error text. All counts are
    one lazy union of aggregates, so they run side by side."""
    schema = "table_name string, status string, row_count long, error string"
    rows = []
    for name, load in tables.items():
        try:
            rows.append(load().agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(name), F.lit("SUCCESS"), "n", F.lit(None).cast("string")))
        except Exception as e:  # noqa: BLE001 - record the failure
            rows.append(spark.createDataFrame([(name, "FAILED", None, str(e))], schema))
    return _each(spark, rows, schema)


def audit(spark: SparkSession, tables: Mapping[str, DataFrame], run_ts: _dt.datetime,
          layer: str, date_cols: Mapping[str, str] | None = None) -> DataFrame:
    """Audit rows: table, layer, rows, status, max business date (when a
    date column is named) and the run timestamp, as one lazy union of one
    aggregate per table. A table without its date column is FAILED."""
    # wall-clock (NTZ) timestamps: the audit reads the same in any session zone
    schema = ("table_name string, layer string, row_count long, status string, "
              "max_business_ts timestamp_ntz, run_ts timestamp_ntz")
    stamp = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    rows = []
    for name, df in tables.items():
        day = (date_cols or {}).get(name)
        failed = day is not None and day not in df.columns
        newest = F.max(day).cast("timestamp_ntz") if day and not failed else F.lit(None).cast("timestamp_ntz")
        one = df.agg(F.count(F.lit(1)).alias("n"), newest.alias("newest"))
        rows.append(one.select(F.lit(name), F.lit(layer), F.when(F.lit(not failed), F.col("n")),
                               F.lit("FAILED" if failed else "SUCCESS"), "newest", stamp))
    return _each(spark, rows, schema)


# Q11 --------------------------------------------------------------------
def key_checks(df: DataFrame, pk: Sequence[str], not_null: Sequence[str] = (),
               fks: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """Constraint report: duplicate primary keys, NULLs in NOT NULL columns
    and orphan foreign keys (anti join). One row per check with the number
    of violating rows."""
    spark = df.sparkSession
    pk = list(pk)
    dup = (df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
           .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations"))
           .select(F.lit("primary_key").alias("check"), F.lit(",".join(pk)).alias("column"), "violations"))
    checks = [dup]
    cols = list(dict.fromkeys(list(not_null) + pk))
    nn = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    checks.append(nn.select(F.inline(F.array(*[F.struct(
        F.lit("not_null").alias("check"), F.lit(c).alias("column"),
        F.col(f"n{i}").cast("long").alias("violations")) for i, c in enumerate(cols)]))))
    for col, parent, parent_col in fks:
        orphans = (df.where(F.col(col).isNotNull())
                   .join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")
                   .agg(F.count(F.lit(1)).cast("long").alias("violations"))
                   .select(F.lit("foreign_key").alias("check"), F.lit(col).alias("column"), "violations"))
        checks.append(orphans)
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


# Q12 --------------------------------------------------------------------
def label_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(``col``, ``label_index`` double) of the different labels in ascending
    order, numbered from 0 in ordered segments and stored: however many labels
    there are, none come to the driver."""
    from lakeloom.operators.windows import row_positions
    labels = stored(df.select(col).where(F.col(col).isNotNull()).distinct(), "labels")
    return stored(row_positions(labels, [col], "_at").select(col, F.col("_at").cast("double").alias("label_index")), "dictionary")


def _labelled(df: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with the label's number, a NULL label having the number of labels."""
    dictionary = label_dictionary(df, col)
    side = small_side(dictionary.withColumnsRenamed({col: "_label", "label_index": out}))
    known = df.drop(out).join(side, F.col(col) == F.col("_label"), "left").drop("_label")
    return known.fillna({out: float(dictionary.count())}), dictionary


def _encoded(df: DataFrame, one_hot: bool, col: str, out: str | None = None) -> DataFrame:
    if not one_hot:
        return _labelled(df, col, out or f"{col}_idx")[0]
    from pyspark.ml import feature as MF
    result, dictionary = _labelled(df, col, "_index")
    encoder = MF.OneHotEncoder(inputCol="_index", outputCol=out or f"{col}_ohe", handleInvalid="keep")
    return encoder.fit(dictionary.select(F.col("label_index").alias("_index"))).transform(result).drop("_index")


def _on_vector(df: DataFrame, cols: Sequence[str], stage, invalid: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml import feature as MF
    vector = MF.VectorAssembler(inputCols=list(cols), outputCol="_features", handleInvalid=invalid)
    return Pipeline(stages=[vector, stage(MF)]).fit(df).transform(df).drop("_features")


def _scaled(df: DataFrame, cols: Sequence[str], kind: str = "standard", out: str = "scaled") -> DataFrame:
    names = {"inputCol": "_features", "outputCol": out}
    return _on_vector(df, cols, lambda m: m.MinMaxScaler(**names) if kind == "minmax" else
                      m.StandardScaler(withMean=True, withStd=True, **names), "keep")


def _engineered(df: DataFrame, transforms: Mapping[str, str]) -> DataFrame:
    from lakeloom.functions.math import feature_transform
    return df.select("*", *[feature_transform(c, kind).alias(f"{c}_{kind}") for c, kind in transforms.items()])


def _selected(df: DataFrame, cols: Sequence[str], threshold: float = 0.0, out: str = "selected") -> DataFrame:
    return _on_vector(df, cols, lambda m: m.VarianceThresholdSelector(
        featuresCol="_features", outputCol=out, varianceThreshold=threshold), "error")


def _without_sparse_columns(df: DataFrame, threshold_pct: float = 50.0) -> DataFrame:
    from lakeloom.operators.nulls import treat_nulls
    return treat_nulls(df, threshold_pct)[0]


def _filled(df: DataFrame, value=0, subset=None) -> DataFrame:
    from lakeloom.operators.nulls import fill
    return fill(df, value, subset)


# The preprocessing step names, and what each one runs.
PREPROCESSING = {
    "null_values": _without_sparse_columns,
    "outliers": lambda df, col, by=None, k=1.5: iqr_outliers(df, col, by, k, flag_only=True),
    "missing_values": _filled,
    "data_quality_checks": lambda df, pk, not_null=(): key_checks(df, pk, not_null),
    "label_encoding": lambda df, col, out=None: _encoded(df, False, col, out),
    "one_hot_encoding": lambda df, col, out=None: _encoded(df, True, col, out),
    "feature_scaling": _scaled,
    "feature_engineering": _engineered,
    "feature_selection": _selected,
    "train_test_split": lambda df, weights=(0.8, 0.2), seed=42: df.randomSplit(list(weights), seed=seed),
}


def pre_processing(df: DataFrame, step: str, **options):
    """Run one preprocessing step; ``options`` are that step's parameters."""
    if step not in PREPROCESSING:
        raise ValueError(f"unknown preprocessing step {step!r}; expected one of {tuple(PREPROCESSING)}")
    return PREPROCESSING[step](df, **options)
