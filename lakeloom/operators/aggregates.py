"""Aggregation operators.

Aggregates are hash aggregates with partial (map-side) and final stages,
so a hot key is pre-reduced on every task before the shuffle. Where the
aggregate cannot be reduced early (exact distinct counts, collected lists)
``salted_agg`` spreads a hot key first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators._store import stored_side
from lakeloom.operators.quantiles import _pack as pack_key
from lakeloom.operators.quantiles import percentile_table


def _cols(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


# A1-A6 ------------------------------------------------------------------
_AGGS = {
    "count": lambda c: F.count(c),
    "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
    "std": F.stddev_samp, "var": F.var_samp,
    "count_distinct": F.count_distinct,
}


def exact_sum(units: Column) -> Column:
    """Sum of bigint units as DECIMAL that no number of rows overflows: the
    low 20 bits and the rest are summed apart as bigint (each partial sum
    stays in generated code) and put together once per group."""
    high = F.sum(F.shiftright(units, 20)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << 20) - 1))).cast("decimal(20,0)")
    return high * F.lit(1 << 20).cast("decimal(8,0)") + low


def _safe_sum(df: DataFrame, col: str) -> Column:
    """``sum``, for whole numbers the exact one."""
    whole = isinstance(df.schema[col].dataType, T.IntegralType)
    return exact_sum(F.col(col).cast("long")) if whole else F.sum(col)


def summarize(df: DataFrame, by=None, aggs: Mapping[str, Sequence[str]] | None = None,
              count_rows: str | None = None) -> DataFrame:
    """``groupBy(by).agg`` from a spec ``{column: [func, ...]}``; output
    columns are named ``<func>_<column>`` (pandas ``.agg([...])``). Sums of whole
    numbers are DECIMAL and cannot overflow. ``median``
    is exact and comes from value counts, so no task holds a group's values."""
    from lakeloom.operators.joins import join
    from lakeloom.operators.quantiles import exact_median

    exprs: list[Column] = []
    medians: list[str] = []
    order: list[str] = list(_cols(by)) + ([count_rows] if count_rows else [])
    if count_rows:
        exprs.append(F.count(F.lit(1)).alias(count_rows))
    for col, funcs in (aggs or {}).items():
        for fn in ([funcs] if isinstance(funcs, str) else funcs):
            order.append(f"{fn}_{col}")
            if fn == "median":
                medians.append(col)
            else:
                exprs.append((_safe_sum(df, col) if fn == "sum" else _AGGS[fn](F.col(col))).alias(f"{fn}_{col}"))
    keys = _cols(by)
    out = df.groupBy(*keys).agg(*(exprs or [F.count(F.lit(1)).alias("_rows")]))
    for col in medians:
        m = exact_median(df, col, keys, f"median_{col}")
        out = join(out, m, keys, "left", null_safe=True) if keys else out.join(m, F.lit(True), "left")
    return out.select(*order)


# A7 / A8 / G7 -----------------------------------------------------------
def distinct_count(df: DataFrame, by, col: str, out: str = "n_distinct",
                   having_min: int | None = None) -> DataFrame:
    """Exact distinct count per group; ``having_min`` keeps groups with at
    least that many (HAVING)."""
    res = df.groupBy(*_cols(by)).agg(F.count_distinct(col).alias(out))
    if having_min is not None:
        res = res.where(F.col(out) >= having_min)
    return res


# A14 --------------------------------------------------------------------
def duplicates(df: DataFrame, keys: Sequence[str] | None = None, out: str = "count") -> DataFrame:
    """Key combinations (all columns by default) occurring more than once."""
    keys = list(keys) if keys else df.columns
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


# A15-A17 ----------------------------------------------------------------
def value_counts(df: DataFrame, col: str, out: str = "count", dropna: bool = True) -> DataFrame:
    """Count per value, most frequent first (pandas ``value_counts``)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return (src.groupBy(col).agg(F.count(F.lit(1)).alias(out))
            .orderBy(F.col(out).desc(), F.col(col).asc()))


def share_of_total(df: DataFrame, col: str, out: str = "pct", count_col: str = "count",
                   scale: int | None = 2) -> DataFrame:
    """Count and percent of rows per value. The total is a scalar
    subquery, not an unpartitioned window."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    total = df.where(F.col(col).isNotNull()).select(F.count(F.lit(1))).scalar()
    pct = F.col(count_col) * 100.0 / total
    return counts.withColumn(out, F.round(pct, scale) if scale is not None else pct)


def percent_matching(df: DataFrame, predicate: Column, by=None, out: str = "pct",
                     scale: int | None = 2) -> DataFrame:
    """Percent of rows satisfying ``predicate`` (NULL counts as false)."""
    v = F.avg(F.coalesce(predicate, F.lit(False)).cast("int")) * 100
    return df.groupBy(*_cols(by)).agg((F.round(v, scale) if scale is not None else v).alias(out))


# A18 / Q1 ---------------------------------------------------------------
def describe_by(df: DataFrame, value_col: str, by=None, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """pandas ``groupby(...)[col].describe()``: count, mean, std (sample),
    min, 25%/50%/75% (exact, linear interpolation; ``approx=True`` uses a
    bounded sketch instead), max. The plain statistics come from the scan that
    brackets the percentiles."""
    by = _cols(by)
    v, probs, names = F.col("_v"), [0.25, 0.5, 0.75], ["p25", "p50", "p75"]
    keyed = df.select(pack_key(by).alias("_gk"), F.col(value_col).cast("double").alias("_v"))
    basic = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
             F.min(v).alias("min"), F.max(v).alias("max")]
    if approx:
        q = F.percentile_approx(v, probs, accuracy)
        out = keyed.groupBy("_gk").agg(*basic, q.alias("_q")).select("*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    else:
        out = percentile_table(keyed, probs, names, basic)
    return out.select(*[F.col(f"_gk.{c}").alias(c) for c in by], "count", "mean", "std", "min",
                      "p25", "p50", "p75", "max")


# A19 / L6 ---------------------------------------------------------------
def _salts(df: DataFrame, given: int | None):
    """Salt count: as many as a shuffle has partitions unless given."""
    return F.lit(given or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salted_agg(df: DataFrame, key, value_col: str, salt_buckets: int | None = None,
               salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Two-stage aggregate: partial results per ``(key, salt)`` then per key.

    The salt is a hash of the row (``salt_cols``, default all columns), not
    ``rand()``, so a retried task rebuilds the same partials. Returns sum,
    count, min, max and avg (= sum / count) of ``value_col``.
    """
    keys = _cols(key)
    salt_src = [F.col(c) for c in (salt_cols or df.columns)]
    staged = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_src), _salts(df, salt_buckets)))
    partial = staged.groupBy(*keys, "_salt").agg(
        _safe_sum(staged, value_col).alias("_s"), F.count(value_col).alias("_n"),
        F.min(value_col).alias("_mn"), F.max(value_col).alias("_mx"))
    return partial.groupBy(*keys).agg(
        F.sum("_s").alias("total"), F.sum("_n").alias("n"),
        F.min("_mn").alias("min"), F.max("_mx").alias("max"),
        (F.sum("_s").cast("double") / F.sum("_n")).alias("avg"))


def salted_count_distinct(df: DataFrame, key, col: str, out: str = "n_distinct",
                          salt_buckets: int | None = None) -> DataFrame:
    """Exact distinct count for hot keys: dedup ``(key, col)`` salted by
    ``hash(col)`` (equal values meet in the same salt), count per salt, sum."""
    keys = _cols(key)
    staged = df.select(*keys, col).where(F.col(col).isNotNull()).withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(col)), _salts(df, salt_buckets)))
    partial = staged.groupBy(*keys, "_salt").agg(F.count_distinct(col).alias("_d"))
    return partial.groupBy(*keys).agg(F.sum("_d").alias(out))


# A20 / A21 --------------------------------------------------------------
def second_highest(df: DataFrame, value_col: str, by=None, out: str = "second_highest") -> DataFrame:
    """Largest value strictly below the maximum (NULL when there is none)."""
    by = _cols(by)
    if not by:
        mx = df.select(F.max(value_col)).scalar()
        return df.where(F.col(value_col) < mx).agg(F.max(value_col).alias(out))
    keyed = df.select(F.struct(*[F.col(c) for c in by]).alias("_gk"), value_col)
    mx = stored_side(keyed.groupBy("_gk").agg(F.max(value_col).alias("_mx")), "maxima")
    below = (keyed.join(mx, "_gk").where(F.col(value_col) < F.col("_mx"))
             .groupBy("_gk").agg(F.max(value_col).alias(out)))
    res = mx.select("_gk").join(below, "_gk", "left")
    return res.select(*[F.col(f"_gk.{c}").alias(c) for c in by], out)


# A22 --------------------------------------------------------------------
def count_exprs(conditions: Mapping[str, Column]) -> list[Column]:
    """``count_if`` for each named condition."""
    return [F.count_if(c).alias(n) for n, c in conditions.items()]


def sum_exprs(value_col: str, conditions: Mapping[str, Column]) -> list[Column]:
    """Sum of ``value_col`` over the rows of each named condition."""
    return [F.sum(F.when(c, F.col(value_col))).alias(n) for n, c in conditions.items()]


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by=None) -> DataFrame:
    return df.groupBy(*_cols(by)).agg(*count_exprs(conditions))


def conditional_sums(df: DataFrame, value_col: str, conditions: Mapping[str, Column], by=None) -> DataFrame:
    return df.groupBy(*_cols(by)).agg(*sum_exprs(value_col, conditions))


# A23 --------------------------------------------------------------------
def merge_sum(frames: Sequence[DataFrame], keys, value_cols: Sequence[str]) -> DataFrame:
    """Stack keyed tables and add values of shared keys (dict merge-with-sum)."""
    keys = _cols(keys)
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in value_cols])


# A24 --------------------------------------------------------------------
def token_frequency(df: DataFrame, text_col: str, by=None, lowercase: bool = True,
                    pattern: str = "(?U)\\w+", out: str = "count") -> DataFrame:
    """Frequency of word tokens over a whole text column."""
    t = F.lower(F.col(text_col)) if lowercase else F.col(text_col)
    toks = df.select(*_cols(by), F.explode(F.regexp_extract_all(t, F.lit(f"({pattern})"), 1)).alias("token"))
    return toks.groupBy(*_cols(by), "token").agg(F.count(F.lit(1)).alias(out))


def char_frequency(df: DataFrame, text_col: str, by=None, out: str = "count") -> DataFrame:
    chars = df.select(*_cols(by), F.explode(F.split(F.col(text_col), "")).alias("char"))
    return chars.where(F.col("char") != "").groupBy(*_cols(by), "char").agg(F.count(F.lit(1)).alias(out))


def most_frequent(freq: DataFrame, item_col: str, count_col: str = "count", by=None) -> DataFrame:
    """Most frequent item per group (highest count, ties to the smallest
    item), via the salted two-stage top-n."""
    from lakeloom.operators.windows import top_n_per_group
    return top_n_per_group(freq, _cols(by), [(count_col, "desc"), (item_col, "asc")], 1)
