"""Projection, renaming and row selection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators._order import sort_keys
from lakeloom.operators.windows import row_positions


def select(df: DataFrame, *cols) -> DataFrame:
    return df.select(*cols)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(exprs))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def snake_case(name: str) -> str:
    """``SalesOrderID`` -> ``sales_order_id``; ``Id number`` -> ``id_number``."""
    s = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    return re.sub(r"_+", "_", s).strip("_").lower()


def rename_all(df: DataFrame, style: str = "snake") -> DataFrame:
    """Rename every column: ``lower``, ``upper`` or ``snake`` case."""
    fn = {"lower": str.lower, "upper": str.upper, "snake": snake_case}[style]
    return df.toDF(*[fn(c) for c in df.columns])


def drop(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def drop_rows_by_key(df: DataFrame, key: str, values: Sequence) -> DataFrame:
    """pandas ``drop(index=...)`` on an explicit key column."""
    return df.where(~F.col(key).isin(list(values)) | F.col(key).isNull())


# The type families accepted by ``select_by_type``.
_KINDS = {
    "number": (T.NumericType,),
    "integer": (T.IntegralType,),
    "float": (T.FractionalType,),
    "string": (T.StringType,),
    "object": (T.StringType,),
    "bool": (T.BooleanType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def select_by_type(df: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """pandas ``select_dtypes`` over the schema."""
    inc = tuple(t for k in include for t in _KINDS[k])
    exc = tuple(t for k in exclude for t in _KINDS[k])
    keep = [f.name for f in df.schema.fields
            if (not inc or isinstance(f.dataType, inc)) and not (exc and isinstance(f.dataType, exc))]
    return df.select(*keep)


def query(df: DataFrame, condition: str) -> DataFrame:
    """pandas ``df.query``: a SQL boolean expression."""
    return df.where(F.expr(condition))


def slice_rows(df: DataFrame, order_by, start: int = 0, stop: int | None = None,
               cols: Sequence[str] | None = None) -> DataFrame:
    """pandas ``iloc[start:stop, cols]`` under an explicit order (row order
    is otherwise undefined in Spark), by positions from a distributed global
    row number: no number of rows goes through one task. Give a total order."""
    pos = row_positions(df, order_by, "_pos")
    cond = F.col("_pos") >= start if stop is None else F.col("_pos").between(start, stop - 1)
    out = pos.where(cond).drop("_pos")
    return out.select(*cols) if cols else out


def lookup(df: DataFrame, keys: Mapping[str, object] | None = None, **kw) -> DataFrame:
    """Rows matching a (composite) key, e.g. ``lookup(df, store='A', region='East')``.
    A list value matches any of its elements."""
    cond = F.lit(True)
    for k, v in {**(keys or {}), **kw}.items():
        cond = cond & (F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(k) == v)
    return df.where(cond)
