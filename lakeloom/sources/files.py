"""File and table sources/sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# S1-S4 ------------------------------------------------------------------
def from_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | Sequence[str] | str | None = None) -> DataFrame:
    """Table from literal rows: tuples with names, tuples with a
    ``StructType`` (nested types allowed), ``Row`` objects, or no rows with
    a schema. Meant for small fixtures and lookup tables."""
    if schema is not None and not isinstance(schema, (T.StructType, str)):
        schema = list(schema)
    return spark.createDataFrame(list(rows), schema)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


# S6 / S7 ----------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, **options) -> DataFrame:
    """CSV with a header. Pass ``schema`` at scale (inference reads the
    data an extra time); without it and without ``infer`` every column is a
    string."""
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode).option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


# S8 / S9 / S13 ----------------------------------------------------------
def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = (), max_records_per_file: int | None = None) -> None:
    """Parquet sink; ``partition_by`` writes a Hive-style layout
    (``year=2024/month=1/``) that readers prune by directory."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def load(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Path-based table of any installed format."""
    return spark.read.format(fmt).options(**options).load(path)


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
         partition_by: Sequence[str] = (), **options) -> None:
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# S10-S12 ----------------------------------------------------------------
def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] = (), overwrite_schema: bool = True) -> None:
    """Managed table. Overwriting a file-format table replaces its schema
    too (the lake formats need ``overwriteSchema`` for that)."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if overwrite_schema and fmt == "delta":
        w = w.option("overwriteSchema", "true")
    w.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


# S18 / S19 --------------------------------------------------------------
def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql(spark: SparkSession, text: str, **kwargs) -> DataFrame:
    """SQL text; keyword arguments bind as named parameters (``:name``)."""
    return spark.sql(text, args=kwargs or None)


# S21 / S22 --------------------------------------------------------------
def take(df: DataFrame, n: int) -> list:
    """Bounded pull of ``n`` rows to the driver."""
    return df.limit(n).collect()


def iterate(df: DataFrame, prefetch: bool = False):
    """Stream rows to the driver one partition at a time (bounded memory)."""
    return df.toLocalIterator(prefetchPartitions=prefetch)
