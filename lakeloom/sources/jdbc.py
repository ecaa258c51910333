"""JDBC ingestion.

Connection details (URL, user, password) always come from the caller;
nothing is stored in code. A JDBC read without a partition column is one
task, so large tables should name a numeric ``partition_column`` with
bounds: Spark then issues ``num_partitions`` range queries in parallel.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.dates import ntz_literal


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000) -> DataFrame:
    """Read a table or a parenthesised subquery (``"(SELECT ...) AS t"``)."""
    props = dict(properties)
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower_bound,
                               upperBound=upper_bound, numPartitions=num_partitions,
                               properties=props)
    return spark.read.jdbc(url, table, properties=props)


def discover_tables(spark: SparkSession, url: str, properties: Mapping[str, str],
                    schema: str, table_type: str = "BASE TABLE") -> list[str]:
    """Names of tables in a database schema from ``INFORMATION_SCHEMA``.
    The list is small (table names, not data), so it is collected. The
    schema name and table type are validated before they enter SQL text."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_$]*", schema) or not re.fullmatch(r"[A-Z ]+", table_type):
        raise ValueError("schema must be a plain identifier and table_type upper-case words")
    q = ("(SELECT TABLE_SCHEMA, TABLE_NAME FROM INFORMATION_SCHEMA.TABLES "
         f"WHERE TABLE_SCHEMA = '{schema}' AND TABLE_TYPE = '{table_type}') AS tbl")
    rows = read_jdbc(spark, url, q, properties).collect()
    return [f"{r['TABLE_SCHEMA']}.{r['TABLE_NAME']}" for r in rows]


def ingest_tables(spark: SparkSession, reader: Callable[[str], DataFrame], names: Sequence[str],
                  sink: Callable[[DataFrame, str], None], run_ts: _dt.datetime | None = None,
                  source_system: str | None = None) -> DataFrame:
    """Copy each named table: ``reader(name)`` -> lineage columns ->
    ``sink(df, target_name)``. Every table is its own distributed job; a
    failure is logged and the loop goes on. Returns the load log.

    ``reader`` and ``sink`` are callables, so the same code ingests from
    JDBC, files or a catalog (tests use Parquet)."""
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    log = []
    for name in names:
        target = name.split(".")[-1].lower()
        try:
            df = reader(name).withColumns({
                "ingestion_timestamp": ntz_literal(run_ts),
                "source_system": F.lit(source_system),
                "source_table": F.lit(name),
            })
            sink(df, target)
            log.append((name, target, "SUCCESS", None, run_ts))
        except Exception as e:  # noqa: BLE001 - record and continue
            log.append((name, target, "FAILED", str(e), run_ts))
    return spark.createDataFrame(log, "source_table string, target_table string, status string, "
                                      "error string, run_ts timestamp_ntz")
