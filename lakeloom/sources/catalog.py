"""Catalog, DDL, schema inspection and synthetic tables."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    if not all(_IDENT.match(p) for p in parts):
        raise ValueError(f"bad identifier {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = " LOCATION '{}'".format(location.replace("\\", "\\\\").replace("'", "\\'")) if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(name)}{loc}")


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables in a database as a DataFrame (``SHOW TABLES IN db``)."""
    if database:
        return spark.sql(f"SHOW TABLES IN {_ident(database)}")
    return spark.sql("SHOW TABLES")


def create_table(spark: SparkSession, name: str, ddl_columns: str, fmt: str = "parquet",
                 partitioned_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE ... USING fmt``. Constraints (PK/FK/NOT NULL) are not
    enforced by Spark; check them with ``operators.quality.key_checks``."""
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({ddl_columns}) USING {fmt}{part}")


def insert_rows(spark: SparkSession, name: str, df: DataFrame, overwrite: bool = False) -> None:
    """``INSERT INTO`` from a DataFrame (by position, like SQL)."""
    df.write.insertInto(name, overwrite=overwrite)


def schema_profile(df: DataFrame) -> list[tuple[str, str, bool]]:
    """``(name, type, nullable)`` per column, read from the schema only."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns): the row count is a distributed count job."""
    return df.count(), len(df.columns)


def explain_plan(df: DataFrame, mode: str = "formatted") -> str:
    """The plan text that ``df.explain(mode)`` prints, as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_profile(df: DataFrame) -> DataFrame:
    """The plan as data: (``node``, ``n``, ``detail``), one row for each kind of
    operator of ``explain("formatted")`` with the details of all of its kind."""
    nodes: dict[str, list[str]] = {}
    for block in re.split(r"\n\n+", explain_plan(df)):
        head = re.match(r"\((\d+)\) ([A-Za-z]+)", block.strip())
        if head:
            nodes.setdefault(head.group(2), []).append(" ".join(block.split("\n")[1:]).strip())
    rows = [(name, len(details), details) for name, details in sorted(nodes.items())]
    return df.sparkSession.createDataFrame(rows, "node string, n int, detail array<string>")


def plan_checks(df: DataFrame) -> dict[str, object]:
    """What to look for in a plan: exchanges and joins by kind, filters that
    reached the scans, columns that are read, cartesian products and windows
    whose rows all go to one task."""
    nodes = {r.node: r.detail for r in plan_profile(df).collect()}  # one row a kind of operator
    scans = [d for k, v in nodes.items() if k == "Scan" for d in v]
    found = lambda name, text: [m.group(1) for m in (re.search(name + r": \[([^\]]*)\]", text),) if m and m.group(1)]
    exchanges = nodes.get("Exchange", [])
    return {"exchanges": len(exchanges), "broadcasts": len(nodes.get("BroadcastExchange", [])),
            "sort_merge_joins": len(nodes.get("SortMergeJoin", [])), "broadcast_joins": len(nodes.get("BroadcastHashJoin", [])),
            "cartesian": len(nodes.get("CartesianProduct", [])) + len(nodes.get("BroadcastNestedLoopJoin", [])),
            "single_partition": sum("SinglePartition" in d for d in exchanges),
            "single_windows": sum(bool(re.search(r"Arguments: \[.*windowspecdefinition\((?![^)]*#)", d)) for d in nodes.get("Window", [])),
            "pushed_filters": [f for d in scans for f in found("PushedFilters", d)],
            "columns_read": sorted({c.split(":")[0] for d in scans for s in re.findall(r"ReadSchema: struct<(.*?)>", d) for c in s.split(",") if c})}


def synthetic(spark: SparkSession, n: int, columns: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Deterministic generated table: ``spark.range(n)`` plus SQL
    expressions over ``id`` (e.g. ``{"customer_id": "id + 1",
    "region": "element_at(array('N','S'), cast(id % 2 as int) + 1)"}``).
    Generated on the executors, so ``n`` can be large."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    return base.select(*[F.expr(e).alias(c) for c, e in columns.items()])
