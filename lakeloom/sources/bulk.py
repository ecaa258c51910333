"""Bulk load (S16): several tables at once, restartable by run and table.

Each table is a Spark job of its own, started from a small pool of threads, in
a pool of its own (with ``spark.scheduler.mode=FAIR`` a small table does not
wait for a large one). The load log has one entry for each run and table,
written after the table: a run that is started again with the same ``run_id``
loads what has no successful entry and skips the others. A table that was cut
off while it was written has no entry and is written anew.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.dates import ntz_literal

LOG_SCHEMA = ("run_id string, source_table string, target_table string, status string, "
              "row_count long, error string, run_ts timestamp_ntz")


def load_log(spark: SparkSession, log_path: str, run_id: str) -> DataFrame:
    """Entries of a run, one a table; none if the run has not begun."""
    try:
        return spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{log_path.rstrip('/')}/{run_id}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def bulk_load(spark: SparkSession, reader: Callable[[str], DataFrame], names: Sequence[str], target_path: str,
              log_path: str, run_id: str, workers: int = 4, run_ts: _dt.datetime | None = None,
              source_system: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Load each named table to ``target_path/<table>`` with lineage columns.

    Returns an entry for each table in the order of ``names``: SUCCESS with the
    rows that the written table holds, FAILED with the error (the others go
    on), or SKIPPED with the rows logged before. Names that would share a target
    are refused before anything is written. Nothing but the entries of the named
    tables comes to the driver."""
    targets = {name: name.split(".")[-1].lower() for name in names}
    if len(set(targets.values())) != len(names):
        raise ValueError("two tables have one target")
    if not all(re.fullmatch(r"[A-Za-z0-9_-]+", x) for x in (run_id, *targets.values())):
        raise ValueError("run and table names must be letters, digits, _ and -")
    run_ts = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    target_path, log_path = target_path.rstrip("/"), log_path.rstrip("/")
    done = {r.source_table: r for r in load_log(spark, log_path, run_id).where("status = 'SUCCESS'").collect()}

    def entry(name: str, status: str, row_count: int | None, error: str | None) -> tuple:
        return run_id, name, targets[name], status, row_count, error, run_ts

    def load(name: str) -> tuple:
        if name in done:
            return entry(name, "SKIPPED", done[name].row_count, None)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{targets[name]}")
        path = f"{target_path}/{targets[name]}"
        try:
            reader(name).withColumns({
                "ingestion_timestamp": ntz_literal(run_ts), "source_system": F.lit(source_system).cast("string"), "source_table": F.lit(name),
            }).write.format(fmt).mode("overwrite").save(path)
            out = entry(name, "SUCCESS", spark.read.format(fmt).load(path).count(), None)
        except Exception as e:  # noqa: BLE001 - the entry tells it, the other tables go on
            out = entry(name, "FAILED", None, str(e))
        spark.createDataFrame([out], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{log_path}/{run_id}/{targets[name]}")
        return out

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        entries = list(pool.map(inheritable_thread_target(spark)(load), names))
    return spark.createDataFrame(entries, LOG_SCHEMA)
