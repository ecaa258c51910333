"""Intermediate tables, bounded broadcasts and bounded samples."""

from __future__ import annotations

import pickle
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import checkpoint_dir

#: Most rows of a key table (ids, hashes, a few numbers) that is broadcast.
BROADCAST_ROWS = 500_000


#: rows and bytes of text that a task holds at once on its way to Python
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def text_batches(spark: SparkSession) -> None:
    """Send texts to Python in small Arrow batches from now on: a session
    setting, as a default batch of 10 000 long texts takes hundreds of MB in
    the JVM and again in Python. A smaller setting of the session stays."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).removesuffix("b")
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(key, str(most))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder in the shared checkpoint folder and read
    it back: lineage is cut, the table survives lost executors, and Catalyst
    knows its size."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (already staged, narrow) with a broadcast hint if it has at
    most ``rows`` rows; larger tables are joined by shuffle. The result of
    the join is the same."""
    return F.broadcast(table) if table.count() <= rows else table


def join_in_blocks(left: DataFrame, table: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """Inner join of ``left`` with ``table`` (staged, narrow) that never moves
    ``left`` by the key: the table is sent in blocks of about ``rows`` rows, each
    to all of ``left``. A key that most of ``left`` holds is no hot key then."""
    rows = rows or BROADCAST_ROWS
    blocks = max(1, -(-table.count() // rows))
    if blocks == 1:
        return left.join(F.broadcast(table), key)
    left, part = staged(left, "blocks"), F.pmod(F.xxhash64(*table.columns), F.lit(blocks))
    return reduce(DataFrame.unionByName, (left.join(F.broadcast(table.where(part == b)), key) for b in range(blocks)))


def join_by_weight(left: DataFrame, table: DataFrame, key: str, weight: str, rows: int | None = None) -> DataFrame:
    """Inner join of ``left`` with ``table`` (staged, narrow, each key once),
    where ``weight`` tells how many rows of ``left`` hold a key. The heaviest
    keys, ``rows`` at most, are sent to the tasks; the others, which are in few
    rows each, are joined by shuffle."""
    rows = rows or BROADCAST_ROWS
    if table.count() <= rows:
        return left.join(F.broadcast(table), key)
    cut = table.select(weight).orderBy(F.desc(weight)).limit(rows + 1).agg(F.min(weight)).first()[0]
    hot = left.join(F.broadcast(table.where(F.col(weight) > cut)), key)
    return hot.unionByName(left.join(table.where(F.col(weight) <= cut), key))


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` or, where a frame has such a column, ``name`` with as many
    underscores before it as it needs."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sample_cut(ids: DataFrame, column: str, rows: int) -> int | None:
    """The ``rows``-th smallest ``xxhash64`` of a column: rows at or below it
    are a deterministic sample of at most about ``rows`` rows. None if the
    frame is empty."""
    h = ids.select(F.xxhash64(F.col(column)).alias("h")).orderBy("h").limit(rows)
    return h.agg(F.max("h")).first()[0]


def fitted(features: DataFrame, fit):
    """``fit(batches)`` run in one task over all rows of ``features`` (a bounded
    sample); only what it returns comes to the driver. None stays None."""
    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(list(batches)))], pa.binary())], ["model"])

    return pickle.loads(features.repartition(1).mapInArrow(run, "model binary").first().model)


def held_out(column: str, mod: int, rest: int):
    """True where crc32 of the id as text leaves ``rest`` modulo ``mod``."""
    return F.crc32(F.col(column).cast("string")) % mod == rest


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
