"""Physical layout and performance helpers.

These decide how data sits on storage and across tasks: partition counts,
file sizes, clustering for data skipping, caching scope and a timing
harness that runs the full query (``noop`` sink) instead of a ``count()``
the optimizer can prune.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# L1-L3 ------------------------------------------------------------------
def repartition_by(df: DataFrame, n: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    if keys:
        return df.repartition(n, *keys) if n else df.repartition(*keys)
    return df.repartition(n)


def coalesce_to(df: DataFrame, n: int) -> DataFrame:
    """Fewer partitions without a shuffle (before a write)."""
    return df.coalesce(n)


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread CPU-heavy row work over the cluster when the input arrives in
    too few partitions (e.g. a single large Parquet row group).

    The partition count is known at planning time, so the check runs no
    job. A real large input already has at least ``defaultParallelism``
    splits and is returned unchanged (no shuffle); only a narrow input is
    round-robin repartitioned, which Spark makes retry-safe by sorting rows
    before distributing them.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, to spot skew after a repartition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


# L4 / L5 ----------------------------------------------------------------
@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the duration of a block and always release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int):
    """Temporarily change ``spark.sql.shuffle.partitions`` and restore it."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def sized_partitions(spark: SparkSession, path: str, target_bytes: int = 256 << 20, expansion: float = 3.0, fmt: str = "parquet") -> int:
    """Shuffle partitions for a job over the table at ``path``: the bytes of
    its files, times what rows take more in memory than in files, over
    ``target_bytes``; at least one for each core."""
    files = spark.read.format(fmt).load(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-int(size * expansion) // target_bytes))


def shared_reuse(df: DataFrame, consumers: Mapping[str, Callable[[DataFrame], DataFrame]], level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> dict[str, DataFrame]:
    """Results of several consumers of one frame that is computed once: it is
    persisted, each consumer's result is stored, then the frame is released."""
    from lakeloom.operators._store import stored
    with cached(df, level) as held:
        return {name: stored(consume(held), name) for name, consume in consumers.items()}


# L7 ---------------------------------------------------------------------
def compact(spark: SparkSession, src: str, dst: str, target_files: int, fmt: str = "parquet",
            partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite a file table into ``target_files`` files at a new path (the
    original stays valid until the caller swaps paths)."""
    df = spark.read.format(fmt).load(src)
    w = df.repartition(target_files, *partition_by) if partition_by else df.repartition(target_files)
    writer = w.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(dst)
    return spark.read.format(fmt).load(dst)


# L8 ---------------------------------------------------------------------
def _interleave(bucket_cols: Sequence[str], bits: int) -> F.Column:
    """Interleave the low ``bits`` bits of each bucket column (column 0 gets
    the most significant position of each bit group)."""
    k = len(bucket_cols)
    key = F.lit(0).cast("long")
    for b in range(bits):
        for j, c in enumerate(bucket_cols):
            bit = F.shiftright(F.col(c).cast("long"), b).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(bit, b * k + (k - 1 - j)))
    return key


def zorder(df: DataFrame, cols: Sequence[str], bits: int = 8, files: int | None = None) -> DataFrame:
    """Cluster rows on several columns at once (``OPTIMIZE ... ZORDER BY``).

    Each column (of any ordered type) gets one of at most ``2**bits`` buckets
    of about equal rows: the bounds are stored data from a hash sample of the
    column, a row finds its bucket by binary search. The bucket numbers are
    bit-interleaved into a Morton key, and rows are range partitioned and sorted
    by that key and then the columns themselves, so that a cell that holds many
    rows is split over files too. Written to Parquet, each file then covers a
    compact box in all the columns, so min/max statistics skip files for
    filters on any of them.
    """
    from lakeloom.operators._order import range_segments
    out, names = df, [f"_zb_{c}" for c in cols]
    for c, name in zip(cols, names):
        out = range_segments(out, [c], 2 ** bits, name)
    out = out.withColumn("_zkey", _interleave(names, bits))
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return out.repartitionByRange(n, "_zkey", *cols).sortWithinPartitions("_zkey", *cols).drop("_zkey", *names)


def file_ranges(spark: SparkSession, path: str, cols: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """One row a file: ``file_path``, ``rows``, and ``min_<c>`` and ``max_<c>``
    of each column, as a reader that skips files by statistics sees them."""
    df = spark.read.format(fmt).load(path).select(*cols, "_metadata.file_path")
    return df.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"), *[
        f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])


def skipped_files(ranges: DataFrame, box: Mapping[str, tuple]) -> DataFrame:
    """``file_ranges`` with ``skipped``: no row of the file can lie in the box
    (column -> lowest and highest wanted value)."""
    out = F.lit(False)
    for c, (low, high) in box.items():
        out |= F.col(f"min_{c}").isNull() | (F.col(f"max_{c}") < low) | (F.col(f"min_{c}") > high)
    return ranges.withColumn("skipped", out)


def zorder_write(df: DataFrame, path: str, cols: Sequence[str], bits: int = 8,
                 files: int | None = None, fmt: str = "parquet") -> None:
    zorder(df, cols, bits, files).write.mode("overwrite").format(fmt).save(path)


# L9 ---------------------------------------------------------------------
def table_detail(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Files, bytes and rows of a file table (``DESCRIBE DETAIL``)."""
    df = spark.read.format(fmt).load(path).select("_metadata.file_path", "_metadata.file_size")
    per_file = df.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows"))
    return per_file.agg(F.count(F.lit(1)).alias("num_files"),
                        F.sum("file_size").alias("size_in_bytes"),
                        F.sum("rows").alias("num_rows"))


# L10 --------------------------------------------------------------------
def run_to_noop(df: DataFrame) -> float:
    """Execute the whole plan (every column, every row) into the ``noop``
    sink and return wall seconds."""
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def bench(df: DataFrame, runs: int = 3) -> float:
    """Median wall time of ``runs`` full executions."""
    times = sorted(run_to_noop(df) for _ in range(runs))
    return times[len(times) // 2]


def compare(before: DataFrame, after: DataFrame, runs: int = 3, check_equal: bool = True) -> dict:
    """Time two formulations of the same query; first assert they return
    the same rows (multiset), so the pair measures one question."""
    if check_equal:
        cols = sorted(before.columns)
        if sorted(after.columns) != cols:
            raise AssertionError("before/after columns differ")
        b, a = before.select(*cols), after.select(*cols)
        if not (b.exceptAll(a).isEmpty() and a.exceptAll(b).isEmpty()):
            raise AssertionError("before/after return different rows")
    tb, ta = bench(before, runs), bench(after, runs)
    return {"before_sec": tb, "after_sec": ta, "speedup": tb / ta if ta else None}


# L11 --------------------------------------------------------------------
def write_bucketed(df: DataFrame, table: str, buckets: int, keys: Sequence[str],
                   sort: bool = True, fmt: str = "parquet") -> None:
    """Bucketed managed table: later joins/aggregates on ``keys`` between
    tables with the same bucketing skip the shuffle."""
    w = df.write.mode("overwrite").format(fmt).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
