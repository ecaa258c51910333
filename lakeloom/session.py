"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every lakeloom job relies on. AQE re-plans joins from runtime
# sizes (broadcast conversion, skew-join splitting, partition coalescing);
# the session time zone is pinned so timestamp arithmetic is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # segmented operators write reliable checkpoints; delete them once the
    # DataFrame that owns them is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "lakeloom", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the lakeloom defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always
    wins. Only in local mode (tests, laptops), when it is unset, do we set
    one ourselves: ``fallback`` or a fresh temporary folder. On a cluster a
    machine-local folder would not survive the loss of an executor, so an
    unset value is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster is a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared (distributed) folder; "
                           "lakeloom writes checkpoints and intermediate layers there")
    path = fallback or tempfile.mkdtemp(prefix="lakeloom-ckpt-")
    os.makedirs(path, exist_ok=True)
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
