"""Spark session settings the library is tuned for.

The library never needs a particular session: every report is a DataFrame function. These settings are
what a cluster job should run with (AQE with skew-join splitting, runtime bloom filters, UTC, no UI).
The checkpoint folder is read from ``spark.checkpoint.dir`` where a job needs one (batch runs, streaming
loads); a local one is set only for a local-mode session that has none (tests and local runs).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


# What a task reads at most: shuffled bytes of the partitions that AQE merges, bytes of files. A byte of narrow shuffled rows is up to 30 bytes in
# the sorts and hash maps of a task, so Spark's 64 and 128 MB are 2 GB a task.
SHUFFLED_BYTES = 8 << 20
FILE_BYTES = 8 << 20
# Partitions before AQE merges the small ones: enough for 12 GB in one shuffle. From 2,000 on Spark knows only mean sizes, so AQE can't split large ones.
PARTITIONS = 1600
_UNITS = {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}


def _bytes(value: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", value.strip().lower()).groups()
    return int(number) << _UNITS[unit]


def small_tasks(spark: SparkSession) -> None:
    """Bounds what a task of the session reads, so that its memory does not grow with the input. Finer settings of the session stay."""
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED_BYTES), ("spark.sql.files.maxPartitionBytes", FILE_BYTES)):
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(now) < PARTITIONS:
        spark.conf.set(key, str(PARTITIONS))


def cluster_conf(shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the expected shuffle volume of the biggest stage.

    Shuffle partitions are chosen so that each holds about ``target_partition_bytes`` before AQE
    coalesces the small ones (so a partition fits in one task's execution memory without heavy
    spill); scans read 512 MB splits; AQE splits a partition over 5x the median and 256 MB."""
    partitions = max(200, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    }


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "telcolens",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session (tests, local runs) without one gets a fresh local folder; on a
    cluster a missing setting is an error, because a machine-local folder would not survive the
    loss of that machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="telcolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local
