"""Session helpers: the settings every hourcast job relies on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings the semantics depend on (UTC calendar days, ANSI arithmetic) plus
# adaptive execution so join strategy, partition coalescing and skew splitting
# are decided at run time from real sizes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Sizing for large clusters: start with enough shuffle partitions for the
# largest shuffle (~256 MB each) and let AQE coalesce the rest -- it can merge
# small partitions but only splits oversized ones in skewed joins.  Read
# ~256 MB file splits; keep runtime broadcasts to tables AQE measured as small.
TARGET_PARTITION_BYTES = 256 * 1024 ** 2


def cluster_conf(largest_shuffle_bytes: int = 5 * 1024 ** 4) -> dict[str, str]:
    """Sizing settings for a large cluster.

    The default assumes a ~5 TB largest shuffle (e.g. a full-history hourly join
    at 100 TB of events) -> ~20k initial partitions of ~256 MB.
    """
    parts = max(2000, -(-largest_shuffle_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    }


CLUSTER_CONF = cluster_conf()


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings hourcast needs on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "hourcast",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  profile: str | None = None,
                  largest_shuffle_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with hourcast's settings.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]``.  ``shuffle_partitions`` is the AQE starting point; AQE coalesces
    small partitions, so size it for the largest stage, not the smallest.
    ``profile="cluster"`` applies :func:`cluster_conf` (sized for
    ``largest_shuffle_bytes`` when given).
    """
    builder = SparkSession.builder.appName(app_name)
    if profile == "cluster":
        conf = cluster_conf(largest_shuffle_bytes) if largest_shuffle_bytes else CLUSTER_CONF
        for key, value in conf.items():
            builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster's ``spark.checkpoint.dir``, or a directory already set on the
    context.  Where neither is set a temporary folder serves a local session, and a
    cluster session raises: a folder of one machine would lose data there.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="hourcast-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder
