"""Session settings and the shared scratch folder.

The library never creates a session behind the caller's back; these helpers
are for tests, the benchmark and command-line callers.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: one calendar day is a UTC day, AQE re-plans
# joins and coalesces shuffle partitions at run time, skewed joins are split.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings sized for a large input, to pass to the session builder.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least two waves of the cluster's cores) and AQE coalesces them
    by run-time size; scans split at 256 MiB; skewed shuffle partitions above
    five times the median and 512 MiB are split by AQE's skew-join handling.
    Broadcasts are left to explicit, size-checked hints plus AQE's run-time
    threshold.
    """
    partitions = max(2 * executor_cores_total, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        **BASE_CONF,
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    if "spark.checkpoint.dir" not in conf:  # one machine: any folder is shared
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerline-local-")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    There is no fallback: a folder made up here would be local to one machine,
    and on a cluster the other executors would not see what is written to it.
    """
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        current = None
    current = current or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return current.rstrip("/")


def require_utc(spark: SparkSession) -> None:
    """One calendar day is a UTC day: jobs refuse a session in another zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used location under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
