"""Session settings the semantics rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results (time zone), that keep skewed keys from forming one long task, that bound what a task
# sorts in memory, and that list many folders in few tasks (Spark's own choice is a task per folder, 10,000 at most).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "chatloom", **conf: str) -> SparkSession:
    """A session with the library's settings; the master is left to the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a temporary folder: on a cluster executors would not
    see the driver's disk.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_base.get(app)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base[app] = tempfile.mkdtemp(prefix="chatloom-")
    return f"{base.rstrip('/')}/chatloom/{app}/{label}-{uuid.uuid4().hex[:12]}"
