"""Session defaults and shared-storage locations.

Nothing here starts a server: the Spark UI stays off. Scratch output
(exported fixtures, table versions, stream checkpoints) always goes under
the folder the cluster names in ``spark.checkpoint.dir``; a private
folder is created only when that setting is unset and the master is
``local`` (tests), since other machines cannot see it. Master and number of
shuffle partitions are the cluster's to set and are touched only on request.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. They are SQL confs and can be set on a
# running session.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON with a repeated key keeps the last value (as Python's json does)
    # instead of turning the whole message into NULL.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidewater") -> SparkSession:
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # remove checkpoint files once their DataFrames are gone
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SQL_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``. Only where that is unset and everything
    runs in this process (a ``local`` master) is a private temporary folder made
    and registered; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidewater/{name}-{uuid.uuid4().hex[:12]}"
