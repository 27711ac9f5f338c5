"""Session settings and the shared scratch folder.

The library never creates its own session inside an operator; callers pass
one in.  ``build_session`` is a convenience for tests, the bench and local
runs.  ``scratch_dir`` answers "where may a job write intermediate files"
from the session's ``spark.checkpoint.dir`` (the cluster's shared folder).  Only
a single-machine session may leave it unset; on a cluster that is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the feature pipeline relies on.  ANSI mode keeps the strict
# casting and division semantics of the warehouse script; AQE coalesces the
# single horse_id shuffle and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # The skew path checkpoints the runs of hot horses; the context cleaner
    # removes them once the DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "furlong", extra: dict | None = None) -> SparkSession:
    """A session with the settings above; partition counts and memory are the caller's unless given."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


class NoSharedFolderError(RuntimeError):
    pass


def default_checkpoint_dir(configured: str | None, master: str) -> str:
    """The checkpoint folder to use: the configured one, or on a single machine a new local one.

    Machines of a cluster do not see each other's local folders, so there an
    unset ``spark.checkpoint.dir`` is an error.
    """
    if configured:
        return configured
    if not re.match(r"local(\[|$)", master):
        raise NoSharedFolderError(
            f"spark.checkpoint.dir is not set and the master is {master!r}: name a folder that all machines share")
    return tempfile.mkdtemp(prefix="furlong-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, see ``default_checkpoint_dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = default_checkpoint_dir(spark.conf.get("spark.checkpoint.dir", None), sc.master)
    spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "furlong", f"{name}-{uuid.uuid4().hex[:12]}")
