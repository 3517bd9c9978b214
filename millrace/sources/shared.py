"""The folder that the driver and all executors share, for tables and files between jobs."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import SparkSession

_kept: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application in the one that spark.checkpoint.dir names.

    Where none is named, one under /tmp is used if all tasks run in this one JVM (tests,
    a laptop); on a cluster that is an error, as each executor would write to its own disk.
    """
    app = spark.sparkContext.applicationId
    if app not in _kept:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = base or "file:/tmp/checkpoints"
        _kept[app] = f"{base.rstrip('/')}/millrace-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(delete, spark, _kept[app])
    return _kept[app]


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder through Spark's file systems, if the session still lives."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session has ended; the cluster's own clean-up does it
        pass


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
