"""Session construction and shared scratch locations.

Intermediate outputs (Parquet written between layers, CSV produced for the
ingest checks) go below the folder the cluster names in
``spark.checkpoint.dir``. That folder is shared storage on a real cluster, so
an output survives the loss of the executor that wrote it. A private folder is
only chosen when the session has none configured and runs on a local master;
on a cluster that is an error, as executors would write to their own disks.

Every scratch location has an owner: the innermost open ``scratch_scope``, or
the session, whose leftovers ``release_scratch`` deletes. What is left when the
driver ends goes with the application's own folder, which Hadoop's file system
deletes on exit.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for inputs of many terabytes (a starting point, per cluster; pass
# ``large_input=True``): partitions of about 256 MB for scans and after AQE
# coalescing, a high initial shuffle partition count that AQE merges down,
# coalescing that keeps the advisory size rather than the core count, and
# skewed shuffle partitions split when over 5x the median and 512 MB.
LARGE_INPUT_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def build_session(
    master: str | None = None,
    app_name: str = "strata",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    large_input: bool = False,
) -> SparkSession:
    """Return a session with AQE, skew-join splitting and a UTC session zone.
    ``large_input`` adds the settings for inputs of many terabytes.

    The operators do not depend on the session zone for wall-clock
    (``timestamp_ntz``) data; UTC only fixes how zoned timestamps print.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULT_CONF, **(LARGE_INPUT_CONF if large_input else {})}
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Shared folder for intermediate data: the session's checkpoint folder.

    Read from ``spark.checkpoint.dir`` (or a directory set through
    ``SparkContext.setCheckpointDir``). When neither is set, a local session
    gets a private folder that is deleted at exit; any other master raises.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="strata-checkpoints-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


# Open owners of scratch locations, innermost last; the first is the session's.
_OWNED: list[list[str]] = [[]]


# Applications whose folder is marked for deletion at the end.
_MARKED: set[str] = set()


def application_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one, deleted when the driver's
    JVM ends."""
    sc = spark.sparkContext
    folder = os.path.join(shared_root(spark), "strata", sc.applicationId)
    if folder not in _MARKED:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        # Only what exists can be marked.
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique output location below the shared folder, deleted when its
    owner closes."""
    path = os.path.join(application_folder(spark), f"{name}-{uuid.uuid4().hex}")
    _OWNED[-1].append(path)
    return path


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete datasets in whatever store their paths name."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for text in paths:
        path = jvm.org.apache.hadoop.fs.Path(text)
        path.getFileSystem(conf).delete(path, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete what the innermost owner has written so far. Frames that read it
    can't be evaluated afterwards."""
    delete_paths(spark, _OWNED[-1])
    _OWNED[-1].clear()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Own the scratch locations made inside; they are deleted on leaving."""
    _OWNED.append([])
    try:
        yield
    finally:
        release_scratch(spark)
        _OWNED.pop()
