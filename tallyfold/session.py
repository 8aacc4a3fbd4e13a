"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster (pass as ``extra``): many initial
# shuffle partitions that AQE coalesces to ~256 MB, 256 MB scan splits, and
# skew splitting for partitions 5x the median and above 512 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app: str = "tallyfold",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster pass ``master=None`` so the launcher decides; tests use
    ``local[*]`` with few shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a folder inside the warehouse is used and
    becomes the setting: the warehouse is the one other place that the driver
    and all executors share, under any master.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server reads spark.checkpoint.dir itself
        return path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def remove_path(spark: SparkSession, folder: str) -> None:
    """Delete a written table or folder from whatever store it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_RUN: ContextVar[str | None] = ContextVar("tallyfold_scratch_run", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written hand-over table, under the shared checkpoint folder.

    Inside :func:`scratch_run` it lies in the run's own folder.
    """
    folder = _RUN.get() or checkpoint_dir(spark)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A folder for one run's hand-over tables, removed when the run's results are written."""
    folder = os.path.join(checkpoint_dir(spark), f"run-{uuid.uuid4().hex}")
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove_path(spark, folder)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None) -> None:
    """Make this package importable in the Python workers.

    Python stages (the Jaro UDF, the nearest-candidate lookup) unpickle
    functions that live in this package; the package is zipped once per
    application and added with ``addPyFile`` so workers find it wherever
    the driver was started.  On a cluster, ``--py-files`` does the same.
    """
    if spark is None:
        return
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship with the server's --py-files
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tallyfold-pkg-")
    archive = shutil.make_archive(os.path.join(out, "tallyfold"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="tallyfold")
    sc.addPyFile(archive)
    _SHIPPED.add(key)
