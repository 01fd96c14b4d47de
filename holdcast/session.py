"""Spark session settings the metrics rely on, and the checkpoint folder.

On a cluster the session comes from the platform; ``configure`` only sets what
the metrics need for correct results (UTC) and what they assume for scale
(AQE with skew-join splitting). ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir`` and only falls back to a given local folder, as in tests,
or to the warehouse when the setting is absent or names a folder that tasks cannot use.
"""

from __future__ import annotations

import os
import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings every run needs. UTC because DATE(ts), YEAR(ts) and the 06:00
# snapshot timestamps are evaluated in the session time zone.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Folder of intermediates in the warehouse; readers of tables skip names with an underscore.
SCRATCH = "_holdcast"
# (application, folder) known to be shared by all machines.
_SHARED: set[tuple[str, str]] = set()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "holdcast", checkpoint_root: str | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    parts = shuffle_partitions or (int(cores) * 2 if str(cores).isdigit() else 16)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("HOLDCAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_root:
        checkpoint_dir(spark, fallback=checkpoint_root)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    Uses ``spark.checkpoint.dir`` when the cluster names one; sets ``fallback``
    only when it is unset (local tests). When neither exists, a folder in the warehouse
    (``spark.sql.warehouse.dir``) serves, where all tasks write tables anyway. A ``file:`` folder
    on a cluster is a shared mount or each machine's own disk, which its name does not
    tell: it is used if the driver sees what tasks write there
    (``spark.holdcast.sharedMount=true`` skips that trial). A named folder that fails the trial
    gives way to the warehouse for the rest of the application; if that fails too, both are refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current and fallback is not None:
        sc.setCheckpointDir(fallback)
        return sc.getCheckpointDir() or fallback
    refused = None
    if current:
        refused = _refusal(spark, current)
        if refused is None:
            if not sc.getCheckpointDir():
                sc.setCheckpointDir(current)
            return current
    warehouse = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{SCRATCH}"
    again = _refusal(spark, warehouse)
    if again is not None:
        raise RuntimeError("; ".join(filter(None, [refused, again])) + "; name a shared folder as spark.checkpoint.dir")
    if refused is None:
        return warehouse
    warnings.warn(f"{refused}; {warehouse} is used instead", stacklevel=2)
    sc.setCheckpointDir(warehouse)
    _SHARED.add((sc.applicationId, sc.getCheckpointDir()))
    return sc.getCheckpointDir()


def _refusal(spark: SparkSession, path: str) -> str | None:
    """Why tasks on other machines cannot share ``path`` with the driver; None if they can. Success is remembered for the application.

    Without a shared folder a write succeeds with the driver's own machine's files only, so rows would be missing.
    """
    sc = spark.sparkContext
    if not path.startswith("file:") or sc.master.startswith("local") or (sc.applicationId, path) in _SHARED:
        return None
    if sc.getConf().get("spark.holdcast.sharedMount", "false") != "true":
        tasks = 4 * sc.defaultParallelism            # some on every executor
        place = f"{path.rstrip('/')}/holdcast-trial-{uuid.uuid4().hex}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(place)
        try:
            spark.range(0, tasks, 1, tasks).write.parquet(place)
            found = spark.read.schema("id bigint").parquet(place).count()
            if found != tasks:
                return f"{path} is not shared by all machines: {tasks} tasks wrote a row each and {found} are seen"
        except (Py4JJavaError, PySparkException) as e:
            return f"{path} cannot be written by all machines: {str(e).strip().splitlines()[0]}"
        finally:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _SHARED.add((sc.applicationId, path))
    return None
