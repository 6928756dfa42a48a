"""Where jobs put data of their own: the shared folder the cluster names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _own_root() -> str:
    """A temporary folder of this process, removed when it ends."""
    root = tempfile.mkdtemp(prefix="daybook-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


@lru_cache(maxsize=8)
def _session_root(spark: SparkSession, root: str) -> str:
    """A folder of this application, which the file system that holds it deletes when the driver's JVM ends."""
    path = f"{root.rstrip('/')}/daybook-{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:8]}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the driver ends.

    Only a local session may do without the setting, as tests do; executors on other machines
    would not see a folder of the driver's.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        root = _own_root()
    return f"{_session_root(spark, root)}/{label}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` gave and that is not read any more, before the driver ends."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It deletes them when the driver's JVM has collected the plans they belong to, which a driver with little to do puts off for up to
    half an hour (``spark.cleaner.periodicGC.interval``); until then the files of every step of a job lie on the executors' disks.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:
        jvm.java.lang.System.gc()
        time.sleep(0.5)  # the last job's plan is held until its end has been told to all listeners
        jvm.java.lang.System.gc()
