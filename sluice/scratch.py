"""Folders for written intermediate tables and stream checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: there driver and executors
    share one machine, so a folder of the machine is as good as a shared one.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="sluice-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set(SETTING, base)
    return f"{base.rstrip('/')}/sluice/{purpose}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables below the shared folder, once nothing reads them any more.

    A folder that this module made itself goes with the process.
    """
    base = spark.conf.get(SETTING, None)
    if base:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/sluice")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
