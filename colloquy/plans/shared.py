"""The folder that every executor can read and write."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Only a session on one machine may leave it unset: it then has a folder of
    its own, which goes when the driver ends.
    """
    named = spark.conf.get(_CHECKPOINT_SETTING, None)
    if named:
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError(f"set {_CHECKPOINT_SETTING} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="colloquy-")
        atexit.register(shutil.rmtree, _own[application], ignore_errors=True)
    return _own[application]


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/colloquy-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote for itself; results that read it must have been used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
