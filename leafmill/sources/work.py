"""Where queries that write put their files."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession, label: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Where that is unset, one in a temporary folder if all tasks run in this process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not found:
        master, run = spark.sparkContext.master, spark.sparkContext.applicationId
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if run not in _own:
            _own[run] = tempfile.mkdtemp(prefix="leafmill-work-")
            atexit.register(shutil.rmtree, _own[run], True)
        found = "file://" + _own[run]
    return f"{found.rstrip('/')}/leafmill-work/{label}-{uuid.uuid4().hex}"
