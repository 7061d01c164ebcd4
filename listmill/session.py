"""Session construction and the shared folder that jobs may write work tables to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, name: str = "listmill", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder() -> str:
    """A folder of this process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="listmill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a cluster
    the executors would each see a different one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/listmill/{purpose}-{uuid.uuid4().hex}"
