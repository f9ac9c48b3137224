"""Session helpers for local runs, and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: str | None = None


def local_session(app: str = "tidemark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Writes into few folders without sorting rows by folder first.

    A task keeps up to ``files`` files open; a task with more sorts its remaining rows.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path on storage that every executor can reach.

    The root is the session's ``spark.checkpoint.dir``.  Only a local master
    may run without that setting; it then gets one temporary folder.
    """
    global _LOCAL_SCRATCH
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _LOCAL_SCRATCH is None:
            _LOCAL_SCRATCH = tempfile.mkdtemp(prefix="tidemark-")
            atexit.register(shutil.rmtree, _LOCAL_SCRATCH, ignore_errors=True)
        root = _LOCAL_SCRATCH
    return f"{root.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
