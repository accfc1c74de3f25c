"""Where a run keeps its tables and checkpoints."""

from __future__ import annotations

import functools
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class RunPaths:
    """Folders of one run. A new run starts with empty tables and no state."""

    root: str

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


@functools.lru_cache(maxsize=8)
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tarmac-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, reached by all executors.

    Only a local session may do without it; it gets one temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return _own_folder(spark.sparkContext.applicationId)


def fresh_run(root: str) -> RunPaths:
    """Paths of a run that shares nothing with earlier runs under the root."""
    return RunPaths(f"{root.rstrip('/')}/run-{uuid.uuid4().hex}")
