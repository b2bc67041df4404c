"""A folder that every executor can reach, for tables that cut a lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(SETTING, None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder shared by all executors")
    return tempfile.gettempdir()


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path under the cluster's shared folder.

    Only a local session without the setting falls back on the machine's
    temporary folder, where there is no other machine to share with.
    """
    path = f"{_shared_root(spark).rstrip('/')}/limpid-{purpose}-{uuid.uuid4().hex}"
    made = _MADE.get()
    if made is not None:
        made.append(path)
    return path


# Folders made in the innermost ``scratch_removed`` of this context.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it is, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, once the results inside are written.

    Threads take part if they run in a copy of the context.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove_folder(spark, path)
