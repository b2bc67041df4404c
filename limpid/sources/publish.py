"""Tables that replace those of the run before only once all of them are written.

A run writes below ``out/_next``. A file there, written last, says that all is complete;
from then on the new tables stand, whatever fails: each is moved to its place under ``out``,
and ``settle`` goes on with the moves where a run ended. Without that file ``settle`` drops
what an unfinished run has left, and the tables under ``out`` stay as they were.

A run can also go on where an earlier one ended: with ``keep_unfinished`` the staged tables
stay, and a note per finished stage (``write_note``) says what it was made from.

Moves are those of the file system: at once on HDFS and local disks, copies on most object
stores. Two runs at a time on one ``out`` are not provided for.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

NEXT = "_next"
COMPLETE = "_complete"
NOTES = "_notes"


def staging(out_dir: str) -> str:
    """Where the next tables of ``out_dir`` are written; readers skip names with ``_``."""
    return f"{out_dir.rstrip('/')}/{NEXT}"


def _opened(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def mark_complete(spark: SparkSession, out_dir: str) -> None:
    """From here on the staged tables are those of ``out_dir``."""
    marker, store = _opened(spark, f"{staging(out_dir)}/{COMPLETE}")
    store.create(marker, True).close()


def settle(spark: SparkSession, out_dir: str, keep_unfinished: bool = False) -> bool:
    """Finish or drop what is staged; true if staged tables are in place now.

    ``keep_unfinished`` leaves what is staged by a run that has not completed. Every step can be repeated: a table that still is staged has not been moved.
    """
    folder, store = _opened(spark, staging(out_dir))
    marker, _ = _opened(spark, f"{staging(out_dir)}/{COMPLETE}")
    complete = store.exists(marker)
    if complete:
        for entry in store.listStatus(folder):
            moved = entry.getPath()
            if moved.getName() in (COMPLETE, NOTES):
                continue
            place, _ = _opened(spark, f"{out_dir.rstrip('/')}/{moved.getName()}")
            store.delete(place, True)
            if not store.rename(moved, place):
                raise OSError(f"cannot move {moved} to {place}")
    if complete or not keep_unfinished:
        store.delete(folder, True)
    return complete


def publish(spark: SparkSession, out_dir: str) -> None:
    """Put all staged tables in place."""
    mark_complete(spark, out_dir)
    settle(spark, out_dir)


def write_note(spark: SparkSession, staged: str, name: str, note: dict) -> None:
    """A note of the run below ``staged``, there whole or not at all."""
    target, store = _opened(spark, f"{staged}/{NOTES}/{name}")
    draft, _ = _opened(spark, f"{staged}/{NOTES}/{name}.draft")
    stream = store.create(draft, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()
    store.delete(target, False)
    if not store.rename(draft, target):
        raise OSError(f"cannot move {draft} to {target}")


def read_note(spark: SparkSession, staged: str, name: str) -> dict | None:
    target, store = _opened(spark, f"{staged}/{NOTES}/{name}")
    if not store.exists(target):
        return None
    stream = store.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def drop_note(spark: SparkSession, staged: str, name: str) -> None:
    target, store = _opened(spark, f"{staged}/{NOTES}/{name}")
    store.delete(target, False)


def files_fingerprint(spark: SparkSession, pattern: str) -> str:
    """Names, sizes and times of the files that ``pattern`` matches, as one text.

    Spark lists them and adds up their hashes; contents are not read.
    """
    files = spark.read.format("binaryFile").load(pattern)
    mark = F.xxhash64("path", "length", "modificationTime")
    found = files.agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.bit_xor(mark).alias("marks")
    ).first()
    return f"{pattern}:{found['n']}:{found['size']}:{found['marks']}"
