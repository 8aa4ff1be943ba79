"""File tables whose content is replaced as a whole: snapshots behind one pointer.

A table is a folder with ``data/<snapshot>`` for each snapshot and ``_current``, a file that names one of them. A writer fills a new
snapshot, writes a pointer beside the old one and renames it over that, which the file system does at once. So a reader finds the
old table or the new one, whenever a writer dies; what a dead writer left is an orphan that ``clean`` removes, and a retry writes
a snapshot of its own. Of two writers the last one wins, unless they say which snapshot they started from.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


class Conflict(RuntimeError):
    """Another writer has replaced the snapshot that this one started from."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _put(spark: SparkSession, path: str, text: str) -> None:
    out = _files(spark, path).create(_path(spark, path), True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename over the target, at once."""
    context = spark.sparkContext
    fs = context._jvm.org.apache.hadoop.fs
    how = context._gateway.new_array(fs.Options.Rename, 1)
    how[0] = fs.Options.Rename.OVERWRITE
    home = _path(spark, source).getFileSystem(context._jsc.hadoopConfiguration()).getUri()
    fs.FileContext.getFileContext(home, context._jsc.hadoopConfiguration()).rename(_path(spark, source), _path(spark, target), how)


def current(spark: SparkSession, table: str) -> str | None:
    """The snapshot that readers see; None before the first."""
    path = f"{table}/{POINTER}"
    if not _files(spark, path).exists(_path(spark, path)):
        return None
    opened = _files(spark, path).open(_path(spark, path))
    try:
        return bytes(opened.readAllBytes()).decode("utf-8")
    finally:
        opened.close()


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now; a reader keeps the snapshot that it began with until that is cleaned away."""
    found = current(spark, table)
    if found is None:
        raise FileNotFoundError(f"{table} has no snapshot")
    return spark.read.parquet(f"{table}/data/{found}")


def replace(df: DataFrame, table: str, expected: str | None = None, at: Callable[[str], None] = lambda step: None) -> str:
    """Write ``df`` and make it the table's content; the new snapshot's name.

    ``df`` may read the table itself. ``expected``: the snapshot that ``df`` was made from; if it is no longer the current one
    nothing changes, but for two writers in the same instant. ``at`` is called with the name of each step when it is done.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.parquet(f"{table}/data/{name}")
    at("written")
    pointer = f"{table}/{POINTER}-{name}"
    _put(spark, pointer, name)
    at("pointed")
    if expected is not None and current(spark, table) != expected:
        raise Conflict(f"{table}: {current(spark, table)} in place of {expected}")
    _replace(spark, pointer, f"{table}/{POINTER}")
    at("replaced")
    return name


def clean(spark: SparkSession, table: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Delete snapshots and pointers that are not current, nor in ``keep``, of readers still at work; the snapshots deleted.

    It takes a writer at work for a dead one, so it runs when none is.
    """
    alive, gone = {current(spark, table), *keep}, []
    for folder, prefix in ((f"{table}/data", ""), (table, f"{POINTER}-")):
        files = _files(spark, folder)
        if not files.exists(_path(spark, folder)):
            continue
        for status in files.listStatus(_path(spark, folder)):
            name = status.getPath().getName()
            if (prefix and name.startswith(prefix)) or (not prefix and name not in alive):
                files.delete(status.getPath(), True)
                gone += [] if prefix else [name]
    return sorted(gone)
