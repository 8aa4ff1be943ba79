"""Stages: tables written once in the folder that the driver and all executors share, and read back.

Writing a stage cuts the lineage: a lost executor costs the rows that are being read, not the plan that made them.
"""

from __future__ import annotations

import atexit
import shutil
import threading
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no checkpoint folder and all tasks run on this machine.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Tables up to this measured size are marked for broadcast.
BROADCAST_BYTES = 64 << 20

_written: list[tuple[SparkSession, str]] = []
_inside = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"file://{LOCAL_CHECKPOINTS}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table that goes when the driver ends."""
    path = f"{shared_folder(spark)}/biblioflow/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def staged(df: DataFrame, name: str, codec: str = "zstd", options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet and read back; the table goes when the driver ends, or by ``release``."""
    path = new_path(df.sparkSession, name)
    df.write.options(compression=codec, **(options or {})).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stage_path = path
    if getattr(_inside, "scopes", None):
        _inside.scopes[-1].append(out)
    return out


def releasing(made: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose result is written as a stage before the stages that it made on its way are deleted."""

    @wraps(made)
    def run(*args, **kwargs) -> DataFrame:
        scopes = _inside.__dict__.setdefault("scopes", [])
        scopes.append([])
        try:
            result = made(*args, **kwargs)
        finally:
            own = scopes.pop()
        out = staged(result, made.__name__)
        for df in own:
            release(df)
        return out

    return run


def delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(df: DataFrame) -> None:
    """Delete a stage that nothing reads any more."""
    delete(df.sparkSession, df.stage_path)
    _written.remove((df.sparkSession, df.stage_path))


def stored(spark: SparkSession, name: str, data: bytes) -> str:
    """The path of a file with ``data`` in the shared folder; it goes when the driver ends."""
    folder = new_path(spark, "file")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return f"{folder}/{name}"


@atexit.register
def drop_stages() -> None:
    """Delete the stages: through the session if it still lives, else those in the local folder."""
    while _written:
        spark, path = _written.pop()
        context = spark.sparkContext
        if context._jsc is None:
            if path.startswith(f"file://{LOCAL_CHECKPOINTS}/"):
                shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        else:
            delete(spark, path)


#: Rows that a task gets where rows are dealt by their number.
ROWS_A_PART = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` into as many partitions as keep a task at about ROWS_A_PART of its ``rows``, however well these compress."""
    return df.repartition(max(1, -(-rows // ROWS_A_PART)), *keys)


def sized(df: DataFrame, width: Column | int) -> DataFrame:
    """A staged ``df``, marked for broadcast if its rows, ``width`` bytes each, are measured to be small enough."""
    n = df.agg(F.sum(F.lit(width) if isinstance(width, int) else width)).first()[0] or 0
    return F.broadcast(df) if n <= BROADCAST_BYTES else df
