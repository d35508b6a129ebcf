"""Results kept once in the folder that all executors share, so that lost executors cost no recomputation.

durable() tables last until the process ends, until release(), or, inside settled(), until the result that is made from them is written.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_PLACE = "_quern_place"
_local: str | None = None
_kept: set[str] = set()


def _shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder the context has been given; a temporary one where neither is set and all runs on this machine."""
    global _local
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    _local = _local or "file://" + tempfile.mkdtemp(prefix="quern-")
    return _local


def _delete(path: str) -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None:
        with contextlib.suppress(Exception):  # what can't be deleted any more only takes space
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _kept.discard(path)


@atexit.register
def _delete_all() -> None:
    for path in list(_kept):
        _delete(path)


def durable(df: DataFrame) -> DataFrame:
    """df's rows, computed once and written as a table in the shared folder, from which they are read on.

    The table lasts until the Python process ends, or until release(). Its files are packed into few partitions as they are read.
    """
    path = f"{_shared(df.sparkSession)}/quern-{uuid.uuid4().hex}"
    _kept.add(path)
    df.write.option("compression", "zstd").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    setattr(kept, _PLACE, path)
    return kept


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """durable(make()), after which the other tables that make() kept on its way are deleted."""
    before = set(_kept)
    done = durable(make())
    for path in _kept - before - {getattr(done, _PLACE)}:
        _delete(path)
    return done


def release(*frames: DataFrame | None) -> None:
    """Deletes the tables behind frames that durable() returned; nothing may read them, or what was made from them, afterwards."""
    for df in frames:
        path = getattr(df, _PLACE, None)
        if path:
            _delete(path)
