"""Sources and sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a local master gets one of this machine's
    own; a cluster has no folder that could be taken for it, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


#: Folders that ``written`` has made in this process, for ``cleanup``.
_MADE: list[str] = []


def cleanup(spark: SparkSession) -> int:
    """Deletes what ``written`` has left in the shared folder, once no DataFrame made from it is needed; returns the number of folders."""
    count = len(_MADE)
    _delete(spark, _MADE)
    return count


def _delete(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def only(run: Callable[[], DataFrame], name: str) -> DataFrame:
    """``written(run(), name)``, with all that ``run`` itself has written deleted, as nothing else refers to it: of a step of many rounds its result
    alone stays on disk."""
    start = len(_MADE)
    out = written(run(), name)
    gone = _MADE[start:-1]
    del _MADE[start:-1]
    _delete(out.sparkSession, gone)
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` has made and that a later one has taken the place of."""
    gone = [t.written_to for t in tables if t.written_to in _MADE]
    for path in gone:
        _MADE.remove(path)
    if tables:
        _delete(tables[0].sparkSession, gone)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again: later jobs start from those files, not from
    the work before them, and a lost executor costs no more than its own tasks."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out
