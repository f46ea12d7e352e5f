"""Written intermediate tables, in the folder that the cluster names in ``spark.checkpoint.dir``.

Reading such a table back cuts the lineage: later jobs do not compute it again, and no executor's loss can
take it away.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Paths stored within calls of ``stored_alone`` that are under way, innermost last.
_inner: list[list[str]] = []


def _base(spark: SparkSession) -> str:
    """The named folder; else the session's checkpoint folder; else, on one machine, a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The session's own folder; it is removed when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{_base(spark).rstrip('/')}/tidemark-{app}"
        atexit.register(clear_scratch, spark)
    return _roots[app]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the session's scratch tables. Call it only when no result that reads them is still needed."""
    root = _roots.pop(spark.sparkContext.applicationId, None) if spark.sparkContext._jsc else None
    if root:
        delete_path(spark, root)


def delete_path(spark: SparkSession, path: str) -> None:
    """Missing paths are no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[out] = path
    if _inner:
        _inner[-1].append(path)
    return out


def stored_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, written and read back; the tables that it has stored itself are then deleted."""
    _inner.append([])
    try:
        out = stored(make(), name)
    finally:
        inner = _inner.pop()
    for path in inner[:-1]:  # the last one is the result
        delete_path(out.sparkSession, path)
    if _inner:
        _inner[-1].append(inner[-1])
    return out


def forget_plans(spark: SparkSession) -> None:
    """Let the plans of finished jobs go, on both sides of the driver: Spark deletes shuffle files when the
    plans that wrote them have been collected, and its heap shrinks again."""
    gc.collect()
    spark._jvm.System.gc()


def release(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = _paths.pop(df, None)
        if path:
            delete_path(df.sparkSession, path)
