"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables that stage() has written, by path.
_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset (local tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='tributary-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: the lineage is cut, and lost executors cost no recomputation.

    The files stay until discard(), release() or the end of the driver, since a lazy result may still read them. by: a
    column that each has a folder of its own for.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tributary-{uuid.uuid4().hex}-{name}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._tributary_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of stage() that nothing reads any more; what was made from them must have been staged itself. Other tables are left alone."""
    for t in tables:
        if path := getattr(t, "_tributary_path", None):
            _delete(path)


def _delete(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that discard()'s and release()'s rules hold for, too."""
    path = f"{shared_dir(spark)}/tributary-{uuid.uuid4().hex}-{name}"
    _written[path] = spark
    return path


def release() -> None:
    """Deletes every table that stage() has written. Only call it when no result that reads them is needed any more."""
    for path in list(_written):
        try:
            _delete(path)
        except Exception:  # the session has ended, and the driver with it
            return


atexit.register(release)
