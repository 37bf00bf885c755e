"""Stage tables in the shared folder of spark.checkpoint.dir: they cut lineage, and lost executors don't matter to them.

Tables that nobody dropped go when the driver's Python ends."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: On a shared local folder Hadoop writes a checksum file beside each file, and starts a process for each of the two to set its
#: permissions; scratch tables do without. Other file systems don't look at this.
UNCHECKED = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_LEFT: dict[str, SparkSession] = {}


def root(spark: SparkSession) -> str:
    """The shared folder; only where none is set and all runs in one process (tests), a local one."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="mergewright-"))
        path = context.getCheckpointDir()
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    path = f"{root(spark)}/mergewright/{name}-{uuid.uuid4().hex}"
    _LEFT[path] = spark
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to a fresh table and read back."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**UNCHECKED).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _LEFT.pop(path, None)


def drop(*tables: DataFrame) -> None:
    """Remove tables that staged() wrote and nothing reads any more."""
    for df in tables:
        delete(df.sparkSession, df.staged_path)


@atexit.register
def _drop_the_rest() -> None:
    for path, spark in list(_LEFT.items()):
        with contextlib.suppress(Exception):  # the session may be stopped
            delete(spark, path)
