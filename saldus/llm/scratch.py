"""Where operators put what must outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; one of our own only where it is unset and there are no other machines."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="saldus-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


#: While a table is written: its shuffle files go as soon as it stands, and batches for Python are small even where rows are long.
WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


@contextmanager
def settings(spark: SparkSession, own: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as the block runs."""
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its lineage ends at files that every executor can read."""
    spark = df.sparkSession
    path = folder(spark, name)
    with settings(spark, WHILE_WRITING):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = path
    weakref.finalize(out, _paths.pop, id(out), None)
    return out


_paths: dict[int, str] = {}


def drop(df: DataFrame) -> None:
    """Deletes what `stored` wrote for df; nothing may read it any more."""
    path = _paths.get(id(df))
    if path:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path under the shared folder, whatever store it is in."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
