"""Small metadata operations of the Hadoop file system (any store Spark
reads). No data passes through the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, sorted; none if there is no folder."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _at(spark, old)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")
