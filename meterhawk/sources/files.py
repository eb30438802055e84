"""The few file-system calls Spark's readers and writers do not cover, through Hadoop's API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def partition_numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """Sorted values of an integer partition column, from the folder names alone."""
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target) if status.isDirectory()]
    prefix = f"{column}="
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix))
