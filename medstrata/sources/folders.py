"""Listing of lake folders through the file system Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, file_system = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop_path, file_system = _file_system(spark, path)
    return file_system.exists(hadoop_path) and file_system.getFileStatus(hadoop_path).isDirectory()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, in name order; they reach Python as one text."""
    hadoop_path, _ = _file_system(spark, pattern)
    text = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(hadoop_path).mkString("\n")
    return sorted(text.split("\n")) if text else []


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small text file (a schema or a marker, not data)."""
    hadoop_path, file_system = _file_system(spark, path)
    stream = file_system.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace one small text file."""
    hadoop_path, file_system = _file_system(spark, path)
    stream = file_system.create(hadoop_path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def create_empty(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet, in one step; whether it did not."""
    hadoop_path, file_system = _file_system(spark, path)
    try:
        file_system.create(hadoop_path, False).close()
    except Py4JJavaError as error:
        if file_system.exists(hadoop_path):
            return False
        raise error
    return True


def modified(spark: SparkSession, path: str) -> float | None:
    """When a file was last written, in seconds; None if there is none."""
    hadoop_path, file_system = _file_system(spark, path)
    try:
        return file_system.getFileStatus(hadoop_path).getModificationTime() / 1000
    except Py4JJavaError as error:
        if file_system.exists(hadoop_path):
            raise error
        return None


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path, file_system = _file_system(spark, path)
    file_system.delete(hadoop_path, True)
