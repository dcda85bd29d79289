"""Small files and folders on whatever file system Spark writes to."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What is in the folder, sorted; nothing if there is no such folder."""
    files = _system(spark, folder)
    if not files.exists(_path(spark, folder)):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(_path(spark, folder)))


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder was committed."""
    return exists(spark, f"{folder}/_SUCCESS")


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    source = _system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file with the whole text, by renaming a finished one; false if there is one of that name
    already, which stays as it is. Whoever looks sees all of the file or none."""
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    target = _system(spark, aside).create(_path(spark, aside), True)
    try:
        target.write(bytearray(text.encode()))
    finally:
        target.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(_path(spark, path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep_others = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, aside), _path(spark, path), keep_others)
    except Py4JJavaError as failed:
        if failed.java_exception.getClass().getName() != "org.apache.hadoop.fs.FileAlreadyExistsException":
            raise
        delete(spark, aside)
        return False
    return True


def publish_folder(spark: SparkSession, aside: str, path: str) -> None:
    """Put a finished folder in its place: a stream that reads there meets all of its files or none."""
    _system(spark, path).mkdirs(_path(spark, path.rpartition("/")[0]))
    if not _system(spark, path).rename(_path(spark, aside), _path(spark, path)):
        raise OSError(f"{aside} cannot become {path}")
