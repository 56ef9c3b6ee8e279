"""Small files beside tables, in whatever store Spark's paths lead to: listed, read, written whole or not at all, removed."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names of a folder's files and folders, in order; none if there is no such folder."""
    path, system = _path(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(path)) if system.exists(path) else []


def sizes(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of each file of a folder, hidden ones left out."""
    path, system = _path(spark, folder)
    return [s.getLen() for s in system.listStatus(path) if s.isFile() and s.getPath().getName()[0] not in "._"]


def read(spark: SparkSession, path: str) -> str:
    where, system = _path(spark, path)
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Puts a new file there, which others see whole or not at all; false if there is one already."""
    jvm = spark.sparkContext._jvm
    where, system = _path(spark, path)
    beside, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = system.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    from py4j.protocol import Py4JJavaError

    try:
        # Unlike a file system's own rename this one refuses to take a name that is taken.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), system.getConf()).rename(system.makeQualified(beside), system.makeQualified(where), none)
    except Py4JJavaError as e:
        system.delete(beside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    return True


def remove(spark: SparkSession, path: str) -> None:
    where, system = _path(spark, path)
    system.delete(where, True)
