"""Files and folders of the warehouse, on whatever file system it lies."""

from __future__ import annotations

import os
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """A path as the file system's own, and that file system. ``path`` is a URI, as Spark gives those
    of files; locations of tables come unquoted."""
    jvm = spark.sparkContext._jvm
    plain = quote(path, safe="/:%@+,;=~!$&'()*") != path
    place = jvm.org.apache.hadoop.fs.Path(path if plain else jvm.java.net.URI(path))
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _if_missing(error: Py4JJavaError, value):
    """``value`` where a file is not there, or not any more."""
    if error.java_exception.getClass().getSimpleName() != "FileNotFoundException":
        raise error
    return value


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _at(spark, path)
    return fs.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    place, fs = _at(spark, path)
    fs.mkdirs(place)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it; nothing if it is not there."""
    place, fs = _at(spark, path)
    fs.delete(place, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """URIs of what lies in a folder; none if it is not there."""
    place, fs = _at(spark, path)
    if not fs.exists(place):
        return []
    return sorted(s.getPath().toUri().toString() for s in fs.listStatus(place))


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename within one file system; whether it was done."""
    place, fs = _at(spark, path)
    return fs.rename(place, _at(spark, to)[0])


def age(spark: SparkSession, path: str) -> float | None:
    """Seconds since a file was written; None if it is not there."""
    place, fs = _at(spark, path)
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    try:
        return (now - fs.getFileStatus(place).getModificationTime()) / 1000
    except Py4JJavaError as e:
        return _if_missing(e, None)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file; empty if it is not there."""
    place, fs = _at(spark, path)
    try:
        stream = fs.open(place)
    except Py4JJavaError as e:
        return _if_missing(e, "")
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, and nothing written, if there is one already.

    Of several callers at once one gets True: local files are created exclusively, other
    file systems are asked not to overwrite, which HDFS and object stores with
    conditional writes decide in one step."""
    place, fs = _at(spark, path)
    fs.mkdirs(place.getParent())
    if place.toUri().getScheme() in (None, "file"):
        try:
            handle = os.open(place.toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as file:
            file.write(text)
        return True
    try:
        stream = fs.create(place, False)
    except Py4JJavaError:
        if fs.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True
