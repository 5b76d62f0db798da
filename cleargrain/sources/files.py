"""Single files and folders on the file system of a path, through Hadoop."""

from __future__ import annotations

import os
import uuid
from typing import Any

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path with its scheme."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    return system, system.makeQualified(place)


def listed(spark: SparkSession, folder: str) -> dict[str, float]:
    """Names in a folder and the seconds since 1970 of their last change; none if there is no such folder."""
    system, place = _on(spark, folder)
    if not system.exists(place):
        return {}
    return {found.getPath().getName(): found.getModificationTime() / 1000 for found in system.listStatus(place)}


def read_text(spark: SparkSession, path: str) -> str:
    """A small file whole."""
    system, place = _on(spark, path)
    stream = system.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does.

    Of several writers of one path exactly one succeeds: on a local file system by
    linking a finished file to the name, elsewhere by the file system's exclusive
    create. A store whose create is not exclusive allows one writer at a time.
    """
    system, place = _on(spark, path)
    system.mkdirs(place.getParent())
    if place.toUri().getScheme() == "file":
        final = place.toUri().getPath()
        draft = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}"
        with open(draft, "x", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(draft, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    try:
        stream = system.create(place, False)
    except Exception:
        if system.exists(place):
            return False
        raise
    stream.write(text.encode())
    stream.close()
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another name in one step, in place of a file or folder there before."""
    system, begin = _on(spark, source)
    _, end = _on(spark, target)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    if system.exists(end) and system.getFileStatus(end).isDirectory():
        system.delete(end, True)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(begin.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(begin, end, options)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it; nothing if there is none."""
    system, place = _on(spark, path)
    system.delete(place, True)
