"""Small documents that are written once: of several writers of one path, one wins."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a document unless there is one; True for the writer that did.

    The text is complete before its name appears: it is written beside and then linked (local disk) or
    renamed without overwriting (other file systems, where this is one step of the name service).
    """
    target, fs = _path(spark, path)
    if fs.exists(target):
        return False
    parent, part = target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}"
    fs.mkdirs(parent)
    if fs.getScheme() == "file":
        folder = parent.toUri().getPath()
        with open(f"{folder}/{part}", "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(f"{folder}/{part}", target.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            os.unlink(f"{folder}/{part}")
        return True
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(parent, part)
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(beside, fs.makeQualified(target), never)
    except Exception:
        fs.delete(beside, False)
        if fs.exists(target):
            return False
        raise
    return True


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of parts that only its writer knows; one that is not there is no error."""
    target, fs = _path(spark, path)
    fs.delete(target, True)


def document(spark: SparkSession, path: str) -> str | None:
    """The text of a document; None if there is none."""
    target, fs = _path(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def documents(spark: SparkSession, folder: str) -> list[str]:
    """Names of the documents of a folder, in order."""
    target, fs = _path(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(n for s in fs.listStatus(target) if not (n := s.getPath().getName()).startswith("."))
