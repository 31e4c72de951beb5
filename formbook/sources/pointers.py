"""Numbered markers in a folder: run ids, and pointers to the version that holds.

A marker is created only if its number is free, so that of two writers one comes later and none replaces the other's.
That needs a file system whose create without overwrite is atomic, as HDFS and local disks have it. A marker holds one
line of JSON; a line without its end is not yet written and does not count.
"""

import json
import os
from urllib.parse import urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    """File system and path object of Hadoop."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(where)


def create_only(spark: SparkSession, path: str, content: dict) -> bool:
    """Create a marker; False if there is one already."""
    fs, where = _located(spark, path)
    line = (json.dumps(content) + "\n").encode()
    if fs.getScheme() == "file":  # Hadoop's local create is not atomic
        local = urlparse(where.toString()).path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "xb") as f:
                f.write(line)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(where, False)
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    try:
        out.write(bytearray(line))
    finally:
        out.close()
    return True


def read_marker(spark: SparkSession, path: str) -> dict | None:
    """What the marker holds; None if it is missing or not yet written."""
    fs, where = _located(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) if text.endswith("\n") else None


def numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the markers in a folder, ascending."""
    fs, where = _located(spark, folder)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(int(n) for n in names if n.isdigit())


def claim(spark: SparkSession, folder: str, content: dict | None = None) -> int:
    """Create the marker of the next free number, from 1, and return the number."""
    number = max(numbers(spark, folder), default=0) + 1
    while not create_only(spark, f"{folder}/{number:012d}", content or {}):
        number += 1
    return number


def newest(spark: SparkSession, folder: str) -> dict | None:
    """Content of the written marker with the largest number."""
    for number in reversed(numbers(spark, folder)):
        found = read_marker(spark, f"{folder}/{number:012d}")
        if found is not None:
            return found
    return None


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _located(spark, path)
    fs.delete(where, True)
