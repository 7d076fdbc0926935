"""Small files on whatever file system a path names."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _on(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str | None) -> bool:
    """Is there something at the path?"""
    if path is None:
        return False
    fs, target = _on(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if there is no folder."""
    fs, target = _on(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _on(spark, path)
    fs.delete(target, True)


def read_json(spark: SparkSession, path: str):
    fs, target = _on(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_json(spark: SparkSession, path: str, value) -> None:
    """Write a new file that readers see whole or not at all: it is renamed last."""
    fs, target = _on(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    folder, _, name = path.rpartition("/")
    _, hidden = _on(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(hidden, True)
    try:
        stream.write(bytearray(json.dumps(value, indent=1).encode()))
    finally:
        stream.close()
    if not fs.rename(hidden, target):
        raise FileExistsError(path)


def fingerprint(spark: SparkSession, path: str | None) -> str | None:
    """Names, sizes and times of the files at a path or glob; None if there are none."""
    if path is None:
        return None
    fs, target = _on(spark, path)
    found = fs.globStatus(target)
    listed = []
    for top in found or []:
        inner = fs.listStatus(top.getPath()) if top.isDirectory() else [top]
        listed += [[s.getPath().toString(), s.getLen(), s.getModificationTime()] for s in inner]
    return json.dumps(sorted(listed)) if listed else None
