"""Small files and folders of the shared file system, by Spark's own file system client."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if the folder is not there."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(target)) if not n.startswith("."))


def read_json(spark: SparkSession, path: str) -> dict:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def newest(spark: SparkSession, folder: str, name: str) -> tuple[int, dict]:
    """Number and content of the last note published under ``name``; -1 and nothing before the first."""
    numbers = [int(n.rsplit("~", 1)[1]) for n in children(spark, folder) if n.rsplit("~", 1)[0] == name]
    return (max(numbers), read_json(spark, f"{folder}/{name}~{max(numbers):08d}")) if numbers else (-1, {})


def publish(spark: SparkSession, folder: str, name: str, number: int, content: dict) -> None:
    """Write a note under a new number. It appears whole or not at all, and what it names counts
    from then on; notes before the one before it go."""
    fs, target = file_system(spark, f"{folder}/{name}~{number:08d}")
    if fs.exists(target):
        raise FileExistsError(f"{target} was published by another run")
    aside = file_system(spark, f"{folder}/.{uuid.uuid4().hex}")[1]
    stream = fs.create(aside, True)
    stream.write(json.dumps(content).encode())
    stream.close()
    if not fs.rename(aside, target):
        raise FileExistsError(f"{target} was published by another run")
    for old in children(spark, folder):
        if old.rsplit("~", 1)[0] == name and int(old.rsplit("~", 1)[1]) < number - 1:
            remove(spark, f"{folder}/{old}")
