"""Numbered marks in a shared folder, each given to one writer only.

A mark is a folder named by its number with one small file in it. A writer prepares the
folder under a passing name and renames it: the rename of a folder onto one that is there
fails, or lands inside it, and never replaces it, so the file that stands under the number tells
who was first. This needs a file system whose rename of folders is atomic, as HDFS and
local disks have. Only marks pass the driver, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

_FILE = "mark"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, place = file_system(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, place = file_system(spark, path)
    stream = fs.create(place)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder; nothing if it isn't there."""
    fs, place = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def numbers(spark: SparkSession, folder: str) -> list[int]:
    return [int(n) for n in names(spark, folder) if n.isdigit()]


def content(spark: SparkSession, folder: str, name: int | str) -> str:
    return read_text(spark, f"{folder}/{_named(name)}/{_FILE}").split("\n", 1)[1]


def latest(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """The highest mark's number and content."""
    given = numbers(spark, folder)
    return (given[-1], content(spark, folder, given[-1])) if given else None


def claim(spark: SparkSession, folder: str, name: int | str, text: str) -> bool:
    """Set a mark if nobody has; whether it is ours."""
    token = uuid.uuid4().hex
    passing, target = f"{folder}/_{token}", f"{folder}/{_named(name)}"
    fs, place = file_system(spark, target)
    if fs.exists(place):
        return False
    _write(spark, f"{passing}/{_FILE}", f"{token}\n{text}")
    fs.rename(file_system(spark, passing)[1], place)
    won = read_text(spark, f"{target}/{_FILE}").startswith(token)
    if not won:
        delete(spark, passing)
        delete(spark, f"{target}/_{token}")
    return won


def claim_next(spark: SparkSession, folder: str, make: Callable[[int, str | None], str]) -> tuple[int, str]:
    """Set the next mark, with what ``make`` says of the highest one (its number, 0 if none, and content); asked again after a conflict."""
    while True:
        top = latest(spark, folder)
        number, before = top or (0, None)
        text = make(number, before)
        if claim(spark, folder, number + 1, text):
            return number + 1, text


def _named(name: int | str) -> str:
    return f"{name:012d}" if isinstance(name, int) else name
