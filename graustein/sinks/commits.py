"""Numbered commits: which written folders readers see.

Tables are written first, to new folders. A commit then names them in one small record,
``{root}/_commits/{number}.json``, that holds for every table what is current. The next number is
created only if it does not exist yet, so of two writers one takes it and the other reads the new
state and tries the next number; a writer that names the state it started from gets a ``Conflict``
when one of its tables has changed since. Readers take the record of the greatest number. A record
that a lost writer left half written doesn't parse and is passed over.

Only the record (its size depends on the number of tables and buckets, not on rows) goes through
the driver.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

FOLDER = "_commits"


class Conflict(RuntimeError):
    """Another writer has committed one of the tables since the state was read."""


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p  # noqa: SLF001


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none when it doesn't exist."""
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless it exists; whether it was written."""
    fs, p = file_system(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or "already exists" in str(e.java_exception.getMessage()):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = file_system(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()  # noqa: SLF001
    finally:
        source.close()


def _read(spark: SparkSession, path: str) -> dict | None:
    try:
        record = json.loads(read_text(spark, path))
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in names(spark, f"{root}/{FOLDER}") if n.endswith(".json") and n[:-5].isdigit())


def _path(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:012d}.json"


def state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """(number of the last commit, what it says of every table); (0, {}) before the first."""
    for n in reversed(_numbers(spark, root)):
        record = _read(spark, _path(root, n))
        if record is not None:
            return n, record
    return 0, {}


def commit(spark: SparkSession, root: str, changes: dict, base: tuple[int, dict] | None = None) -> int:
    """Makes ``changes`` (table -> entry) current, all of them at once; returns the commit's number.
    ``base`` is the state that the changes were made from (``state``); without it the last one wins."""
    while True:
        numbers = _numbers(spark, root)
        _, now = state(spark, root)
        if base is not None and any(now.get(t) != base[1].get(t) for t in changes):
            raise Conflict(f"changed by another writer: {sorted(t for t in changes if now.get(t) != base[1].get(t))}")
        number = (numbers[-1] if numbers else 0) + 1
        if create_if_absent(spark, _path(root, number), json.dumps({**now, **changes})):
            return number
