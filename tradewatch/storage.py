"""The driver's few file-system calls, on any storage that the session's Spark can reach."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Files opened at the same time to read their first line.
OPEN_AT_ONCE = 32


@dataclass(frozen=True)
class Entry:
    name: str
    modified_ms: int


class Storage:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def qualified(self, path: str) -> str:
        """The full, decoded form in which Spark names files below ``path``."""
        fs, p = self._at(path)
        return fs.makeQualified(p).toString()

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def entries(self, folder: str) -> list[Entry]:
        """What stands in a folder (nothing if there is none)."""
        fs, p = self._at(folder)
        if not fs.exists(p):
            return []
        return [Entry(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)]

    def touch(self, path: str) -> None:
        fs, p = self._at(path)
        fs.create(p, True).close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def first_line(self, path: str) -> str | None:
        fs, p = self._at(path)
        reader = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    def headers(self, paths: list[str]) -> list[tuple[str, ...]]:
        """Column names of CSV files, from their first lines (an empty file has none)."""

        def one(path: str) -> tuple[str, ...]:
            line = self.first_line(path)
            return tuple(next(csv.reader([line.removeprefix("﻿")]), ())) if line else ()

        with ThreadPoolExecutor(max_workers=OPEN_AT_ONCE) as pool:
            return list(pool.map(one, paths))


def literally(path: str) -> str:
    """A path whose names stand for themselves where Spark would read them as patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
