"""Numbered control records below a warehouse: key ranges, load numbers and current table versions.

A record is one small file whose name is its number. Creating a file that must not exist yet is the only operation that
decides anything, so that of two runs which want the same number one gets it and the other one sees that it is taken.
This needs a file system on which such a creation is atomic (HDFS or ABFS; on a local disk, one process at a time).
"""

from __future__ import annotations

import json
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(ValueError):
    """The number has been claimed before."""


class Control:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def exists(self, path: str) -> bool:
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self._conf).exists(at)

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def numbers(self, kind: str) -> list[int]:
        """Numbers claimed so far, ascending."""
        folder = self._path(kind)
        fs = folder.getFileSystem(self._conf)
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def claim(self, kind: str, number: int, record: dict | None = None) -> int:
        """Take exactly this number, or raise ``Taken``."""
        path = self._path(kind, f"{number:012d}")
        fs = path.getFileSystem(self._conf)
        try:
            out = fs.create(path, False)
        except Py4JJavaError as e:
            if "exist" in str(e.java_exception).lower():
                raise Taken(f"{kind} {number} has been used") from None
            raise
        out.write(json.dumps(record or {}).encode())
        out.close()
        return number

    def claim_next(self, kind: str, record: dict | None = None, count: int = 1) -> list[int]:
        """Take the next ``count`` numbers beyond all claimed ones; those that another run takes meanwhile are left out."""
        taken, number = [], (self.numbers(kind) or [0])[-1]
        while len(taken) < count:
            number += 1
            try:
                taken.append(self.claim(kind, number, record))
            except Taken:
                pass
        return taken

    def read(self, kind: str, number: int) -> dict | None:
        """A record's content; None while it is being written, or if its writer died before it was."""
        path = self._path(kind, f"{number:012d}")
        fs = path.getFileSystem(self._conf)
        size = fs.getFileStatus(path).getLen()
        stream = fs.open(path)
        text = bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode() if size else ""
        stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def latest(self, kind: str, wait: float = 2.0) -> tuple[int, dict]:
        """The newest readable record and the largest number; (0, {}) before the first.

        A record that is still unreadable after ``wait`` seconds is passed over: its writer has died.
        """
        numbers = self.numbers(kind)
        for n in reversed(numbers):
            until = time.time() + wait
            while (record := self.read(kind, n)) is None and time.time() < until:
                time.sleep(0.05)
            if record is not None:
                return numbers[-1], record
        return (numbers or [0])[-1], {}
