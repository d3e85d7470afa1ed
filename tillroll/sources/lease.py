"""One writer at a time: a numbered lease on a warehouse.

A load claims the next number by creating its file in the warehouse's control
folder; where the file system creates files exclusively (as HDFS does), two loads
cannot both get it.  The lease is free again when its holder releases it, also on an
error, or has not renewed it for ``EXPIRES`` seconds, as after a kill.  A holder
checks at every renewal that no later number was given out, and stops if one was, so
a load that was taken for dead publishes nothing beside its successor.  It asks before
each step; a single write that hangs longer than ``EXPIRES`` is not caught.  The
numbers order the runs of a warehouse.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .tables import Warehouse

#: Seconds without a renewal after which a lease counts as left behind.
EXPIRES = 6 * 3600
_RELEASED = ".released"


class WarehouseBusy(RuntimeError):
    """Another load holds the warehouse."""


class LeaseLost(RuntimeError):
    """A later load has taken the warehouse over."""


class Lease:
    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark._jvm
        self._path = lambda name="": jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}" if name else folder)
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())
        self.number = 0

    def _files(self) -> dict[str, int]:
        """Name and time (ms) of every file of the folder: those of the last holder, and of one before it at most."""
        if not self._fs.exists(self._path()):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self._fs.listStatus(self._path())}

    def claim(self, expires: float) -> None:
        files = self._files()
        last = max((int(n) for n in files if n.isdigit()), default=0)
        name = f"{last:012d}"
        if last and name + _RELEASED not in files and time.time() - files[name] / 1000 < expires:
            raise WarehouseBusy(f"another load (number {last}) holds {self._path()}")
        if not self._fs.createNewFile(self._path(f"{last + 1:012d}")):
            raise WarehouseBusy(f"another load (number {last + 1}) holds {self._path()}")
        self.number = last + 1
        for old in files:
            self._fs.delete(self._path(old), False)

    def renew(self) -> None:
        """Go on holding the lease; an error if it has gone to another load."""
        if max((int(n) for n in self._files() if n.isdigit()), default=0) != self.number:
            raise LeaseLost(f"load {self.number} was taken for dead and has a successor; it publishes nothing more")
        self._fs.setTimes(self._path(f"{self.number:012d}"), int(time.time() * 1000), -1)

    def release(self) -> None:
        if f"{self.number:012d}" in self._files():
            self._fs.createNewFile(self._path(f"{self.number:012d}{_RELEASED}"))


@contextmanager
def writer_lease(spark: SparkSession, wh: Warehouse, expires: float | None = None) -> Iterator[Lease]:
    """Hold the warehouse for the time of a load."""
    lease = Lease(spark, wh.lease)
    lease.claim(EXPIRES if expires is None else expires)
    try:
        yield lease
    finally:
        lease.release()
