"""Versions of a result: every run writes a folder of its own, and the newest published one is the result.

    root/v=<name>/            the files of one run
    root/_tickets/<name>      taken when the run starts; names sort in that order
    root/_published/<name>    made when the run's files are complete
    root/_reading/<name>@..   held while somebody reads that version

The newest published ticket is the live version, so a run that started earlier but ends later never replaces a newer
one, whatever the order of their last steps, and a run that fails leaves the live version as it is.  Only creating,
listing and deleting of whole files is asked of the storage (no renaming, no locks): two runs that take the same number
at the same moment are ordered by the random part of their names.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tradewatch.storage import Storage

TICKETS, PUBLISHED, READING = "_tickets", "_published", "_reading"


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.root, self.storage = root.rstrip("/"), Storage(spark)

    def _names(self, folder: str) -> list[str]:
        return sorted(e.name for e in self.storage.entries(f"{self.root}/{folder}") if not e.name.startswith("."))

    def begin(self) -> str:
        """The ticket of a run that starts now: later than all before it."""
        last = max(self._names(TICKETS) + self._names(PUBLISHED), default="0-")
        name = f"{int(last.split('-')[0]) + 1:012d}-{uuid.uuid4().hex[:12]}"
        self.storage.touch(f"{self.root}/{TICKETS}/{name}")
        return name

    def path(self, name: str) -> str:
        return f"{self.root}/v={name}"

    def publish(self, name: str) -> bool:
        """Declares a run's files complete; False if a newer run was there first."""
        self.storage.touch(f"{self.root}/{PUBLISHED}/{name}")
        return self.newest() == name

    def newest(self) -> str | None:
        return max(self._names(PUBLISHED), default=None)

    def live_path(self) -> str | None:
        name = self.newest()
        return None if name is None else self.path(name)

    def discard(self, name: str) -> None:
        """Removes what a failed run has left."""
        self.storage.delete(self.path(name))
        self.storage.delete(f"{self.root}/{TICKETS}/{name}")

    @contextmanager
    def reading(self) -> Iterator[str | None]:
        """The live version's folder, kept from being cleaned while the block runs."""
        while True:
            name = self.newest()
            if name is None:
                yield None
                return
            lease = f"{self.root}/{READING}/{name}@{uuid.uuid4().hex}"
            self.storage.touch(lease)
            if self.newest() == name:  # no cleaner can have judged this version outdated before the lease was there
                break
            self.storage.delete(lease)
        try:
            yield self.path(name)
        finally:
            self.storage.delete(lease)

    def clean(self, unfinished_hours: float = 24, lease_hours: float = 24) -> list[str]:
        """Deletes versions older than the live one that nobody reads; returns their names.

        A version that was never published goes once its ticket is ``unfinished_hours`` old (its run is taken to be
        dead), a lease counts for ``lease_hours`` (its reader is taken to be gone then).
        """
        now = time.time() * 1000
        newest = self.newest()
        read = {e.name.split("@")[0] for e in self.storage.entries(f"{self.root}/{READING}") if now - e.modified_ms < lease_hours * 3_600_000}
        published = set(self._names(PUBLISHED))
        started = {e.name: e.modified_ms for e in self.storage.entries(f"{self.root}/{TICKETS}")}
        gone = []
        for entry in self.storage.entries(self.root):
            if not entry.name.startswith("v="):
                continue
            name = entry.name[2:]
            dead = name in published or now - started.get(name, 0) >= unfinished_hours * 3_600_000
            if name != newest and name not in read and dead:
                self.discard(name)
                self.storage.delete(f"{self.root}/{PUBLISHED}/{name}")
                gone.append(name)
        return sorted(gone)
