"""Shared tables that are renewed after some time.

A table is written as a version with the time it was taken; readers hold a version while they use it. The first reader after it has
expired takes a new one. An old version is deleted as soon as nobody reads it, so no query loses files under its feet.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, new_path
from .schemas import MAIN_TABLES
from .tables import Tables

#: Seconds after which a version is renewed.
EXPIRY = 600


@dataclass(eq=False)
class Version:
    number: int
    taken: float
    path: str
    frame: DataFrame
    readers: int = 0
    current: bool = True


class Snapshots:
    """Named sources as versions in the shared folder, each renewed on its own.

    ``sources``: functions that give a table as it is now. A source that fails leaves the current version in place and raises.
    Sessions on several threads share one object: a table is written once, whoever asks meanwhile waits for that table only.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], seconds: float = EXPIRY,
                 clock: Callable[[], float] = time.time):
        self.spark, self.sources, self.seconds, self.clock = spark, dict(sources), seconds, clock
        self._current: dict[str, Version] = {}
        self._held: list[Version] = []
        self._lock = threading.Lock()
        self._taking = {name: threading.Lock() for name in self.sources}

    def _fresh(self, name: str) -> bool:
        version = self._current.get(name)
        return version is not None and self.clock() - version.taken < self.seconds

    def _take(self, name: str) -> None:
        taken = self.clock()  # what changes while the table is written is in the next version
        path = new_path(self.spark, f"snapshot-{name}")
        df = self.sources[name]()
        try:
            df.write.parquet(path)
        except Exception:
            delete_path(self.spark, path)
            raise
        with self._lock:
            old = self._current.get(name)
            self._current[name] = Version(old.number + 1 if old else 1, taken, path, self.spark.read.schema(df.schema).parquet(path))
            self._held.append(self._current[name])
            if old:
                old.current = False
        self._free()

    def _free(self) -> None:
        with self._lock:
            gone = [v for v in self._held if not v.current and not v.readers]
            self._held = [v for v in self._held if v not in gone]
        for version in gone:
            delete_path(self.spark, version.path)

    @contextmanager
    def version(self, name: str) -> Iterator[Version]:
        """The current version of a table, which stays readable inside the block."""
        with self._taking[name]:
            if not self._fresh(name):
                self._take(name)
            with self._lock:
                version = self._current[name]
                version.readers += 1
        try:
            yield version
        finally:
            with self._lock:
                version.readers -= 1
            self._free()

    @contextmanager
    def tables(self) -> Iterator[Tables]:
        """The five main tables; each is taken or renewed on first use and stays readable inside the block."""
        with ExitStack() as stack:
            yield Tables(*[lambda name=name: stack.enter_context(self.version(name)).frame for name in MAIN_TABLES])

    def expire(self, name: str | None = None) -> None:
        """Renew one table, or all, at their next use, however young."""
        with self._lock:
            for version in ([self._current[name]] if name else self._current.values()):
                version.taken = float("-inf")

    def held(self) -> list[tuple[str, int, int]]:
        """(path, version, readers) of what lies in the shared folder."""
        with self._lock:
            return [(v.path, v.number, v.readers) for v in self._held]

    def close(self) -> None:
        """Delete every version that nobody reads, the current ones too."""
        with self._lock:
            for version in self._held:
                version.current = False
            self._current.clear()
        self._free()
