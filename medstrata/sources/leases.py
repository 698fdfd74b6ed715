"""Leases: folders in which the newest mark, kept fresh by its holder, has the say.

A mark is an empty file whose name is a number.  Creating one that is there already fails,
and that is the only step two writers can meet in.  The holder renews its mark several times
within the lease; a mark that is older belongs to a holder that is gone, and whoever creates
the next number takes over.  Nobody removes a mark but its holder and those above it, so a
holder that comes back late cannot end the lease of its successor.
"""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from medstrata.sources import folders

# Seconds that a mark counts without being renewed.
LEASE = 60.0


def _marks(spark: SparkSession, folder: str) -> list[int]:
    found = folders.matching(spark, f"{folder}/mark-*")
    return sorted(int(re.search(r"mark-(\d+)$", path).group(1)) for path in found)


def _age(spark: SparkSession, folder: str, number: int) -> float | None:
    """Seconds since a mark was renewed, None if it is gone; by the file system's own clock."""
    now = f"{folder}/_now-{uuid.uuid4().hex}"
    folders.write_text(spark, now, "")
    try:
        renewed = folders.modified(spark, f"{folder}/mark-{number}")
        return None if renewed is None else folders.modified(spark, now) - renewed
    finally:
        folders.remove(spark, now)


def is_held(spark: SparkSession, folder: str, lease: float = LEASE) -> bool:
    """Whether someone holds the lease; one whose holder is gone is free."""
    marks = _marks(spark, folder)
    age = _age(spark, folder, marks[-1]) if marks else None
    return age is not None and age < lease


class Held:
    """A lease that this process holds until it releases it or ends."""

    def __init__(self, spark: SparkSession, folder: str, number: int, lease: float):
        self.spark, self.folder, self.number = spark, folder, number
        self._done = threading.Event()
        self._renewal = threading.Thread(target=self._renew, args=(lease / 4,), daemon=True)
        self._renewal.start()

    def _renew(self, pause: float) -> None:
        while not self._done.wait(pause):
            if self.lost():
                return
            folders.write_text(self.spark, f"{self.folder}/mark-{self.number}", "")

    def lost(self) -> bool:
        """Whether another one has taken over, because this process was silent for too long."""
        return _marks(self.spark, self.folder)[-1:] != [self.number]

    def release(self) -> None:
        """Give the lease up; an error if it was lost before."""
        self._done.set()
        self._renewal.join()
        lost = self.lost()
        folders.remove(self.spark, f"{self.folder}/mark-{self.number}")
        if lost:
            raise RuntimeError(f"{self.folder}: another one took over after a silence of this process")


def acquire(spark: SparkSession, folder: str, wait: float = 0.0, lease: float = LEASE) -> Held:
    """Take the lease, waiting at most ``wait`` seconds while someone else holds it."""
    until = time.monotonic() + wait
    while True:
        marks = _marks(spark, folder)
        age = _age(spark, folder, marks[-1]) if marks else None
        if age is None or age >= lease:
            number = max(marks, default=0) + 1
            if folders.create_empty(spark, f"{folder}/mark-{number}"):
                for old in marks:
                    folders.remove(spark, f"{folder}/mark-{old}")
                return Held(spark, folder, number, lease)
        if time.monotonic() >= until:
            raise RuntimeError(f"{folder} is held by another writer")
        time.sleep(min(1.0, max(0.05, wait / 20)))


@contextmanager
def held(spark: SparkSession, folder: str, wait: float = 0.0, lease: float = LEASE) -> Iterator[Held]:
    """The lease for the length of a block."""
    mine = acquire(spark, folder, wait, lease)
    try:
        yield mine
    finally:
        mine.release()
