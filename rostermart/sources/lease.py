"""One writer at a time, with takeover: a lease of limited time and a fencing number.

Every holder has a number of its own, larger than all before; the file of the
largest number says who holds the lease and until when. A holder renews it in the
background while it works. A lease that ran out or was given back may be taken by the
next writer, whose larger number then keeps the former holder from publishing.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from rostermart.sources.files import Files


class ConcurrentLoadError(RuntimeError):
    """Another load is under way, or has taken over or published in between."""


class Lease:
    """Use as ``with Lease(...) as lease``; ``check`` before publishing."""

    def __init__(self, spark: SparkSession, folder: str, owner: str, seconds: float = 600.0):
        self._spark, self._files, self._folder = spark, Files(spark, folder), folder.rstrip("/")
        self.owner, self.seconds, self.fence = owner, seconds, 0
        self._stop = threading.Event()
        self._beat: threading.Thread | None = None

    def _file(self, fence: int) -> str:
        return f"{self._folder}/{fence:012d}"

    def _text(self, released: bool = False) -> str:
        return json.dumps({"owner": self.owner, "until_ms": int((time.time() + self.seconds) * 1000), "released": released})

    def _largest(self) -> int:
        names = [n for n in self._files.names(self._folder) if n.isdigit()]
        return int(names[-1]) if names else 0

    def _held_by(self, fence: int) -> str | None:
        """Who holds the lease with this number, or None if it has run out or was given back."""
        now = int(time.time() * 1000)
        text = self._files.read(self._file(fence))
        if not text:  # its holder has made the file and not yet written into it
            return "a starting load" if self._files.age_ms(self._file(fence), now) < self.seconds * 1000 else None
        held = json.loads(text)
        return None if held["released"] or held["until_ms"] < now else held["owner"]

    def acquire(self) -> Lease:
        last = self._largest()
        holder = self._held_by(last) if last else None
        if holder:
            raise ConcurrentLoadError(f"The load {holder} is under way below {self._folder}")
        if not self._files.create(self._file(last + 1), self._text()):
            raise ConcurrentLoadError(f"Another load has just begun below {self._folder}")
        self.fence = last + 1
        for name in self._files.names(self._folder):
            if name.isdigit() and int(name) < last:
                self._files.delete(f"{self._folder}/{name}")
        self._beat = threading.Thread(target=inheritable_thread_target(self._spark)(self._renew), daemon=True)
        self._beat.start()
        return self

    def _renew(self) -> None:
        while not self._stop.wait(self.seconds / 3):
            if self._largest() != self.fence:
                return
            self._files.write(self._file(self.fence), self._text())

    def check(self) -> None:
        """Raise if the lease went to somebody else."""
        if self._largest() != self.fence:
            raise ConcurrentLoadError(f"The lease of load {self.owner} has been taken over")

    def release(self) -> None:
        self._stop.set()
        if self._beat:
            self._beat.join()
        if self._largest() == self.fence:
            self._files.write(self._file(self.fence), self._text(released=True))

    def __enter__(self) -> Lease:
        return self.acquire()

    def __exit__(self, *_) -> None:
        self.release()
