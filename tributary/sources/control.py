"""Control tables of a consumer group: checkpoints, workers, assignments, metadata.

They have tens of rows. The file store keeps each table as one JSON file that is
replaced by an atomic rename under a lock file made with O_EXCL, on a folder
with POSIX semantics that all workers share.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any, Protocol

Rows = dict[str, dict[str, Any]]


class ControlStore(Protocol):
    def read(self, table: str) -> Rows: ...

    def update(self, table: str, change: Callable[[Rows], Any]) -> Any:
        """Apply ``change`` to a table's rows alone, store them, and return its result."""

    def now(self) -> float:
        """Epoch seconds by a clock that all workers share."""


class MemoryControlStore:
    """For tests and single processes."""

    def __init__(self) -> None:
        self.tables: dict[str, Rows] = {}

    def read(self, table: str) -> Rows:
        return json.loads(json.dumps(self.tables.get(table, {})))

    def update(self, table: str, change: Callable[[Rows], Any]) -> Any:
        rows = self.read(table)
        result = change(rows)
        self.tables[table] = rows
        return result

    def now(self) -> float:
        return time.time()


class LockLost(RuntimeError):
    """Another worker took the lock of one that seemed dead."""


class FileControlStore:
    """``stale_s`` is how old a lock is that its holder must have left behind; ``wait_s`` how long to wait for one."""

    def __init__(self, folder: str | Path, stale_s: float = 30.0, wait_s: float = 60.0):
        self.folder, self.stale_s, self.wait_s = Path(folder), stale_s, wait_s
        self.folder.mkdir(parents=True, exist_ok=True)

    def read(self, table: str) -> Rows:
        try:
            return json.loads((self.folder / f"{table}.json").read_text())
        except FileNotFoundError:
            return {}

    def update(self, table: str, change: Callable[[Rows], Any]) -> Any:
        with self._locked(table) as held:
            rows = self.read(table)
            result = change(rows)
            draft = self.folder / f".{table}.{uuid.uuid4().hex}"
            draft.write_text(json.dumps(rows))
            if not held():
                draft.unlink()
                raise LockLost(table)
            os.replace(draft, self.folder / f"{table}.json")
            return result

    def now(self) -> float:
        """The file server's clock, read off a file written there."""
        probe = self.folder / f".clock.{uuid.uuid4().hex}"
        probe.touch()
        try:
            return probe.stat().st_mtime
        finally:
            probe.unlink()

    @contextmanager
    def _locked(self, table: str) -> Iterator[Callable[[], bool]]:
        """Hold a table's lock, a file with its holder's name; yields whether it is still held."""
        lock, me = self.folder / f"{table}.lock", uuid.uuid4().hex
        end = time.monotonic() + self.wait_s
        patient = time.monotonic() + min(1.0, self.stale_s)
        while not _create(lock, me):
            if time.monotonic() > patient:
                self._break_stale(lock)
                patient = time.monotonic() + 1
            if time.monotonic() > end:
                raise TimeoutError(f"no lock on {table} within {self.wait_s} s")
            time.sleep(0.01)

        def held() -> bool:
            try:
                return lock.read_text() == me
            except FileNotFoundError:
                return False

        try:
            yield held
        finally:
            if held():
                lock.unlink(missing_ok=True)

    def _break_stale(self, lock: Path) -> None:
        """Remove a lock that its holder left behind. Only one worker may do so at a time, and looks again before it does."""
        if not self._is_stale(lock):
            return
        breaker = lock.with_suffix(".breaker")
        if not _create(breaker, ""):
            if self._is_stale(breaker):
                breaker.unlink(missing_ok=True)
            return
        try:
            if self._is_stale(lock):
                lock.unlink(missing_ok=True)
        finally:
            breaker.unlink(missing_ok=True)

    def _is_stale(self, lock: Path) -> bool:
        try:
            return self.now() - lock.stat().st_mtime > self.stale_s
        except FileNotFoundError:
            return False


def _create(path: Path, text: str) -> bool:
    """Write a file unless it exists."""
    try:
        at = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    except FileExistsError:
        return False
    os.write(at, text.encode())
    os.close(at)
    return True
