"""Derived names of checkpoints, control tables and workers."""

from __future__ import annotations

import os
import socket
import time


def checkpoint_id(database: str, collection: str, partition: int) -> str:
    return f"{database}_{collection}_partition_{partition}"


def checkpoint_table(collection: str, group: str) -> str:
    return f"{collection}_checkpoints_{group}"


def control_table(base: str, group: str) -> str:
    return f"{base}_{group}"


def worker_id(host: str | None = None, pid: int | None = None, nanos: int | None = None) -> str:
    return f"{host or socket.gethostname()}-{pid or os.getpid()}-{nanos or time.time_ns()}"
