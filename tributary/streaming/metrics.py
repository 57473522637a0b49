"""Operational metrics of one connector and their text exposition."""

from __future__ import annotations

import http.server
import platform
import threading
import time
from collections import defaultdict

import pyspark

VERSION = "0.1.0"
COUNTERS = (
    "insert_total", "update_total", "delete_total", "replace_total", "checkpoint_save_total", "checkpoint_save_error_total", "bootstrap_document_total",
    "partition_acquire_total", "partition_release_total", "resume_token_expired_total", "change_stream_error_total", "change_stream_restart_total", "listener_error_total", "partition_rebalance_total",
)
PREFIX = "tributary"


class Metrics:
    """A registry of its own for each connector. Set times are epoch seconds of the injected clock."""

    def __init__(self, clock=time.time):
        self.clock, self.lock = clock, threading.Lock()
        self.counters: dict[str, int] = dict.fromkeys(COUNTERS, 0)
        self.gauges: dict[str, float] = defaultdict(float, cdc_latency_seconds=0.0, checkpoint_save_latency_seconds=0.0, bootstrap_active=0.0, active_partition_count=0.0, listener_latency_seconds=0.0)
        self.last_event: float | None = None
        self.last_checkpoint: float | None = None

    def add(self, name: str, n: int = 1) -> None:
        with self.lock:
            self.counters[name] += n

    def count_operation(self, operation: str, n: int = 1) -> None:
        self.add(f"{operation}_total", n)
        self.last_event = self.clock()

    def set(self, name: str, value: float) -> None:
        with self.lock:
            self.gauges[name] = float(value)

    def saved(self, latency_s: float) -> None:
        self.add("checkpoint_save_total")
        self.set("checkpoint_save_latency_seconds", latency_s)
        self.last_checkpoint = self.clock()

    def collect(self) -> list[tuple[str, str, float]]:
        """(name, type, value) of all metrics; the event lag only once there was an event, the checkpoint age -1 before the first."""
        now = self.clock()
        with self.lock:
            rows = [(k, "counter", float(v)) for k, v in self.counters.items()] + [(k, "gauge", v) for k, v in self.gauges.items()]
        rows.append(("last_event_time_seconds", "gauge", self.last_event or 0.0))
        if self.last_event is not None:
            rows.append(("event_lag_seconds", "gauge", now - self.last_event))
        rows.append(("time_since_last_checkpoint_seconds", "gauge", -1.0 if self.last_checkpoint is None else now - self.last_checkpoint))
        return [(f"{PREFIX}_{n}", t, v) for n, t, v in rows]

    def exposition(self) -> str:
        lines = [line for n, t, v in self.collect() for line in (f"# TYPE {n} {t}", f"{n} {v:g}")]
        info = f"{PREFIX}_build_info"
        return "\n".join([*lines, f"# TYPE {info} gauge", f'{info}{{version="{VERSION}",runtime="python {platform.python_version()}, spark {pyspark.__version__}"}} 1', ""])


class MetricServer:
    """/metrics, /health and /ready on the loopback address; a taken port moves on by up to 100, then to any."""

    def __init__(self, metrics: Metrics, port: int):
        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                body = {"/metrics": metrics.exposition, "/health": lambda: "OK", "/ready": lambda: "Ready"}.get(self.path)
                self.send_response(200 if body else 404)
                self.send_header("Content-Type", "text/plain; version=0.0.4")
                self.end_headers()
                self.wfile.write((body() if body else "not found").encode())

            def log_message(self, *_: object) -> None:
                pass

        for p in [*range(port, port + 101), 0]:
            try:
                self.server = http.server.ThreadingHTTPServer(("127.0.0.1", p), Handler)
                break
            except OSError:
                continue
        self.port = self.server.server_address[1]
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def close(self) -> None:
        self.server.shutdown()
        self.server.server_close()
