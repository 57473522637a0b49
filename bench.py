"""Times the headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

HEADLINE = (
    "message_projection", "unified_feed", "update_lookup", "latest_ack", "stream_checkpoint_batches", "bootstrap_checkpoint_batches",
    "contiguous_commit", "snapshot_resume", "start_state", "expected_assignment", "op_rate", "checkpoint_upsert",
)


def stream_batches(spark, sf_dir: str) -> tuple[int, list[float]]:
    """The change log through the running connector: events delivered, and the seconds of each micro-batch."""
    from tributary.plans import fixtures as fx
    from tributary.sources.change_source import ParquetChangeSource
    from tributary.sources.config import Config
    from tributary.sources.control import MemoryControlStore
    from tributary.streaming.connector import Connector

    folder = tempfile.mkdtemp(prefix="bench-")
    rows = fx.log(spark, sf_dir)
    rows.repartitionByRange(8, "token").sortWithinPartitions("token").write.parquet(f"{folder}/log")
    fx.table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.parquet(f"{folder}/coll")
    cfg = Config()
    cfg.connection.uri, cfg.connection.database, cfg.connection.collection, cfg.partition.consumer_group = "file", "shop", "events", "bench"
    cfg.logger.log_level = "error"
    seen, took, last = [0], [], [time.perf_counter()]

    def listener(df, batch_id):
        seen[0] += df.count()
        took.append(time.perf_counter() - last[0])
        last[0] = time.perf_counter()

    listener.batch = True
    c = Connector(spark, cfg, listener, ParquetChangeSource(spark, f"{folder}/coll", f"{folder}/log", key="c_custkey", files_per_trigger=1), folder, MemoryControlStore(), document="c_name")
    c.start(available_now=True)  # the snapshot, and whatever came after its watermark: nothing
    for p in range(cfg.partition.total_partition):
        c.progress.write(p, resume_token=-1)
    took.clear()
    seen[0], last[0] = 0, time.perf_counter()
    c.start(available_now=True)
    return seen[0], took


def main() -> None:
    from pyspark.sql import SparkSession

    from tributary.plans import catalogue

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    sink(catalogue.QUERIES[HEADLINE[0]](spark, sf_dir))  # starts the JVM's work: not timed
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        sink(catalogue.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - began, 3)
    n = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    began = time.perf_counter()
    sink(catalogue.QUERIES["synthetic_insert"](spark, sf_dir))
    snapshot_s = time.perf_counter() - began
    began = time.perf_counter()
    events, took = stream_batches(spark, sf_dir)
    stream_s = sum(took)
    took.sort()
    out = {
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": Path(sf_dir).name, "cpus": int(cpus),
        "snapshot_rows_per_s": round(n / snapshot_s), "change_events_per_s": round(events / stream_s) if stream_s else None,
        "batch_latency_p50_s": round(took[len(took) // 2], 3) if took else None, "batch_latency_p95_s": round(took[int(len(took) * 0.95)], 3) if took else None,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
