"""Metric lines in JSON: progress of streams, the driver's health, exceptions; a sink that may fail
without stopping a stream; the log's form."""

from __future__ import annotations

import json
import logging
import os
import resource
import socket
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger("sightline")


class Progress(StreamingQueryListener):
    """Calls ``put`` with a JSON line for every start, batch and end of a query."""

    def __init__(self, put: Callable[[str], None]):
        self.put = put

    def onQueryStarted(self, event) -> None:
        self.put(json.dumps({"event": "started", "query": str(event.id)}))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.put(json.dumps({"event": "batch", "query": str(p.id), "batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond}))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.put(json.dumps({"event": "ended", "query": str(event.id), "error": event.exception}))


def run_every(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], interval: str = "1 second") -> StreamingQuery:
    """Process what has come in, by micro-batch, until the query is stopped."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def non_fatal(each: Callable[[DataFrame, int], None], what: str) -> Callable[[DataFrame, int], None]:
    """A sink of notifications: a failure is logged, and the batch counts as done."""

    def guarded(batch: DataFrame, n: int) -> None:
        try:
            each(batch, n)
        except Exception:
            log.exception("%s of batch %s failed", what, n)

    return guarded


def system_metrics(spark: SparkSession, **extra) -> dict:
    """The driver's health: host, pid, load, memory, CPU seconds, and the executors with their memory in MB."""
    used = resource.getrusage(resource.RUSAGE_SELF)
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
    free = total = 0
    values = status.values().iterator()
    while values.hasNext():
        pair = values.next()
        total, free = total + pair._1(), free + pair._2()
    return {"event": "system", "host": socket.gethostname(), "pid": os.getpid(), "load": round(os.getloadavg()[0], 2), "ram_used_mb": round(used.ru_maxrss / 1024, 1), "cpu_s": round(used.ru_utime + used.ru_stime, 2), "executors": status.size(), "storage_used_mb": round((total - free) / 1e6, 1), "storage_total_mb": round(total / 1e6, 1), **extra}


def exception_metrics(error: BaseException, category: str = "unknown", **context) -> dict:
    """An error as a metric: its type, message and category, and where it happened (burst_id, project_id, task_type)."""
    return {"event": "exception", "host": socket.gethostname(), "pid": os.getpid(), "error_type": type(error).__name__, "error_message": str(error)[:1000], "error_category": category, **context}


class JsonLines(logging.Formatter):
    """One JSON object a line; the fields of ``extra={"metrics": {...}}`` stand beside time, level and message."""

    def format(self, record: logging.LogRecord) -> str:
        out = {"time": self.formatTime(record, "%Y-%m-%dT%H:%M:%S"), "level": record.levelname.lower(), "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out | getattr(record, "metrics", {}), default=str)


def configure_logging(spark: SparkSession | None = None, level: str = "INFO", spark_level: str = "WARN", handler: logging.Handler | None = None) -> logging.Logger:
    """The engine's log as JSON lines on ``handler`` (standard error), and the level of Spark's own. Calling it again replaces the handler."""
    handler = handler or logging.StreamHandler()
    handler.setFormatter(JsonLines())
    log.handlers[:] = [handler]
    log.setLevel(level)
    log.propagate = False
    if spark is not None:
        spark.sparkContext.setLogLevel(spark_level)
    return log


def put_metrics(rows: list[dict]) -> None:
    """Metric rows to the log, one line each."""
    for row in rows:
        log.info(row.get("event", "metrics"), extra={"metrics": row})
