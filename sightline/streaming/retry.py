"""Tickets that fail: waiting, trying again, and setting aside what never succeeds."""

from __future__ import annotations

import logging
import shutil
import time
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

log = logging.getLogger("sightline")

#: Seconds between attempts.
BACKOFF = (5, 10, 30, 60, 120)


def retried(each: Callable[[DataFrame, int], None], what: str, waits: tuple[float, ...] = BACKOFF, dead: Callable[[DataFrame, int, Exception], None] | None = None, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that tries ``each`` again after each of ``waits``. A batch that fails
    every time goes to ``dead`` and counts as done, or, without it, stops the query, which gives the
    batch again when it is restarted. ``each`` must replace what an earlier attempt wrote."""

    def tried(batch: DataFrame, n: int) -> None:
        for k, wait in enumerate((*waits, None)):
            try:
                return each(batch, n)
            except Exception as e:
                log.warning("%s of batch %s failed, attempt %s", what, n, k + 1, exc_info=True)
                if wait is None:
                    if dead is None:
                        raise
                    return dead(batch, n, e)
                sleep(wait)

    return tried


def dead_letters(path: str) -> Callable[[DataFrame, int, Exception], None]:
    """A ``dead`` function that writes the batch's rows with the error; a batch that comes again replaces them."""

    def put(batch: DataFrame, n: int, error: Exception) -> None:
        batch.withColumns({"error": F.lit(f"{type(error).__name__}: {error}"[:500]), "batch": F.lit(n)}).write.mode("overwrite").parquet(f"{path}/batch={n}")

    return put


def release_claims(tickets: DataFrame, folder: str = "folder") -> DataFrame:
    """Remove the folders that processed tickets name, each once: folder, removed (files in it). Missing
    folders and nulls have 0, so a second run does no harm. The folders must be on a store that the
    workers see, by path or as file://."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = []
            for name in b["folder"]:
                at = Path(name.removeprefix("file://"))
                counts.append(sum(f.is_file() for f in at.iterdir()) if at.is_dir() else 0)
                shutil.rmtree(at, ignore_errors=True)
            yield pd.DataFrame({"folder": b["folder"], "removed": counts})

    named = tickets.select(F.col(folder).alias("folder")).where("folder is not null and folder <> ''").distinct()
    return named.mapInPandas(run, "folder string, removed long")
