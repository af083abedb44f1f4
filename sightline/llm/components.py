"""Connected components of an edge table: by hooking in one task up to a bound, beyond it by
alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, unstash

#: Distinct edges that one task settles (16 MB, and a few arrays of that size); more go through rounds of shuffles.
TASK_EDGES = 1_000_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, component) for every id of the edges, ids ascending. Each round hooks every root to its
    smallest neighbouring root; a root that is left after two rounds has taken another one in."""
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
    return ids, ids[root]


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    edges = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if edges:
        found = smallest_reachable(*(np.concatenate(x) for x in zip(*edges, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["id", "component"])


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (u, v), long ids, any order, repeats and loops allowed -> (id, component): for every id
    that an edge names, the smallest id that it reaches.

    Up to TASK_EDGES distinct edges are settled by one task, whose memory that bounds: rounds of a few
    shuffles each would cost far more than the edges do. Beyond it each round is two shuffles on the
    ids; the number of rounds grows with the logarithm of the longest path. Edges are rewritten to stars, so a hub's neighbours are never gathered: minima
    are combined before the shuffle and joined back to the edges, where a skewed join is split.
    Every round is written to the shared folder, and the one before it removed.
    """
    e = stash(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    if e.count() <= TASK_EDGES:
        return e.coalesce(1).mapInArrow(_settle, "id long, component long")
    names = e
    sign = lambda t: t.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = sign(e)  # edges that are stars already settle in one round
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written, so that the joins have plain exchanges on both sides and a hub can be split
        low = stash(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = stash(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "cc-large")
        unstash(low)
        low = stash(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = stash(small, "cc")
        now = sign(new)
        unstash(low), unstash(large)
        if e is not names:
            unstash(e)
        e = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    ids = names.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    return ids.join(e.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))
