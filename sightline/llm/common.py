"""Helpers shared by the training-data operators: work folder, written intermediates, words."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it, and its complement.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def workdir(spark: SparkSession) -> str:
    """The shared folder for intermediates: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, one machine) a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = "file://" + tempfile.mkdtemp(prefix="sightline-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{workdir(spark)}/{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts the lineage, and
    what follows survives the loss of any executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    drop_at_end(df.sparkSession, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stash_path = path
    if _scopes:
        _scopes[-1].append(out)
    return out


#: Stashed tables by the scratch scopes that are open, the innermost last.
_scopes: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """What is stashed within is removed at the end, but for what ``kept`` names."""
    _scopes.append([])
    try:
        yield
    finally:
        for df in _scopes.pop():
            unstash(df)


def kept(df: DataFrame) -> DataFrame:
    """Let a stashed table outlive the innermost scratch scope."""
    _scopes[-1][:] = [x for x in _scopes[-1] if x is not df]
    if len(_scopes) > 1:
        _scopes[-2].append(df)
    return df


def unstash(df: DataFrame) -> None:
    """Remove a stashed table that nothing reads any more."""
    path = getattr(df, "_stash_path", None)
    if path:
        remove(df.sparkSession, path)


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Have an existing folder removed when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def n_words_of(text: Column) -> Column:
    """The number of words as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for use inside lambdas, which would otherwise recompute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_pieces(data: bytes, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text as bytes, a few million bytes at a time. (bytes.split goes by ASCII
    white space alone.)"""
    at = 0
    while len(data) - at > size:
        cut = at + size
        while cut < len(data) and data[cut] not in b" \t\n\x0b\x0c\r":
            cut += 1
        yield data[at:cut].split()
        at = cut
    yield data[at:].split() if at else data.split()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` clashes with it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that a Python worker holds few texts as objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def open_input(path: str):
    """A readable, seekable binary file on the shared store, from a Python worker."""
    if path.startswith("file:") or path.startswith("/"):
        return open(re.sub(r"^file:(//)?(?=/)", "", path), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def write_atomically(path: str, fill: Callable) -> None:
    """Call ``fill(file)`` on a new file and move it into place, so that a retried or doubled
    task leaves one whole file."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    if path.startswith("file:") or path.startswith("/"):
        strip = lambda p: re.sub(r"^file:(//)?(?=/)", "", p)
        with open(strip(part), "wb") as f:
            fill(f)
        os.replace(strip(part), strip(path))
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(part)
    with store.open_output_stream(inner) as f:
        fill(f)
    store.move(inner, fs.FileSystem.from_uri(path)[1])
