"""Queue messages: JSON in and out, routing, vectors as base64, dead letters, metrics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import first_filled
from .schemas import RAW_INFERENCE


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream of raw messages (column ``value``). files_per_trigger limits
    what a micro-batch takes in; with a queue connector, that is its own rate option."""
    r = spark.readStream.format("text")
    return (r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r).load(path)


def parse(messages: DataFrame, schema: str = RAW_INFERENCE, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, dead letters): a message that is not an object of the schema's kind is a dead
    letter with its text; it neither stops the stream nor comes again. Missing fields are null."""
    m = messages.withColumn("_m", F.from_json(value, schema + ", _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}))
    broken = F.col("_m").isNull() | F.col("_m._broken").isNotNull()
    return m.where(~broken).select("_m.*").drop("_broken"), m.where(broken).select(value)


def to_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON in a column ``value``; binary columns are base64."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def route(tasks: DataFrame) -> dict[str, DataFrame]:
    """Branches by task type and priority: calibration results, finish line (9), course (below 9)."""
    calibration = F.coalesce(F.col("task_type") == "probe_calibration_result", F.lit(False))
    first = F.coalesce(F.col("priority") >= 9, F.lit(False))
    return {"calibration": tasks.where(calibration), "finish_line": tasks.where(~calibration & first), "course": tasks.where(~calibration & ~first)}


def task_id(*fallbacks: Column) -> Column:
    """The first id that is filled, else one made of the message's content."""
    return F.coalesce(first_filled(*fallbacks), F.concat(F.lit("task-"), F.substring(F.sha1(F.encode(F.to_json(F.struct(*fallbacks)), "UTF-8")), 1, 12)))


def photos_of(images: Column, payload_photos: Column) -> Column:
    """``images`` unless it is null or empty, else the payload's photos."""
    return F.when(F.size(images) > 0, images).otherwise(payload_photos)


def with_results(requested: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Every requested row with its result; rows without one have success false."""
    out = requested.join(results, key, "left")
    return out.withColumn("success", F.coalesce("success", F.lit(False)))


def burst_payload(meta: DataFrame, results: str, metadata: str) -> DataFrame:
    """Two arrays of equal length, zipped by place into ``images``; another length is an error."""
    same = F.assert_true(F.size(results) == F.size(metadata), "as many results as images are needed")
    return meta.withColumn("images", F.when(same.isNull(), F.arrays_zip(F.col(metadata).alias("meta"), F.col(results).alias("result"))))


@F.pandas_udf(T.StringType())
def vector_to_base64(v: pd.Series) -> pd.Series:
    """A float vector as base64 of its little-endian float32 bytes."""
    import base64

    return v.map(lambda x: None if x is None else base64.b64encode(np.asarray(x, "<f4").tobytes()).decode())


@F.pandas_udf(T.ArrayType(T.FloatType()))
def base64_to_vector(s: pd.Series) -> pd.Series:
    import base64

    return s.map(lambda x: None if x is None else np.frombuffer(base64.b64decode(x), "<f4").tolist())


def image_rows(listed: DataFrame, path: str = "path") -> DataFrame:
    """``listed`` with the files' content and success; a file that can't be read is a row with its error."""
    schema = f"{path} string, content binary, success boolean, error string"

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for b in batches:
            rows = []
            for p in b[path]:
                try:
                    store, inner = fs.FileSystem.from_uri(p)
                    with store.open_input_file(inner) as f:
                        rows.append((p, f.read(), True, None))
                except Exception as e:  # noqa: BLE001  kept as data
                    rows.append((p, None, False, str(e)[:200]))
            yield pd.DataFrame(rows, columns=[path, "content", "success", "error"])

    return listed.select(path).mapInPandas(load, schema)


def edge_zones_masked(images: DataFrame, pixels: str = "pixels", width: str = "width", height: str = "height", left: float = 0.15, right: float = 0.15) -> DataFrame:
    """``images`` with the raw pixels (rows of width pixels of equal size each, as bytes) black in the
    outer shares of the width, rounded down; other columns stay. Null pixels stay null."""

    @F.pandas_udf(T.BinaryType())
    def mask(data: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
        out = []
        for d, columns, rows in zip(data, w, h, strict=True):
            if d is None or not columns or not rows:
                out.append(d)
                continue
            a = np.frombuffer(d, np.uint8).reshape(int(rows), int(columns), -1).copy()
            a[:, : int(columns * left)] = 0
            a[:, a.shape[1] - int(columns * right) :] = 0
            out.append(a.tobytes())
        return pd.Series(out, dtype=object)

    return images.withColumn(pixels, mask(pixels, F.coalesce(width, F.lit(0)), F.coalesce(height, F.lit(0))))


def burst_metrics(images: DataFrame, by: list[str]) -> DataFrame:
    """Tallies of a burst's images: images, ok, failed, mean and largest inference time."""
    return images.groupBy(*by).agg(F.count("*").alias("images"), F.count_if("success").alias("ok"), F.count_if(~F.col("success")).alias("failed"), F.avg("inference_ms").alias("mean_ms"), F.max("inference_ms").alias("max_ms"))
