"""Bursts as a stream: parsing, once-only processing, and writing by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bank import STATE, enroll
from ..sources.messages import parse


def once(stream: DataFrame, key: str, time: str | None = None, delay: str = "3 hours") -> DataFrame:
    """Rows whose key was not seen before: for ever, or within ``delay`` of the event time."""
    if time is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def detections_of(bursts: DataFrame) -> DataFrame:
    """One row per person of a parsed burst message (schemas.RAW_INFERENCE), failed images left out."""
    image = bursts.select("project_id", "burst_id", "priority", "camera_serial", F.explode("images").alias("i")).where("i.success")
    p = image.select("project_id", "burst_id", "priority", "camera_serial", F.col("i.photo_id").alias("photo_id"), F.col("i.corrected_time").alias("corrected_time"), F.col("i.img_width").alias("img_width"), F.col("i.img_height").alias("img_height"), F.posexplode("i.persons").alias("seq", "p"))
    return p.select("*", "p.*").drop("p")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process all that is there, batch by batch, and stop. ``each`` must write so that a batch that
    comes again replaces what it wrote."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Every so many batches the sink writes the whole bank, so that readers need not go further back.
FULL_EVERY = 50


def _done(spark: SparkSession, path: str, kind: str) -> list[int]:
    """The numbers of the finished folders ``kind``=n."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(x.split("=")[1]) for x in names if x.startswith(f"{kind}=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{x}/_SUCCESS")))


def _parts(spark: SparkSession, path: str, before: int | None = None) -> list[str]:
    """The last whole folder and the batches after it, of the batches below ``before``."""
    batches, whole = ([n for n in _done(spark, path, k) if before is None or n < before] for k in ("batch", "full"))
    last = whole[-1:]
    return [f"{path}/full={n}" for n in last] + [f"{path}/batch={n}" for n in batches if not last or n > last[0]]


def _latest(versions: DataFrame, by: list[str]) -> DataFrame:
    names = [c for c in versions.columns if c != "batch"]
    return versions.groupBy(*by).agg(F.max_by(F.struct(*names), "batch").alias("row")).select("row.*")


def current_bank(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """The bank (bank.STATE) after the last batch, or after those below ``before``."""
    parts = _parts(spark, table, before)
    return _latest(spark.read.parquet(*parts), ["id"]) if parts else spark.createDataFrame([], STATE)


def bank_sink(table: str, log: str, full_every: int = FULL_EVERY) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that folds enrollments into a bank of versions, one Parquet folder a batch.

    A batch looks up the last version of the identities that it touches and writes new versions of
    these and its ghosts alone; every ``full_every`` batches the whole bank is written. Batch n reads
    what lower batches wrote and replaces its own folder, so a batch that is run again gives the same
    bank. Bursts that a former batch has folded in are left out (their ids are in ``log``), as
    blending is not idempotent."""

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        whole = n % full_every == full_every - 1
        logged, parts = _parts(spark, log, n), _parts(spark, table, n)
        seen = spark.read.parquet(*logged).select("burst_id") if logged else None
        new = (batch if seen is None else batch.join(seen, "burst_id", "left_anti")).checkpoint()
        bank = None
        if parts:
            touched = new.select("project_id", "bib").distinct()
            bank = _latest(spark.read.parquet(*parts).where("bib is not null").join(touched, ["project_id", "bib"], "left_semi"), ["project_id", "bib"])
        out = enroll(new, bank).withColumn("batch", F.lit(n).cast("long"))
        bursts = new.select("burst_id").distinct()
        if whole and parts:
            out = out.checkpoint()
            rest = current_bank(spark, table, n).join(out.select("id"), "id", "left_anti").withColumn("batch", F.lit(n).cast("long"))
            out, bursts = out.unionByName(rest), bursts.unionByName(seen).distinct()
        kind = "full" if whole else "batch"
        out.write.mode("overwrite").parquet(f"{table}/{kind}={n}")
        bursts.write.mode("overwrite").parquet(f"{log}/{kind}={n}")

    return each


def parsed_bursts(raw: DataFrame) -> DataFrame:
    return once(parse(raw)[0], "burst_id")
