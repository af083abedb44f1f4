"""Participants as the rules want them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparse import finish_seconds


def timed(participants: DataFrame, order: str) -> DataFrame:
    """Bibs with a finish time that can be read, and its seconds; of a bib that repeats, the last by ``order``."""
    t = participants.where(F.col("bib_number").isNotNull()).withColumn("finish", finish_seconds(F.col("finish_time"))).where("finish is not null")
    w = Window.partitionBy("project_id", "bib_number").orderBy(F.col(order).desc())
    return t.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("project_id", F.col("bib_number").alias("bib"), "finish")


def valid(participants: DataFrame) -> DataFrame:
    """Bibs with any finish time, readable or not."""
    return participants.where("bib_number is not null and finish_time is not null and finish_time <> ''").select("project_id", F.col("bib_number").alias("bib")).distinct()


def registered(participants: DataFrame) -> DataFrame:
    return participants.where("bib_number is not null").select("project_id", F.col("bib_number").alias("bib")).distinct()


def unparsed(participants: DataFrame) -> DataFrame:
    """Rows with a finish time, as it is written."""
    return participants.where("finish_time is not null and finish_time <> ''").select("project_id", "bib_number", "finish_time")


def classified(readings: DataFrame, participants: DataFrame, bib: str = "bib") -> DataFrame:
    """``match_type``: course_ocr for registered bibs, course_unknown for others, null without a reading.
    The lookup side is one row per registered bib; Spark broadcasts it while it is small."""
    known = registered(participants).select("project_id", F.col("bib").alias(bib), F.lit(True).alias("_known"))
    out = readings.join(known, ["project_id", bib], "left")
    return out.withColumn("match_type", F.when(F.col("_known"), "course_ocr").when(F.col(bib).isNotNull(), "course_unknown")).drop("_known")
