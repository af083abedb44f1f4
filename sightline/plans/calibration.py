"""Camera clock calibration: match readings to finish times and take the median offset of each camera."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparse import seconds_of_day
from .registry import query


def calibrate(readings: DataFrame, finishes: DataFrame, least: int = 3) -> DataFrame:
    """One row per camera: the median of reading minus finish, rounded to 2 places, if at least ``least`` matched.

    readings: camera, bib, sod. finishes: bib, sod. A camera without matches has no offset and says so.
    """
    matched = readings.join(finishes.select("bib", F.col("sod").alias("finish")), "bib", "left")
    out = matched.groupBy("camera").agg(F.median(F.col("sod") - F.col("finish")).alias("m"), F.count("finish").alias("match_count"))
    enough = F.col("match_count") >= least
    return out.select("camera", F.when(enough, F.round("m", 2)).alias("offset_seconds"), F.when(enough, "completed").otherwise("insufficient_data").alias("status"), "match_count")


@query("calibration_offset", sql="""
with sod as (
  select event_type, user_id, hour(ts) * 3600 + minute(ts) * 60 + date_part('microsecond', ts) / 1000000.0 as sod, ts from events),
finish as (
  select user_id, floor(arg_min(sod, ts))::double as f from sod where event_type = 'purchase' group by user_id),
m as (
  select event_type as camera, median(sod - f) as m, count(f) as match_count
  from sod left join finish using (user_id) where event_type <> 'purchase' group by event_type)
select camera, case when match_count >= 3 then round(m, 2) end as offset_seconds,
       case when match_count >= 3 then 'completed' else 'insufficient_data' end as status, match_count
from m
""")
def calibration_offset(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "user_id", "ts", seconds_of_day(F.col("ts")).alias("sod"))
    finishes = events.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("bib")).agg(F.floor(F.min_by("sod", "ts")).cast("double").alias("sod"))
    readings = events.where("event_type <> 'purchase'").select(F.col("event_type").alias("camera"), F.col("user_id").alias("bib"), "sod")
    return calibrate(readings, finishes)
