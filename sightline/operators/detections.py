"""Filters and windows over detections: one row per box, grouped by image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SETTINGS


def quality_gate(df: DataFrame, least: float = SETTINGS.min_face_quality, face: str = "face_vec", reid: str = "reid_vec", quality: str = "face_quality") -> DataFrame:
    """Rows that had a face vector at all; below the quality both vectors are nulled, the row stays."""
    ok = F.coalesce(F.col(quality) >= least, F.lit(False))
    return df.where(F.col(face).isNotNull()).withColumns({face: F.when(ok, F.col(face)), reid: F.when(ok, F.col(reid))})


def readable(bib: Column, conf: Column, conf_least: float = SETTINGS.min_ocr_conf, length_least: int = SETTINGS.min_ocr_len) -> Column:
    return F.coalesce((conf >= conf_least) & (F.length(bib) >= length_least), F.lit(False))


def sharp_or_all(df: DataFrame, group: str, blurry: str) -> DataFrame:
    """Rows that are not blurry; in groups without such rows, all."""
    sharp = ~F.coalesce(F.col(blurry), F.lit(False))
    return df.withColumn("_any", F.max(sharp).over(Window.partitionBy(group))).where(sharp | ~F.col("_any")).drop("_any")


def with_anchor(df: DataFrame, image: str, seq: str, area: str = "area", border: str = "border") -> DataFrame:
    """``anchor``: the largest area of the image's boxes away from its border; if there is none, the
    first box with an area above 0; 1.0 without any."""
    w = Window.partitionBy(image)
    first = F.min(F.when(F.col(area) > 0, F.struct(seq, area))).over(w)[area]
    inner = F.max(F.when(~F.col(border) & (F.col(area) > 0), F.col(area))).over(w)
    return df.withColumn("anchor", F.coalesce(inner, first, F.lit(1.0)))


def top_boxes(df: DataFrame, image: str, score: Column, seq: str, n: int = SETTINGS.top_n) -> DataFrame:
    """The ``n`` boxes of each image with the highest score, the earlier first on ties."""
    w = Window.partitionBy(image).orderBy(score.desc(), F.col(seq))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def anchor_filter(df: DataFrame, image: str, seq: str, ratio: float = SETTINGS.anchor_ratio) -> DataFrame:
    return with_anchor(df, image, seq).where(F.col("area") >= ratio * F.col("anchor"))


def rescue(boxes: DataFrame, kept: DataFrame, image: str, seq: str, has_face: str, score: Column, ratio: float = SETTINGS.anchor_ratio * SETTINGS.rescue_factor, n: int = SETTINGS.top_n) -> DataFrame:
    """``kept`` and, for images that kept no box, their boxes at the lower ratio, at most ``n``, with a face."""
    lost = boxes.join(kept.select(image).distinct(), image, "left_anti")
    again = top_boxes(with_anchor(lost, image, seq).where(F.col("area") >= ratio * F.col("anchor")), image, score, seq, n).where(F.col(has_face))
    names = [c for c in kept.columns if c not in ("rescued", "anchor")]
    return kept.select(*names).withColumn("rescued", F.lit(False)).unionByName(again.select(*names).withColumn("rescued", F.lit(True)))


def best_on_mask(df: DataFrame, person: str, overlap: str, score: str, seq: str, least: float = 0.25) -> DataFrame:
    """Of each person's boxes that lie on its mask by ``least`` or more, the best one."""
    w = Window.partitionBy(person).orderBy(F.col(score).desc(), F.col(seq))
    return df.where(F.col(overlap) >= least).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
