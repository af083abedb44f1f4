"""Boxes as Column expressions; a box is four columns x1, y1, x2, y2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def area(b: Box) -> Column:
    return F.greatest(F.lit(0), b[2] - b[0]) * F.greatest(F.lit(0), b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    return F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where the union is empty."""
    i = intersection(a, b)
    u = area(a) + area(b) - i
    return F.when(u > 0, i / u).otherwise(F.lit(0.0))


def containment(a: Box, b: Box) -> Column:
    """Intersection over the smaller box; 0 where that is empty."""
    small = F.least(area(a), area(b))
    return F.when(small > 0, intersection(a, b) / small).otherwise(F.lit(0.0))


def touches_border(b: Box, width: Column, height: Column, px: int = 5) -> Column:
    return (b[0] <= px) | (b[1] <= px) | (b[2] >= width - px) | (b[3] >= height - px)


def clamped(b: Box, width: Column, height: Column) -> Box:
    zero = F.lit(0)
    return F.greatest(zero, b[0]), F.greatest(zero, b[1]), F.least(width, b[2]), F.least(height, b[3])


def relative(b: Box, width: Column, height: Column) -> dict[str, Column]:
    """Box in shares of the image (4 places) and its area share (6 places); sizes not above 0 count as 1920 x 1280."""
    w = F.when(width > 0, width).otherwise(F.lit(1920))
    h = F.when(height > 0, height).otherwise(F.lit(1280))
    bw, bh = F.greatest(F.lit(0), b[2] - b[0]), F.greatest(F.lit(0), b[3] - b[1])
    return {"bbox_x": F.round(b[0] / w, 4), "bbox_y": F.round(b[1] / h, 4), "bbox_w": F.round(bw / w, 4), "bbox_h": F.round(bh / h, 4), "area_pct": F.round(bw * bh / (w * h), 6)}
