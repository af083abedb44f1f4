"""Aggregates of a cluster's readings and vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def consensus(readings: DataFrame, by: list[str], bib: str = "bib", conf: str = "conf", seq: str = "seq") -> DataFrame:
    """Positional vote: the length with the largest sum of confidences; at each place of readings of
    that length the character with the largest sum; ties go to what was seen first. conf is the mean
    over places of the largest single confidence for the chosen character. One row per group:
    ``by``, consensus_bib, consensus_conf. Sums are rounded to 9 places, so that equal ones tie."""
    r = readings.select(*by, F.col(bib).alias("bib"), F.col(conf).cast("double").alias("conf"), F.col(seq).alias("seq"), F.length(bib).alias("len"))
    lens = r.groupBy(*by, "len").agg(F.round(F.sum("conf"), 9).alias("s"), F.min("seq").alias("first"))
    best = lens.groupBy(*by).agg(F.max_by("len", F.struct("s", (-F.col("first")).alias("f"))).alias("len"))
    chars = r.join(best, [*by, "len"]).select(*by, "conf", "seq", F.posexplode(F.filter(F.split("bib", ""), lambda c: c != "")).alias("pos", "ch"))
    votes = chars.groupBy(*by, "pos", "ch").agg(F.round(F.sum("conf"), 9).alias("s"), F.max("conf").alias("m"), F.min("seq").alias("first"))
    won = votes.groupBy(*by, "pos").agg(F.max_by(F.struct("ch", "m"), F.struct("s", (-F.col("first")).alias("f"))).alias("w"))
    return won.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "w.ch"))), lambda x: x["ch"]), "").alias("consensus_bib"), F.avg("w.m").alias("consensus_conf"))


def best_by(df: DataFrame, by: list[str], score: str, seq: str, *columns: str) -> DataFrame:
    """Per group the columns of the row with the largest score, the first on ties; null scores lose."""
    row = F.max_by(F.struct(*columns), F.struct(F.col(score), (-F.col(seq)).alias("_s")))
    out = df.where(F.col(score).isNotNull()).groupBy(*by).agg(row.alias("_r"))
    return out.select(*by, *[F.col(f"_r.{c}").alias(c) for c in columns])


def mean_vector(df: DataFrame, by: list[str], vec: str, eps: float = 1e-8) -> DataFrame:
    """Per group the element-wise mean at length 1 (as it is if not longer than ``eps``): ``by``, centroid."""
    places = df.where(F.col(vec).isNotNull()).select(*by, F.posexplode(vec).alias("pos", "x"))
    means = places.groupBy(*by, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    whole = means.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda x: x["m"]).alias("v"), F.sqrt(F.sum(F.col("m") * F.col("m"))).alias("n"))
    return whole.select(*by, F.when(F.col("n") > eps, F.transform("v", lambda x: x / F.col("n"))).otherwise(F.col("v")).alias("centroid"))


def upper_median(value: str) -> Column:
    """sorted[n // 2] as an aggregate: the upper of the two middle values."""
    sorted_values = F.sort_array(F.collect_list(value))
    return F.get(sorted_values, (F.size(sorted_values) / 2).cast("int"))


def mad(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per group the median and the median absolute deviation from it."""
    med = df.groupBy(*by).agg(F.median(value).alias("median"))
    return df.join(med, by).groupBy(*by).agg(F.first("median").alias("median"), F.median(F.abs(F.col(value) - F.col("median"))).alias("mad"))


def first_known(value: str, order: str) -> Column:
    """The first non-null value in an order, as an aggregate."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def greedy_match(candidates: DataFrame, by: list[str], left: str, right: str, score: str) -> DataFrame:
    """Per group, pairs taken best score first, each side once; ties by left, then right. A fold over
    the group's sorted candidates inside the JVM; groups are bursts, and small."""
    sorted_pairs = F.array_sort(F.collect_list(F.struct((-F.col(score)).alias("o"), F.col(left).alias("l"), F.col(right).alias("r"))))
    kinds = dict(candidates.dtypes)
    empty = F.array().cast(f"array<struct<o:double,l:{kinds[left]},r:{kinds[right]}>>")
    step = lambda acc, x: F.when(F.exists(acc, lambda y: (y["l"] == x["l"]) | (y["r"] == x["r"])), acc).otherwise(F.concat(acc, F.array(x)))
    out = candidates.withColumn(score, F.col(score).cast("double")).groupBy(*by).agg(sorted_pairs.alias("p")).select(*by, F.explode(F.aggregate("p", empty, step)).alias("x"))
    return out.select(*by, F.col("x.l").alias(left), F.col("x.r").alias(right), (-F.col("x.o")).alias(score))


def ranked_window(by: list[str], *order) -> Window:
    return Window.partitionBy(*by).orderBy(*order)
