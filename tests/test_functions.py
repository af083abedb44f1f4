"""Golden cases of the scalar functions, and the blocking keys against the predicate."""

import uuid

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightline.functions import bibs, text, timeparse, vectors
from sightline.operators.bursts import fits
from sightline.operators.joins import fuzzy_join, range_join

#: a, b, compatible, compatible_close, occluded
PAIRS = [
    ("416", "416", True, True, True), ("416", "16", True, True, True), ("416", "41", True, True, True), ("416", "7416", True, True, True), ("416", "4167", True, True, True),
    ("416", "476", True, True, False), ("416", "46", True, False, False), ("12", "1002", True, False, False), ("16", "4160005", True, False, False), ("319", "3319", True, True, True),
    ("3315", "3319", True, True, False), ("319", "3315", False, False, False), ("3223", "3224", True, True, False), ("32", "3223", True, True, True), ("3907", "3947", True, True, False),
    ("368", "3681", True, True, True), ("123", "321", False, False, False), ("1", "1", True, True, True), ("1", "2", False, False, False), ("1", "12", False, False, False), (None, "1", False, False, False), ("", "1", False, False, False),
]


def test_bib_predicates(spark):
    df = spark.createDataFrame([(a, b) for a, b, *_ in PAIRS], "a string, b string")
    got = df.select("a", "b", bibs.compatible(F.col("a"), F.col("b")), bibs.compatible_close(F.col("a"), F.col("b")), bibs.occluded(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == PAIRS


@pytest.mark.parametrize("a,b,want", [(a, b, c) for a, b, c, *_ in PAIRS])
def test_python_predicate(a, b, want):
    assert fits(a, b) is want and fits(b, a) is want


def test_finish_times(spark):
    cases = [("9:48:18", 35298.0, 35298), ("7:28:20.7 AM", 26900.7, 26900), ("1:30:05.6 PM", 48605.6, 48605), ("12:05:00 AM", 300.0, 300), ("12:05:00 PM", 43500.0, 43500), ("7:44", 27840.0, 27840), ("25:00:00", 90000.0, None), ("", None, None), ("abc", None, None), ("7", None, None), (None, None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "t string")
    got = df.select("t", F.round(timeparse.finish_seconds(F.col("t")), 6), timeparse.whole_seconds(F.col("t"))).collect()
    assert [tuple(r) for r in got] == cases


def test_uuid5(spark):
    names = ["", "a", "7_/x/y.jpg", "ü"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.uuid5(F.col("n"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]


def test_vectors(spark):
    row = spark.range(1).select(
        F.array(F.lit(1.0), F.lit(0.0)).alias("a"), F.array(F.lit(0.0), F.lit(1.0)).alias("b"), F.lit(None).cast("array<double>").alias("n")
    ).select(F.col("*"), vectors.cosine(F.col("a"), F.col("n")).alias("c0"), vectors.cosine_distance(F.col("a"), F.col("n")).alias("d0"), vectors.ema(F.col("a"), F.col("b")).alias("e"), vectors.cosine(F.col("a"), F.col("a")).alias("c1")).first()
    assert row.c0 == 0.0 and row.d0 is None and row.c1 == pytest.approx(1.0)
    assert np.allclose(row.e, [0.970143, 0.242536], atol=1e-6)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text("1234", min_size=0, max_size=11), min_size=30, max_size=60))
def test_fuzzy_join_equals_predicate(spark, words):
    left = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, a string")
    right = spark.createDataFrame([(j, w) for j, w in enumerate(words[::-1])], "j long, b string")
    got = sorted((r.i, r.j) for r in fuzzy_join(left, right, "a", "b").collect())
    assert got == sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(words[::-1]) if fits(a, b))


def test_range_join_bounds(spark):
    a = spark.createDataFrame([(1, 100.0), (2, 86399.5), (3, None), (4, -3.0)], "i long, x double")
    b = spark.createDataFrame([(1, 102.0), (2, 102.001), (3, 0.5), (4, -5.0), (5, None)], "j long, y double")
    assert sorted((r.i, r.j) for r in range_join(a, b, "x", "y", 2.0).collect()) == [(1, 1), (4, 4)]
