"""One local session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoints')}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if v is None or pd.isna(v):
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(df) -> list:
    cols = sorted(df.columns)
    return sorted((tuple(plain(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return lambda sql: con.execute(sql).fetchdf()
