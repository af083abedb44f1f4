"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, source mixing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the
last return the columns of documents; the last returns what the mix takes of each document. Stages
are written as Parquet and read again, so a lost executor repeats at most part of one stage.

Rows with null texts have no words and go in the first stage; a null source is a source of its own;
documents are told apart by id and text, so rows that repeat one are one near-duplicate group, of
which one stays, and two texts under one id are two; an empty table stays empty; extra columns pass
through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, scratch, stash, unstash
from .decontaminate import drop_contaminated
from .line_dedup import dedup_lines
from .mixing import mix
from .near_dup import first_of_groups
from .quality import cascade


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return docs.where(cascade(docs)[0])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that equal or nearly equal an earlier one; n_chars is that of the new text."""
    out = dedup_lines(docs, exact_short=True).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return first_of_groups(docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: documents with the words taken of them, repeats counted."""
    return mix(docs).where("taken > 0")


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near), ("decontamination", decontaminate), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch():
            before, docs = docs, kept(stash(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        unstash(before)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Near-duplicates and edit distances are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
