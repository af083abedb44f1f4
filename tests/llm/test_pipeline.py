"""The corpus pipeline, stage by stage against plain models of the stages."""

import random

import numpy as np

import corpus_pipeline
from sightline.llm import stages
from sightline.llm.common import stash
from sightline.llm.queries import ORACLES, QUERIES

from ..conftest import SF
from . import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def docs(spark):
    r = random.Random(4)
    rows = []
    vocab = [f"word{i}" for i in range(300)]
    for i in range(40):
        rows.append((i, "\n".join(" ".join(r.choices(vocab, k=12)) for _ in range(8)), "en", r.choice(["a", "b", None]), 1, "x"))
    rows += [(50, rows[3][1], "en", "a", 1, "x"), (51, rows[3][1].replace("word1 ", "other "), "en", "b", 1, "x"), (52, None, None, None, None, None), (53, "", "en", "a", 0, "x"), (54, "### " * 80, "en", "a", 1, "x")]
    rows += [rows[7], (55, "the quick " * 60, "en", "a", 1, "x")]
    return rows, spark.createDataFrame(rows, COLUMNS)


def test_stages(spark, tmp_path):
    rows, df = docs(spark)
    item = " ".join(rows[5][1].split()[10:40])
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near duplicates", "decontamination", "mixing"]
    stage = {n: lambda d, f=f: f(spark, d, str(tmp_path)) for n, f in corpus_pipeline.STAGES}

    kept = stage["quality rules"](df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*range(40), 7, 50, 51])

    lined = stage["line dedup"](kept)
    assert lined.columns == df.columns
    texts = {r.doc_id: r.text for r in lined.collect()}
    assert texts == brute.dedup_lines([(r.doc_id, r.text) for r in kept.distinct().collect()], 20)
    assert texts[50] == ""

    near = stage["near duplicates"](kept)
    want = brute.near_components([(r.doc_id, r.text) for r in kept.distinct().collect()], 5, 80)
    assert sorted(r.doc_id for r in near.collect()) == sorted(d for d, (_, c) in want.items() if c == d)

    clean = stage["decontamination"](near)
    assert clean.columns == df.columns and {r.doc_id for r in near.collect()} - {r.doc_id for r in clean.collect()} == {5}

    mixed = stage["mixing"](clean).toPandas()
    by = mixed.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (by.taken == np.floor(by.target)).all() and (mixed.taken <= 3 * mixed["size"]).all()


def test_stages_of_an_empty_table(spark, tmp_path):
    _, df = docs(spark)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = df.limit(0)
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, out, str(tmp_path))
    assert out.count() == 0


def test_run(spark):
    """The whole run takes of whole stages' results what the mix of them takes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        docs = stash(f(spark, docs, SF), "stage")
    want = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == want and want
    assert corpus_pipeline.ORACLE_SQL is None


def test_two_texts_under_one_id_are_two_documents(spark, tmp_path):
    r = random.Random(6)
    a, b = (" ".join(r.choices([f"w{i}" for i in range(300)], k=80)) for _ in range(2))
    df = spark.createDataFrame([(1, a, "en", "a", 1, "x"), (2, a, "en", "a", 1, "x"), (2, b, "en", "a", 1, "x"), (2, b, "en", "a", 1, "x")], COLUMNS)
    assert sorted((x.doc_id, x.text) for x in stages.near(spark, df, str(tmp_path)).collect()) == [(1, a), (2, b)]


def test_registry():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 11))}
    assert set(ORACLES) <= set(QUERIES)


def test_short_lines_go_too(spark, tmp_path):
    df = spark.createDataFrame([(1, "Share this", "en", "a", 10, "x"), (2, "Share this\nand more", "en", "a", 19, "x")], COLUMNS)
    got = sorted((r.doc_id, r.text, r.n_chars) for r in stages.lines(spark, df, str(tmp_path)).collect())
    assert got == [(1, "Share this", 10), (2, "and more", 8)]
