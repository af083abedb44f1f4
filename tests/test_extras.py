"""Tokens, retries, claims, metrics, commits, masks, released subjects and packing of large groups."""

import json
import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions import crypto
from sightline.operators import bank, reports, transactions
from sightline.sources import messages
from sightline.streaming import metrics
from sightline.streaming.bursts import run_available
from sightline.streaming.retry import dead_letters, release_claims, retried

KEY = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="  # of the token format's public test vectors
TOKEN = "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64jVmpU4IwqDA=="


def test_tokens(spark):
    df = spark.createDataFrame([("hello",), ("",), (None,), ("x" * 1000,)], "t string")
    made = df.select("t", crypto.encrypt(F.encode("t", "UTF-8"), KEY, F.lit(499162800), F.lit(bytearray(range(16)))).alias("token"))
    rows = made.select("t", "token", crypto.decrypt(F.col("token"), KEY).cast("string").alias("back"), crypto.issued_at(F.col("token")).alias("at")).collect()
    assert [r.token for r in rows if r.t == "hello"] == [TOKEN]
    assert all(r.back == r.t for r in rows) and {r.at for r in rows if r.t is not None} == {499162800}
    bad = [TOKEN[:-4], TOKEN.replace("y021", "y022"), "A" + TOKEN[1:], "", "no token", TOKEN + "====", None]
    got = spark.createDataFrame([(x,) for x in bad], "token string").select(crypto.decrypt(F.col("token"), KEY).alias("d")).collect()
    assert [r.d for r in got] == [None] * len(bad)
    with pytest.raises(ValueError):
        crypto.encrypt(F.col("t"), "AAAA", F.lit(0), F.col("t"))


def test_vector_tokens(spark):
    df = spark.createDataFrame([(1, [0.5, -2.0])], "id long, v array<float>")
    data = F.unbase64(messages.vector_to_base64("v"))
    t = df.select(crypto.encrypt(data, KEY, F.lit(1), F.unhex(F.md5(F.lit("1")))).alias("token"))
    assert t.select(messages.base64_to_vector(F.base64(crypto.decrypt(F.col("token"), KEY))).alias("v")).first().v == [0.5, -2.0]


def test_retries_wait_and_set_aside(spark, tmp_path):
    slept, tries = [], []

    def each(batch, n):
        tries.append(n)
        if len(tries) < 3 or n == 9:
            raise RuntimeError("away")

    df = spark.createDataFrame([("a",)], "value string")
    retried(each, "x", (1, 2, 3), sleep=slept.append)(df, 0)
    assert slept == [1, 2] and tries == [0, 0, 0]
    with pytest.raises(RuntimeError):
        retried(each, "x", (1,), sleep=slept.append)(df, 9)
    retried(each, "x", (1,), dead_letters(f"{tmp_path}/dead"), slept.append)(df, 9)
    assert [(r.value, r.error) for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == [("a", "RuntimeError: away")]


def test_a_poisoned_ticket_does_not_stop_the_stream(spark, tmp_path):
    for k, text in enumerate(["good", "poison", "good too"]):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.txt").write_text(text + "\n")

    def each(batch, n):
        if batch.where("value = 'poison'").count():
            raise ValueError("poison")
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")

    stream = messages.read_stream(spark, f"{tmp_path}/in", 1)  # one ticket at a time
    run_available(stream, f"{tmp_path}/ck", retried(each, "tickets", (0, 0), dead_letters(f"{tmp_path}/dead"), lambda s: None)).awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["good", "good too"]
    assert [r.value for r in spark.read.parquet(f"{tmp_path}/dead").collect()] == ["poison"]


def test_claims_are_released_once(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.jpg").write_bytes(b"x")
    rows = [(f"{tmp_path}/a",), (f"{tmp_path}/a",), (f"file://{tmp_path}/b",), (f"{tmp_path}/c",), (None,), ("",)]
    df = spark.createDataFrame(rows, "folder string")
    assert sorted(r.removed for r in release_claims(df).collect()) == [0, 1, 1]
    assert not (tmp_path / "a").exists() and sorted(r.removed for r in release_claims(df).collect()) == [0, 0, 0]


def test_metrics_and_log_lines(spark):
    lines = []

    class Held(logging.Handler):
        def emit(self, record):
            lines.append(json.loads(self.format(record)))

    was = metrics.log.handlers[:], metrics.log.propagate
    try:
        metrics.configure_logging(spark, spark_level="ERROR", handler=Held())
        metrics.put_metrics([metrics.system_metrics(spark, queue_depth=3), metrics.exception_metrics(ValueError("no"), "validation", burst_id="b1")])
    finally:
        metrics.log.handlers[:], metrics.log.propagate = was
    assert lines[0]["event"] == "system" and lines[0]["executors"] >= 1 and lines[0]["queue_depth"] == 3 and lines[0]["storage_total_mb"] > 0
    assert (lines[1]["error_type"], lines[1]["error_category"], lines[1]["burst_id"], lines[1]["message"]) == ("ValueError", "validation", "b1", "exception")


def test_commit_switches_whole_versions(spark, tmp_path):
    root = f"file://{tmp_path}/db"
    assert transactions.committed(spark, root) is None
    photos = spark.createDataFrame([("1", "p")], "id string, project_id string")
    t = transactions.Tables(photos, photos.limit(0), spark.createDataFrame([], bank.STATE))
    transactions.commit(t, root, "1")
    more = transactions.Tables(photos.unionByName(photos), t.subjects, t.identities)
    transactions.commit(more, root, "2")
    assert transactions.committed(spark, root).photos.count() == 2
    transactions.commit(more, root, "2")  # comes again
    assert transactions.committed(spark, root).photos.count() == 2
    broken = transactions.Tables(photos.select(F.raise_error(F.lit("lost")).alias("id")), t.subjects, t.identities)
    with pytest.raises(Exception, match="lost"):
        transactions.commit(broken, root, "3")
    assert transactions.committed(spark, root).photos.count() == 2


def test_edge_zones(spark):
    data = np.arange(1, 2 * 20 * 3 + 1, dtype=np.uint8).reshape(2, 20, 3)
    df = spark.createDataFrame([(1, bytearray(data.tobytes()), 20, 2), (2, None, 20, 2), (3, bytearray(), 0, 0)], "id long, pixels binary, width int, height int")
    got = {r.id: r.pixels for r in messages.edge_zones_masked(df).collect()}
    want = data.copy()
    want[:, :3] = want[:, 17:] = 0
    assert bytes(got[1]) == want.tobytes() and got[2] is None and bytes(got[3]) == b""


def test_released_subjects(spark):
    rows = [("s1", "i1", "7", "golden_sample"), ("s2", "i1", "7", "ocr_unvalidated"), ("s3", "i1", "7", "hint_remainder"), ("s4", "i2", "8", "hint_remainder"), ("s5", "i1", "7", "unheard_of"), ("s6", None, None, "ghost")]
    s = spark.createDataFrame(rows, "id string, identity_id string, assigned_bib string, match_type string")
    r = spark.createDataFrame([("i1", "g1", 4)], "identity_id string, ghost_id string, rank int")
    got = {x.id: (x.identity_id, x.assigned_bib, x.match_type) for x in bank.release_subjects(s, r).collect()}
    assert got == {"s1": ("i1", "7", "golden_sample"), "s2": ("g1", None, "ghost"), "s3": ("g1", None, "ghost"), "s4": ("i2", "8", "hint_remainder"), "s5": ("i1", "7", "unheard_of"), "s6": (None, None, "ghost")}


def test_ensure_gives_ghosts_to_the_unread(spark):
    rows = [("p", "7", 1, [1.0, 0.0], None, "golden_sample"), ("p", None, 2, [0.0, 1.0], None, "ghost"), ("p", None, 3, None, None, "ghost")]
    e = spark.createDataFrame(rows, "project_id string, bib string, seq long, face array<double>, reid array<double>, match_type string")
    got = bank.ensure(e).collect()
    assert sorted((r.bib or "", r.enrollment_type, r.sighting_count) for r in got) == [("", "ghost", 1), ("", "ghost", 1), ("7", "golden_sample", 2)]
    assert {r.id for r in got} == {r.id for r in bank.ensure(e).collect()}


def test_next_fit_streams_through_large_groups(spark):
    n = 30_000
    df = spark.range(n).select(F.col("id").alias("i"), (F.col("id") * 31 % 90 + 1).alias("w"), F.lit("x").alias("other"))
    out = reports.next_fit(df, "i", "w")
    assert out.columns == ["i", "w", "other", "batch"]
    batch = fill = 0
    want = {}
    for i in range(n):
        w = i * 31 % 90 + 1
        batch, fill = (batch + 1, w) if fill and fill + w > 128 else (batch, fill + w)
        want[i] = batch
    assert {r.i: r.batch for r in out.collect()} == want
