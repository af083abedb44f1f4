"""Messages, streams, transactions and SQL functions."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.functions import sql as sql_functions
from sightline.functions.bibs import blocking_keys
from sightline.operators import bank, reports, transactions
from sightline.sources import messages, participants
from sightline.streaming.bursts import bank_sink, current_bank, detections_of, once, run_available
from sightline.streaming.windows import sessions

from .test_functions import PAIRS

IMAGE = {"photo_id": "1", "path": "a", "success": True, "persons": [{"bbox": [0, 0, 1, 1], "is_blurry": False, "face_vec": [1.0]}]}
BURST = {"task_type": "raw_inference_results", "schema_version": 1, "project_id": "p", "burst_id": "b1", "priority": 9, "inference_profile": "full", "processed_at": 1.0, "inference_ms": 2.0, "images": [IMAGE]}


def raw(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def test_parse_and_dead_letters(spark):
    good, dead = messages.parse(raw(spark, BURST, "{", "[]", "", "null", {"burst_id": "b2"}))
    assert sorted(r.burst_id for r in good.collect()) == ["b1", "b2"]
    assert dead.count() == 4


def test_violations(spark):
    image = lambda **kw: {**BURST, "images": [{**IMAGE, **kw}]}
    cases = [(BURST, []), ({**BURST, "images": []}, ["images is empty"]), ({**BURST, "priority": None}, ["missing priority"]), ({**BURST, "inference_profile": "x"}, ["unknown inference_profile"]),
             (image(path=None), ["image lacks a field"]), (image(persons=[{**IMAGE["persons"][0], "bbox": [1, 2]}]), ["bbox must be four numbers"]),
             (image(persons=[{**IMAGE["persons"][0], "face_vec": None}]), ["sharp persons without vectors"]), (image(success=False, persons=[{"bbox": None}]), [])]
    for message, want in cases:
        got = reports.violations(messages.parse(raw(spark, message))[0]).first().violations
        assert got == want


def test_routing(spark):
    df = spark.createDataFrame([("probe_calibration_result", None), ("x", 9), ("x", 8), ("x", None)], "task_type string, priority int")
    assert {k: v.count() for k, v in messages.route(df).items()} == {"calibration": 1, "finish_line": 1, "course": 2}


def test_payload_lengths_must_agree(spark):
    df = spark.createDataFrame([([1, 2], ["a"])], "r array<int>, m array<string>")
    with pytest.raises(Exception, match="as many results"):
        messages.burst_payload(df, "r", "m").collect()


def test_participants(spark):
    p = spark.createDataFrame([("p", "1", "9:00", 1), ("p", "1", "10:00", 2), ("p", "2", "DNF", 1), ("p", "3", "", 1), ("p", None, "9:00", 1), ("p", "4", None, 1)], "project_id string, bib_number string, finish_time string, n int")
    assert [(r.bib, r.finish) for r in participants.timed(p, "n").collect()] == [("1", 36000.0)]
    assert sorted(r.bib for r in participants.valid(p).collect()) == ["1", "2"]
    assert sorted(r.bib for r in participants.registered(p).collect()) == ["1", "2", "3", "4"]
    assert participants.unparsed(p).count() == 4


def test_stream_takes_a_burst_once(spark, tmp_path):
    raw(spark, BURST, BURST, {**BURST, "burst_id": "b2"}, "broken").write.text(f"{tmp_path}/in")
    stream = once(messages.parse(messages.read_stream(spark, f"{tmp_path}/in", 1))[0], "burst_id")
    each = lambda df, n: detections_of(df).select("burst_id", "photo_id", "seq").write.mode("overwrite").parquet(f"{tmp_path}/out/batch={n}")
    run_available(stream, f"{tmp_path}/ck", each).awaitTermination()
    got = spark.read.option("recursiveFileLookup", "true").schema("burst_id string").parquet(f"{tmp_path}/out")
    assert sorted(r.burst_id for r in got.collect()) == ["b1", "b2"]
    raw(spark, BURST).write.mode("append").text(f"{tmp_path}/in")  # comes again after a restart
    run_available(stream, f"{tmp_path}/ck", each).awaitTermination()
    assert spark.read.option("recursiveFileLookup", "true").schema("burst_id string").parquet(f"{tmp_path}/out").count() == 2


def enrollments(spark, n=40):
    rng = np.random.default_rng(2)
    rows = [("p", str(i % 3), i, (rng.normal(size=3) + [2, 0, 0]).tolist(), None, "golden_sample" if i % 5 else "blind_trust", f"b{i}") for i in range(n)]
    return spark.createDataFrame(rows, "project_id string, bib string, seq long, face array<double>, reid array<double>, match_type string, burst_id string")


def test_bank_stream_equals_batch_and_repeats_safely(spark, tmp_path):
    e = enrollments(spark)
    e.coalesce(1).write.parquet(f"{tmp_path}/in")
    key = lambda t: sorted((r.id, r.sighting_count, tuple(np.round(r.face, 9))) for r in t.collect())
    first, second = e.where("seq < 20"), e.where("seq >= 20")
    for every in (50, 2, 1):  # versions alone, with the whole bank now and then, and always
        at, log = f"{tmp_path}/bank{every}", f"{tmp_path}/log{every}"
        sink = bank_sink(at, log, every)
        for n, batch in ((0, first), (0, first), (1, second), (1, second), (2, first), (3, second.where("seq < 0"))):  # runs again, redeliveries, and nothing
            sink(batch, n)
        assert key(current_bank(spark, at)) == key(bank.enroll(e))
        assert key(current_bank(spark, at, 1)) == key(bank.enroll(first))
    run_available(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/ck", bank_sink(f"{tmp_path}/bank", f"{tmp_path}/log")).awaitTermination()
    assert key(current_bank(spark, f"{tmp_path}/bank")) == key(bank.enroll(e))
    assert current_bank(spark, f"{tmp_path}/nothing").count() == 0


def test_bank_stream_writes_what_it_touches(spark, tmp_path):
    e = enrollments(spark)
    sink = bank_sink(f"{tmp_path}/bank", f"{tmp_path}/log")
    one = e.select("bib").first()[0]
    sink(e.where(F.col("bib") != one), 0)
    sink(e.where(F.col("bib") == one), 1)
    assert {r.bib for r in spark.read.parquet(f"{tmp_path}/bank/batch=1").collect()} <= {one, None}


def tables(spark):
    return transactions.Tables(
        spark.createDataFrame([("old", "p", "a.jpg", 1.0, False, "completed")], "id string, project_id string, file_path string, corrected_time double, is_finish_line boolean, status string"),
        spark.createDataFrame([("s0", "old", "p", "g", None, None, "ghost")], "id string, photo_id string, project_id string, identity_id string, ocr_bib string, assigned_bib string, match_type string"),
        spark.createDataFrame([("g", "p", None, [1.0, 0.0], [1.0, 0.0], 1, "ghost", [])], bank.STATE),
    )


def test_finish_line_transaction(spark):
    photos = spark.createDataFrame([("p", "b.jpg", 5.0, True), ("p", "c.jpg", 6.0, True)], "project_id string, file_path string, corrected_time double, is_finish_line boolean")
    d = spark.createDataFrame([("p", "b.jpg", 0, "7", "golden_sample", "7", [1.0, 0.0], [1.0, 0.0]), ("p", "c.jpg", 1, None, "ghost", None, [0.0, 1.0], None)], "project_id string, file_path string, seq long, assigned_bib string, match_type string, ocr_bib string, face array<double>, reid array<double>")
    after = transactions.finish_line(tables(spark), photos, d)
    s = {r.photo_id: r for r in after.subjects.collect()}
    known = after.identities.where("bib = '7'").first().id
    assert s["old"].match_type == "ghost_adopted" and s["old"].identity_id == known and s["old"].assigned_bib == "7"
    assert after.identities.where("id = 'g'").count() == 0 and after.identities.where("bib is null").count() == 1
    assert {r.file_path: (r.status, r.subject_count, r.matched_count) for r in transactions.statuses(after).collect()} == {"a.jpg": ("completed", 1, 1), "b.jpg": ("completed", 1, 1), "c.jpg": ("completed", 1, 0)}
    again = transactions.finish_line(after, photos, d)  # subjects are replaced, not doubled
    assert again.subjects.count() == 3 and again.photos.count() == 3


def test_course_transaction(spark):
    photos = spark.createDataFrame([("p", "a.jpg", 9.0, False)], "project_id string, file_path string, corrected_time double, is_finish_line boolean")
    d = spark.createDataFrame([("p", "a.jpg", 0, "id7", "7", "course_ocr_validated", "7", [1.0, 0.0], None), ("p", "a.jpg", 1, None, None, "course_ghost", None, [0.0, 1.0], None)], "project_id string, file_path string, seq long, identity_id string, assigned_bib string, match_type string, ocr_bib string, face array<double>, reid array<double>")
    after = transactions.course(tables(spark), photos, d)
    assert after.photos.first().id == "old" and after.photos.first().corrected_time == 9.0
    assert sorted(r.match_type for r in after.subjects.collect()) == ["course_ghost", "course_ocr_validated"]
    assert after.identities.count() == 2


def test_sessions(spark):
    df = spark.createDataFrame([("a", 0), ("a", 50), ("a", 200), ("b", 10)], "k string, s long").withColumn("t", F.timestamp_seconds("s"))
    assert sorted((r.k, r.n) for r in sessions(df, ["k"], "t", "60 seconds").collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_sql_functions(spark):
    sql_functions.register(spark)
    spark.createDataFrame([(a, b) for a, b, *_ in PAIRS], "a string, b string").createOrReplaceTempView("pairs_of_bibs")
    got = [tuple(r) for r in spark.sql("select a, b, bib_compatible(a, b), bib_occluded(a, b) from pairs_of_bibs").collect()]
    assert got == [(a, b, c, o) for a, b, c, _, o in PAIRS]
    assert spark.sql("select cosine_similarity(array(1D, 0D), array(1D, 1D))").first()[0] == pytest.approx(0.7071067)
    assert spark.sql("select count(*) from blocking_keys('416', 'left')").first()[0] == len(sql_functions.keys_of("416", "left"))


@pytest.mark.parametrize("bib", ["1", "12", "416", "33190"])
@pytest.mark.parametrize("side", ["left", "right"])
def test_table_function_agrees_with_columns(spark, bib, side):
    got = spark.range(1).select(blocking_keys(F.lit(bib), side)).first()[0]
    assert {k for k in got if not k.startswith(("leftp", "rightp"))} == sql_functions.keys_of(bib, side)


def test_json_of_a_notification(spark):
    rows = spark.createDataFrame([(1, "a", "7", 0.0, 0.8), (1, "a", None, 0.5, 0.5), (1, "b", "7", 0.9, 0.1)], "burst_id long, photo_id string, assigned_bib string, ocr_conf double, consensus_conf double")
    got = json.loads(reports.notification(rows, ["burst_id"]).first().value)
    assert got["runners"] == [{"bib": "7", "confidence": 0.9}] and got["photo_ids"] == ["a", "b"]
    assert got["per_image"]["a"] == {"runners": [{"bib": "7", "confidence": 0.8}], "tags": ["LF"]} and got["per_image"]["b"]["tags"] == []


def test_metrics_and_non_fatal_sinks(spark, tmp_path):
    from sightline.streaming.metrics import Progress, non_fatal, run_every

    raw(spark, BURST, {**BURST, "burst_id": "b2"}).write.text(f"{tmp_path}/in")
    lines, seen = [], []
    listener = Progress(lines.append)
    spark.streams.addListener(listener)

    def each(df, n):
        seen.append(df.count())
        raise ValueError("the receiver is away")

    q = run_every(messages.parse(messages.read_stream(spark, f"{tmp_path}/in"))[0], f"{tmp_path}/ck", non_fatal(each, "notification"))
    q.processAllAvailable()
    q.stop()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    spark.streams.removeListener(listener)
    assert seen[0] == 2 and q.exception() is None
    assert any(json.loads(x)["event"] == "batch" for x in lines)


def test_detections_take_all_boxes_and_embeddings(spark):
    from sightline.plans.bank import _boxes, _detections

    from .conftest import SF

    boxes, vectors = spark.read.parquet(f"{SF}/lineitem.parquet"), spark.read.parquet(f"{SF}/embeddings.parquet")
    d = _detections(spark, SF, _boxes(spark, SF))
    assert d.count() == boxes.count()
    used = boxes.select((F.col("l_partkey") % vectors.count()).alias("vec_id")).distinct().join(vectors, "vec_id")
    assert d.select("face_vec").distinct().count() == used.select("embedding").distinct().count()


def test_boxes_stay_with_their_photos(spark):
    """Two cameras whose order is not that of the photos' names."""
    from sightline.operators.bursts import cluster_bursts

    rows = [("p", "b", photo, camera, seq, 0.0, 0.0, 9.0, 9.0, 0.9, 1.0, False, 0.9, [1.0, 0.0], [1.0, 0.0], [("123", 0.9)], None) for photo, camera, seq in (("z_photo", "camA", 11), ("a_photo", "camB", 22))]
    schema = "project_id string, burst_id string, photo_id string, camera_serial string, seq long, x1 double, y1 double, x2 double, y2 double, confidence double, sod double, is_blurry boolean, face_quality double, face_vec array<double>, reid_vec array<double>, bibs array<struct<bib_number:string,ocr_confidence:double>>, hints array<string>"
    got = cluster_bursts(spark.createDataFrame(rows, schema)).collect()
    assert [(r.photos, [tuple(b) for b in r.boxes]) for r in got] == [(["a_photo", "z_photo"], [("z_photo", 11), ("a_photo", 22)])]
