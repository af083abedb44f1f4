"""The folds: overlapping boxes, voting, clustering, the cascade and the identity bank."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.config import SETTINGS
from sightline.operators import bank, bursts, consensus, detections, gallery, reports
from sightline.operators.bursts import Burst, Case, Crop, cluster_crops, resolve, surviving, vote


def test_overlap_chain_keeps_first_and_last():
    boxes = [(0, 0, 10, 10), (3, 0, 13, 10), (6, 0, 16, 10)]
    tight = SETTINGS.__class__(nms_iou=0.5, nms_containment=0.65)
    assert surviving(boxes, [0.9, 0.8, 0.7], tight) == [0, 2]


def test_overlap_of_rising_confidence():
    boxes = [(0, 0, 10, 10)] * 3
    assert surviving(boxes, [0.1, 0.2, 0.3]) == [2]
    assert surviving(boxes, [0.3, 0.3, 0.3]) == [0]
    assert surviving([], []) == []


def test_vote():
    assert vote([("3319", 0.9), ("3315", 0.7), ("319", 0.95)]) == ("3319", pytest.approx(0.9))
    assert vote([]) == (None, 0.0)


def test_vote_equals_relational_vote(spark):
    random.seed(4)
    rows = [(g, s, "".join(random.choice("12") for _ in range(random.choice([3, 4]))), round(random.choice([0.6, 0.7, 0.9]), 2)) for g in range(40) for s in range(random.randint(1, 6))]
    df = spark.createDataFrame(rows, "g long, seq long, bib string, conf double")
    got = {r.g: (r.consensus_bib, r.consensus_conf) for r in consensus.consensus(df, ["g"]).collect()}
    for g in range(40):
        bib, conf = vote([(r[2], r[3]) for r in rows if r[0] == g])
        assert got[g][0] == bib and got[g][1] == pytest.approx(conf)


def crop(seq, photo, bib=None, face=None, reid=None, conf=0.9, **kw):
    vec = lambda v: None if v is None else np.array(v, float)
    return Crop(seq, photo, kw.get("sod"), [(bib, conf)] if bib else [], False, 0.9, vec(face), vec(reid))


def test_cluster_rules():
    sizes = lambda crops, hints=(): [len(c.crops) for c in cluster_crops(crops, set(hints))]
    assert sizes([crop(1, "a", "416"), crop(2, "b", "41")]) == [1, 1]  # readings of two characters are not used
    assert sizes([crop(1, "a", "416"), crop(2, "b", "4167")]) == [2]
    assert sizes([crop(1, "a", "416"), crop(2, "a", "416")]) == [1, 1]  # never twice in a photo
    assert sizes([crop(1, "a", "319"), crop(2, "b", "3315")]) == [1, 1]
    same = {"face": [1, 0], "reid": [1, 0]}
    assert sizes([crop(1, "a", "319", **same), crop(2, "b", "3315", **same)]) == [1, 1]
    assert sizes([crop(1, "a", "319", **same), crop(2, "b", "3315", **same)], ["3319"]) == [2]  # a hint explains both
    assert sizes([crop(1, "a", "3223"), crop(2, "b", "3224")], ["3223", "3224"]) == [1, 1]
    assert sizes([crop(1, "a", "416", **same), crop(2, "b", "416", [0, 1], [0, 1])]) == [1, 1]  # the vectors speak against it


def case(i, bib=None, conf=0.9, **kw):
    base = {"size": 1, "photos": {f"p{i}"}, "best_bibs": {bib} if bib else set(), "sods": [], "face": None, "reid": None, "own_hints": set(), "finish": None, "valid": False, "registered": False, "valid_best": set(), "alternatives": set()}
    return Case(i, bib, conf, **(base | kw))


def outcome(cases, hints=None, sod=100.0, any_valid=False):
    return resolve(cases, Burst(dict.fromkeys(hints or [], 100.0), sod, any_valid, {}, SETTINGS))


def test_cascade():
    face = np.array([1.0, 0.0])
    assert outcome([case(0, "416")], ["416"]) == {0: ("416", "golden_sample")}
    assert outcome([case(0, "416"), case(1, "416", 0.8)], ["416"]) == {0: ("416", "golden_sample"), 1: (None, "ghost")}
    assert outcome([case(0, "416")], ["4167", "7416"]) == {0: (None, "ghost_ambiguous_partial")}
    assert outcome([case(0, "416")], ["4167"]) == {0: ("4167", "golden_partial")}
    assert outcome([case(0, "416", photos={"x"}), case(1, "4167", 0.5, photos={"x"})], ["4167"])[0] == (None, "ghost")
    assert outcome([case(0, "185")], ["785"])[0] == ("785", "golden_partial")  # one wrong character comes first
    assert outcome([case(0, "185")], ["1B5", "785"])[0] == (None, "ghost_ambiguous_partial")
    assert outcome([case(0, "500", finish=115.0)]) == {0: ("500", "golden_delayed")}
    assert outcome([case(0, "500", finish=120.0)]) == {0: ("500", "golden_delayed")}
    assert outcome([case(0, "500", finish=120.001)]) == {0: (None, "ghost")}
    assert outcome([case(0, "500", finish=300.0, alternatives={"501"})]) == {0: ("501", "golden_delayed")}
    assert outcome([case(0, "500", finish=300.0, alternatives={"501", "502"})]) == {0: (None, "ghost")}
    assert outcome([case(0, "500", finish=300.0)], sod=None) == {0: ("500", "golden_delayed")}
    assert outcome([case(0, "500", valid=True, registered=True)]) == {0: ("500", "ocr_unvalidated")}
    assert outcome([case(0, "500", registered=True)]) == {0: ("500", "ocr_registered")}
    assert outcome([case(0, "500", best_bibs={"500", "777"})]) == {0: (None, "ghost_multi_bib")}
    assert outcome([case(0, face=face, own_hints={"9"})], ["9"]) == {0: ("9", "blind_trust")}
    assert outcome([case(0, face=face, own_hints={"8", "9"}), case(1, face=face, size=5, own_hints={"8", "9"})], ["8", "9"]) == {0: ("9", "hint_remainder"), 1: ("8", "hint_remainder")}
    assert outcome([case(0)], ["9"]) == {0: (None, "ghost")}


def test_bank_fold():
    e = bank.Enrollment("p", "1")
    e.add(1, [1, 0], None, "golden_sample")
    assert e.now["sighting_count"] == 2
    assert e.add(2, [0, 1], None, "ocr_registered") != e.now["id"] and e.now["sighting_count"] == 2  # too unlike
    e.add(3, [0.95, 0.3], None, "ocr_registered")
    assert e.now["sighting_count"] == 3 and np.linalg.norm(e.now["face"]) == pytest.approx(1)
    f = bank.Enrollment("p", "2")
    f.add(1, [1, 0], [1, 0], "ghost_adopted")
    f.add(2, [0, 1], None, "golden_sample")  # a better kind takes over, whatever the vectors
    assert f.now["enrollment_type"] == "golden_sample" and list(f.now["reid"]) == [1, 0] and len(f.ghosts) == 1
    assert bank.Enrollment("p", "3", compat=False).add(1, [1, 0], None, "ghost")


def test_bank_in_two_batches_equals_one(spark):
    random.seed(1)
    rows = [("p", str(i % 3), i, [random.gauss(1, 1), random.gauss(0, 1)], None, random.choice(["golden_sample", "ocr_registered", "blind_trust"])) for i in range(60)]
    df = spark.createDataFrame(rows, "project_id string, bib string, seq long, face array<double>, reid array<double>, match_type string")
    key = lambda t: sorted((r.id, r.bib or "", r.sighting_count, r.enrollment_type, tuple(np.round(r.face, 9)), len(r.shards)) for r in t.collect())
    once = bank.enroll(df)
    twice = bank.enroll(df.where("seq >= 30"), bank.enroll(df.where("seq < 30")))
    assert key(once) == key(twice)
    assert key(once) == key(bank.enroll(df.orderBy(F.rand(3))))


def test_anchor_falls_back_to_first_box(spark):
    df = spark.createDataFrame([("i", 1, 0.0, True), ("i", 2, 5.0, True), ("i", 3, 9.0, True), ("j", 1, 0.0, False)], "image string, seq int, area double, border boolean")
    got = {(r.image, r.seq): r.anchor for r in detections.with_anchor(df, "image", "seq").collect()}
    assert got == {("i", 1): 5.0, ("i", 2): 5.0, ("i", 3): 5.0, ("j", 1): 1.0}


def test_tiebreak_gap(spark):
    rows = [("a", "x", 0.8, 0.8), ("a", "y", 0.8, 0.74), ("b", "x", 0.8, 0.8), ("b", "y", 0.8, 0.6), ("c", "x", 0.1, 0.1), ("d", "x", 0.9, 0.0)]
    df = spark.createDataFrame(rows, "i string, identity_id string, face_sim double, reid_sim double")
    got = {r.i: (r.identity_id, r.n_passing) for r in gallery.tiebreak(df, ["i"]).collect()}
    assert got == {"a": (None, 2), "b": ("x", 2), "c": (None, 0), "d": ("x", 1)}


def test_nearest_in_blocks_equals_one_block(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(90)]
    g = spark.createDataFrame(rows, "identity_id long, vec array<double>")
    q = g.where("identity_id < 9").withColumnRenamed("identity_id", "query_id")
    key = lambda t: sorted((r.query_id, r.rank, r.identity_id) for r in t.collect())
    assert key(gallery.nearest(q, g, 4)) == key(gallery.nearest(q, g, 4, block_rows=20))
    monkeypatch.setattr(gallery, "QUERY_ROWS", 7)  # several copies of each block
    assert key(gallery.nearest(q, g, 4)) == key(gallery.nearest(q, g, 4, block_rows=20))
    pairs = lambda n: sorted((r.a, r.b, round(r.similarity, 9)) for r in gallery.similar_pairs(g, 0.2, "identity_id", block_rows=n).collect())
    assert pairs(10_000) == pairs(20) and pairs(20)
    close = lambda n: sorted(map(tuple, gallery.close_pairs(g.withColumn("k", F.col("identity_id") % 3), q.withColumn("k", F.col("query_id") % 3), ["k"], 0.2, "identity_id", "query_id", "vec", n).collect()))
    assert close(10_000) == close(20) and close(20)
    assert gallery.nearest(q, g.limit(0), 4).count() == 0


def test_next_fit(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([100, 28, 1, 300, 5])], "i long, w long")
    assert {r.i: r.batch for r in reports.next_fit(df, "i", "w").collect()} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3}


def test_purge_and_empty_tables(spark):
    s = spark.createDataFrame([], "identity_id string, photo_id string, ocr_bib string, assigned_bib string, match_type string")
    ids = spark.createDataFrame([("a", "p", "1", [1.0], None)], "id string, project_id string, bib string, face array<double>, reid array<double>")
    assert bank.purge_empty(ids, s).count() == 0
    after, ghosts, won = bank.adopt(ids, ids.drop("bib"), s, ["project_id"], 0.7, 0.8, 0.6)
    assert after.count() == 0 and won.count() == 1 and ghosts.count() == 0
    assert bursts.suppress_overlaps(spark.createDataFrame([], "image long, seq long, x1 double, y1 double, x2 double, y2 double, confidence double")).count() == 0
