"""Queries over joins on closeness and over the gallery."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import SETTINGS, Settings
from ..functions.bibs import compatible, occluded
from ..functions.timeparse import seconds_of_day
from ..operators import bank, gallery, joins
from .burst_sql import COMPAT_SQL
from .registry import query
from .scalars import table

SOD_SQL = "(hour(ts) * 3600 + minute(ts) * 60)::double + date_part('microsecond', ts) / 1000000.0"


def _sods(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", seconds_of_day(F.col("ts")).alias("sod"))


def _finishes(spark, sf_dir):
    e = _sods(spark, sf_dir).where("event_type = 'purchase'")
    return e.groupBy(F.col("user_id").alias("bib")).agg(F.min_by("sod", "ts").alias("finish"))


@query("timing_hint_range_join", sql=f"""
with s as (select *, {SOD_SQL} as sod from events),
f as (select user_id as bib, arg_min(sod, ts) as finish from s where event_type = 'purchase' group by user_id)
select event_id, bib, round(abs(sod - finish), 6) as delta from s join f on abs(sod - finish) <= 2.0
""")
def timing_hint_range_join(spark, sf_dir):
    near = joins.range_join(_sods(spark, sf_dir), _finishes(spark, sf_dir), "sod", "finish", SETTINGS.hint_window_s)
    return near.select("event_id", "bib", F.round(F.abs(F.col("sod") - F.col("finish")), 6).alias("delta"))


@query("burst_hints", sql=f"""
with s as (select *, {SOD_SQL} as sod from events),
f as (select user_id as bib, arg_min(sod, ts) as finish from s where event_type = 'purchase' group by user_id),
h as (select distinct event_type, bib from s join f on abs(sod - finish) <= 2.0 where event_type <> 'purchase'),
claimed as (select distinct event_type, user_id as bib from s where event_type = 'error')
select event_type, list_sort(list(bib)) as hints, count(*) as n from h where not exists (select 1 from claimed c where c.event_type = h.event_type and c.bib = h.bib) group by event_type
""")
def burst_hints(spark, sf_dir):
    s = _sods(spark, sf_dir)
    h = joins.range_join(s.where("event_type <> 'purchase'"), _finishes(spark, sf_dir), "sod", "finish", SETTINGS.hint_window_s).groupBy("event_type").agg(F.collect_set("bib").alias("h"))
    claimed = s.where("event_type = 'error'").groupBy("event_type").agg(F.collect_set("user_id").alias("c"))
    left = F.array_except("h", F.coalesce("c", F.array().cast("array<bigint>")))
    return h.join(claimed, "event_type", "left").select("event_type", F.sort_array(left).alias("hints"), F.size(left).cast("long").alias("n")).where("n > 0")


def _readings(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 37 % 1777).cast("string").alias("reading"))


def _known(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("bib"))


READINGS_SQL = "r as (select p_partkey, (p_partkey * 37 % 1777)::varchar as reading from part), k as (select c_custkey::varchar as bib from customer)"


@query("fuzzy_bib_join", sql=f"with {READINGS_SQL} select p_partkey, reading, bib from r join k on {COMPAT_SQL.format(a='reading', b='bib')}")
def fuzzy_bib_join(spark, sf_dir):
    return joins.fuzzy_join(_readings(spark, sf_dir), _known(spark, sf_dir), "reading", "bib").select("p_partkey", "reading", "bib")


@query("occlusion_join", sql=f"""with {READINGS_SQL}
select p_partkey, reading, bib from r join k on reading = bib
  or (least(length(reading), length(bib)) >= 2 and abs(length(reading) - length(bib)) <= 2 and (contains(reading, bib) or contains(bib, reading)))""")
def occlusion_join(spark, sf_dir):
    return joins.fuzzy_join(_readings(spark, sf_dir), _known(spark, sf_dir), "reading", "bib", predicate=occluded).select("p_partkey", "reading", "bib")


@query("course_reading_join", sql=f"""with {READINGS_SQL}
select p_partkey, bib from r join k on reading = bib
  or case when p_partkey % 2 = 0 then least(length(reading), length(bib)) >= 2 and abs(length(reading) - length(bib)) <= 2 and (contains(reading, bib) or contains(bib, reading))
          else {COMPAT_SQL.format(a='reading', b='bib')} end""")
def course_reading_join(spark, sf_dir):
    intents = _readings(spark, sf_dir).select(F.col("p_partkey").alias("intent_id"), F.col("reading").alias("bib"), F.when(F.col("p_partkey") % 2 == 0, 0.9).otherwise(0.7).alias("conf"))
    known = _known(spark, sf_dir).select("bib", F.col("bib").alias("identity_id"))
    return gallery.course_candidates(intents, known).select(F.col("intent_id").alias("p_partkey"), F.col("known_bib").alias("bib"))


@query("time_compatible_reroute", sql=f"""
with s as (select *, {SOD_SQL} as sod from events),
f as (select user_id::varchar as bib, arg_min(sod, ts) as finish from s where event_type = 'purchase' group by user_id),
e as (select event_id, user_id::varchar as own, sod from s where event_type = 'click')
select event_id, bib from e join f on own <> bib and abs(sod - finish) <= 20.0 and {COMPAT_SQL.format(a='own', b='bib')}
""")
def time_compatible_reroute(spark, sf_dir):
    clicks = _sods(spark, sf_dir).where("event_type = 'click'").select("event_id", F.col("user_id").cast("string").alias("own"), "sod")
    finishes = _finishes(spark, sf_dir).select(F.col("bib").cast("string").alias("bib"), "finish")
    near = joins.range_join(clicks, finishes, "sod", "finish", SETTINGS.delayed_window_s)
    return near.where((F.col("own") != F.col("bib")) & compatible(F.col("own"), F.col("bib"))).select("event_id", "bib")


@query("cosine_pairs", sql="""
select a.vec_id as a, b.vec_id as b, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as similarity
from embeddings a join embeddings b on a.vec_id < b.vec_id and list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.3
""")
def cosine_pairs(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return gallery.similar_pairs(v, 0.3, "vec_id").select("a", "b", F.round("similarity", 6).alias("similarity"))


KNN_SQL = """
q as (select vec_id as query_id, embedding::double[] as v from embeddings where vec_id % 20 = 0),
g as (select vec_id as identity_id, embedding::double[] as v, label from embeddings),
n as (
  select query_id, identity_id, label, list_cosine_similarity(q.v, g.v) as similarity,
         row_number() over (partition by query_id order by list_cosine_similarity(q.v, g.v) desc, identity_id) as rank
  from q cross join g)
"""


def _knn(spark, sf_dir, k=5):
    e = table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    g = e.select(F.col("vec_id").alias("identity_id"), F.col("embedding").alias("vec"))
    return gallery.nearest(q, g, k), e


@query("knn_topk", sql=f"with {KNN_SQL} select query_id, identity_id, round(similarity, 6) as similarity, rank from n where rank <= 5")
def knn_topk(spark, sf_dir):
    return _knn(spark, sf_dir)[0].select("query_id", "identity_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("long").alias("rank"))


@query("knn_first_gate", sql=f"with {KNN_SQL} select query_id, arg_min(identity_id, rank) as identity_id from n where rank <= 5 and similarity >= 0.25 and label % 2 = 0 group by query_id")
def knn_first_gate(spark, sf_dir):
    hits, e = _knn(spark, sf_dir)
    hits = hits.join(e.select(F.col("vec_id").alias("identity_id"), "label"), "identity_id")
    return hits.where((F.col("similarity") >= 0.25) & (F.col("label") % 2 == 0)).groupBy("query_id").agg(F.min_by("identity_id", "rank").alias("identity_id"))


SMALL = Settings(gate_face=0.2, gate_reid=0.9, gate_reid_strong=0.95, gate_face_floor=0.1, tiebreak_gap=0.02)


@query("course_tiebreak", sql="""
with c as (
  select a.vec_id as intent, b.vec_id as identity_id, list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as s
  from embeddings a join embeddings b on a.label = b.label and a.vec_id <> b.vec_id ),
p as (select *, 0.4 * s + 0.6 * 0.0 as score, row_number() over (partition by intent order by s desc, identity_id) as r, count(*) over (partition by intent) as n from c where s >= 0.2),
t as (select intent, n, max(case when r = 1 then identity_id end) as id, max(case when r = 1 then score end) - max(case when r = 2 then score end) as gap from p where r <= 2 group by intent, n)
select i.intent, case when t.n = 1 or t.gap >= 0.02 then t.id end as identity_id, coalesce(t.n, 0) as n_passing
from (select distinct intent from c) i left join t on i.intent = t.intent
""")
def course_tiebreak(spark, sf_dir):
    out = gallery.tiebreak_faces(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding", SMALL)
    return out.select("intent", "identity_id", F.col("n_passing").cast("long").alias("n_passing"))


@query("course_resolve", sql=f"""
with g as (select vec_id as identity_id, (vec_id * 3)::varchar as bib, embedding::double[] as v from embeddings where vec_id % 4 <> 0),
i as (select vec_id as intent_id, case when vec_id % 8 = 0 then (vec_id * 3 + 1)::varchar end as bib, case when vec_id % 16 = 0 then 0.9 else 0.7 end as conf, embedding::double[] as v from embeddings where vec_id % 4 = 0),
c as (
  select intent_id, identity_id, list_cosine_similarity(i.v, g.v) as s from i join g on i.bib = g.bib
    or case when conf >= 0.85 then least(length(i.bib), length(g.bib)) >= 2 and abs(length(i.bib) - length(g.bib)) <= 2 and (contains(i.bib, g.bib) or contains(g.bib, i.bib))
            else {COMPAT_SQL.format(a='i.bib', b='g.bib')} end
  where i.bib is not null),
p as (select *, 0.4 * s as score, row_number() over (partition by intent_id order by s desc, identity_id) as r, count(*) over (partition by intent_id) as n from c where s >= 0.2),
t as (select intent_id, n, max(case when r = 1 then identity_id end) as id, max(case when r = 1 then score end) - max(case when r = 2 then score end) as gap from p where r <= 2 group by intent_id, n),
bybib as (
  select x.intent_id, x.n, case when t.n = 1 or t.gap >= 0.02 then t.id end as identity_id from (select intent_id, count(*) as n from c group by intent_id) x left join t using (intent_id)),
k as (
  select intent_id, identity_id, s, row_number() over (partition by intent_id order by s desc, identity_id) as r
  from (select i.intent_id, g.identity_id, list_cosine_similarity(i.v, g.v) as s from i cross join g where i.intent_id not in (select intent_id from bybib))),
near as (select intent_id, arg_min(identity_id, r) as identity_id from k where r <= 5 and s >= 0.2 group by intent_id)
select intent_id, identity_id, case when identity_id is not null then 'course_ocr_validated' when n = 1 then 'course_bib_conflict' else 'course_ocr_ambiguous' end as match_type from bybib
union all
select i.intent_id, near.identity_id, case when near.identity_id is not null then 'course_biometric_match' else 'course_ghost' end
from i left join near using (intent_id) where i.intent_id not in (select intent_id from bybib)
""")
def course_resolve(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    none = F.lit(None).cast("array<float>")
    g = e.where("vec_id % 4 <> 0").select(F.col("vec_id").alias("identity_id"), (F.col("vec_id") * 3).cast("string").alias("bib"), F.col("embedding").alias("face"), none.alias("reid"))
    i = e.where("vec_id % 4 = 0").select(F.col("vec_id").alias("intent_id"), F.when(F.col("vec_id") % 8 == 0, (F.col("vec_id") * 3 + 1).cast("string")).alias("bib"), F.when(F.col("vec_id") % 16 == 0, 0.9).otherwise(0.7).alias("conf"), F.col("embedding").alias("face"), none.alias("reid"))
    return gallery.resolve_course(i, g, SMALL)


GHOST_SQL = """
c as (select vec_id as confirmed_id, vec_id::varchar as bib, label, embedding::double[] as v from embeddings where vec_id % 3 = 0),
g as (select vec_id as ghost_id, label, embedding::double[] as v from embeddings where vec_id % 3 <> 0),
subj as (select l_orderkey as photo_id, l_partkey % 500 as identity_id, l_linenumber, (l_partkey % 500 + l_linenumber % 3)::varchar as ocr_bib, l_suppkey from lineitem),
m as (select label, confirmed_id, bib, ghost_id, round(1 - list_cosine_similarity(c.v, g.v), 6) as face_dist from c join g using (label) where 1 - list_cosine_similarity(c.v, g.v) <= 1 - 0.15)
"""


def _ghosts(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    none = F.lit(None).cast("array<float>")
    both = e.select(F.col("vec_id").alias("id"), F.col("vec_id").cast("string").alias("bib"), "label", F.col("embedding").alias("face"), none.alias("reid"))
    subjects = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("photo_id"), (F.col("l_partkey") % 500).alias("identity_id"), (F.col("l_partkey") % 500 + F.col("l_linenumber") % 3).cast("string").alias("ocr_bib"))
    confirmed, ghosts = both.where("id % 3 = 0"), both.where("id % 3 <> 0").drop("bib")
    return confirmed, ghosts, subjects, bank.ghost_matches(confirmed, ghosts, ["label"], 0.15, 0.85, 0.6)


@query("ghost_match", sql=f"with {GHOST_SQL} select label, confirmed_id, ghost_id, face_dist from m")
def ghost_match(spark, sf_dir):
    return _ghosts(spark, sf_dir)[3].select("label", "confirmed_id", "ghost_id", F.round("face_dist", 6).alias("face_dist"))


@query("ghost_cophoto_exclusion", sql=f"""with {GHOST_SQL}
select confirmed_id, ghost_id from m where not exists (
  select 1 from subj a join subj b on a.photo_id = b.photo_id where a.identity_id = m.confirmed_id and b.identity_id = m.ghost_id)""")
def ghost_cophoto_exclusion(spark, sf_dir):
    _, _, subjects, m = _ghosts(spark, sf_dir)
    return bank.without_shared_photos(m, subjects).select("confirmed_id", "ghost_id")


@query("ghost_ocr_veto", sql=f"""with {GHOST_SQL}, s as (select distinct identity_id, ocr_bib from subj)
select confirmed_id, ghost_id from m where not exists (select 1 from s where s.identity_id = m.ghost_id and not {COMPAT_SQL.format(a='s.ocr_bib', b='m.bib')})""")
def ghost_ocr_veto(spark, sf_dir):
    _, _, subjects, m = _ghosts(spark, sf_dir)
    return bank.without_veto(m, subjects).select("confirmed_id", "ghost_id")


@query("ghost_adoption", sql=f"""with {GHOST_SQL}, s as (select distinct identity_id, ocr_bib from subj where l_linenumber = 1 and identity_id % 3 = 0),
ok as (
  select * from m where not exists (select 1 from subj a join subj b on a.photo_id = b.photo_id where a.identity_id = m.confirmed_id and b.identity_id = m.ghost_id)),
won as (select ghost_id, confirmed_id, bib from (select *, row_number() over (partition by ghost_id order by bib, confirmed_id) as r from ok) where r = 1)
select coalesce(w.confirmed_id, x.identity_id) as identity_id, case when w.ghost_id is not null then 'ghost_adopted' else 'ghost' end as match_type, w.bib as assigned_bib, count(*) as n
from subj x left join won w on x.identity_id = w.ghost_id group by all""")
def ghost_adoption(spark, sf_dir):
    confirmed, ghosts, subjects, _ = _ghosts(spark, sf_dir)
    s = subjects.select("photo_id", "identity_id", F.lit(None).cast("string").alias("ocr_bib"), F.lit(None).cast("string").alias("assigned_bib"), F.lit("ghost").alias("match_type"))
    after, _, _ = bank.adopt(confirmed, ghosts, s, ["label"], 0.15, 0.85, 0.6)
    return after.groupBy("identity_id", "match_type", "assigned_bib").agg(F.count("*").alias("n"))


@query("empty_ghost_purge", sql="""
select vec_id as id from embeddings where exists (select 1 from lineitem where l_partkey % 700 = vec_id and l_quantity > 49 and l_returnflag = 'A') or vec_id % 3 <> 1
""")
def empty_ghost_purge(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    s = table(spark, sf_dir, "lineitem").where("l_quantity > 49 and l_returnflag = 'A'").select((F.col("l_partkey") % 700).alias("identity_id"))
    return bank.purge_empty(e, s, e.where("id % 3 = 1"))


@query("cophoto_bibs", sql="""
with c as (select distinct l_orderkey as photo_id, l_suppkey as cluster, l_partkey % 100 as bib from lineitem)
select a.cluster, list_sort(list(distinct b.bib)) as siblings from c a join c b on a.photo_id = b.photo_id and a.cluster <> b.cluster group by a.cluster
""")
def cophoto_bibs(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("photo_id"), F.col("l_suppkey").alias("cluster"), (F.col("l_partkey") % 100).alias("bib")).distinct()
    other = c.select("photo_id", F.col("cluster").alias("_o"), F.col("bib").alias("_b"))
    return c.join(other, "photo_id").where("cluster <> _o").groupBy("cluster").agg(F.sort_array(F.collect_set("_b")).alias("siblings"))
