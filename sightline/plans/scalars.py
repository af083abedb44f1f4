"""Queries over scalar functions: identifiers, times, texts, boxes."""

from __future__ import annotations

import base64

from pyspark.sql import functions as F

from ..config import DEFAULT_RANK, INTENT_PRIORITY
from ..functions import bibs, crypto, geometry, text, timeparse, vectors
from .registry import query


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("digit_extract", sql="""
with runs as (select page_id, url, regexp_extract_all(url, '[0-9]+') as r from pages)
select page_id, case when len(r) > 0 then r[list_position(list_transform(r, lambda x: length(x)), list_max(list_transform(r, lambda x: length(x))))] end as digits from runs
""")
def digit_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", bibs.digit_run(F.col("url")).alias("digits"))


@query("finish_time_parse", sql="""
select event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::double as seconds,
       (hour(ts) * 3600 + minute(ts) * 60)::double as seconds_12h,
       hour(ts) * 3600 + minute(ts) * 60 + second(ts) as whole, null::double as bad
from events
""")
def finish_time_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "H:mm:ss").alias("t24"), F.date_format("ts", "h:mm a").alias("t12"))
    return e.select("event_id", timeparse.finish_seconds(F.col("t24")).alias("seconds"), timeparse.finish_seconds(F.col("t12")).alias("seconds_12h"), timeparse.whole_seconds(F.col("t24")).alias("whole"), timeparse.finish_seconds(F.concat(F.lit("x"), F.col("t24"))).alias("bad"))


@query("corrected_time_parse", sql="""
select event_id, round(epoch(ts), 3) as from_text, event_id::double as from_number, null::double as bad from events
""")
def corrected_time_parse(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.round(timeparse.epoch_or_time(F.date_format("ts", "yyyy:MM:dd HH:mm:ss.SSSSSS")), 3).alias("from_text"), timeparse.epoch_or_time(F.col("event_id").cast("string")).alias("from_number"), timeparse.epoch_or_time(F.lit("soon")).alias("bad"))


@query("seconds_of_day", sql="""
select event_id, round(hour(ts) * 3600 + minute(ts) * 60 + date_part('microsecond', ts) / 1000000.0, 6) as sod,
       hour(ts) * 3600 + minute(ts) * 60 + second(ts) as wall from events
""")
def seconds_of_day(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    wall = timeparse.wall_clock(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:30")))
    return e.select("event_id", F.round(timeparse.seconds_of_day(F.col("ts")), 6).alias("sod"), (F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)).cast("long").alias("wall"))


@query("uuid5", sql="""
with h as (select c_custkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(c_custkey || '_' || c_name)) as h from customer)
select c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
       || case when substr(h, 17, 1) in ('0', '4', '8', 'c') then '8' when substr(h, 17, 1) in ('1', '5', '9', 'd') then '9'
               when substr(h, 17, 1) in ('2', '6', 'a', 'e') then 'a' else 'b' end
       || substr(h, 18, 3) || '-' || substr(h, 21, 12) as photo_uuid
from h
""")
def uuid5(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", text.uuid5(F.concat(F.col("c_custkey").cast("string"), F.lit("_"), F.col("c_name"))).alias("photo_uuid"))


@query("path_functions", sql="""
select page_id, string_split(url, '/')[-1] as base, right(url, 16) as tail,
       case when starts_with(url, 'https://') then '/mnt/' || substr(url, 9) when not starts_with(url, '/') then '/mnt/' || url else url end as rebased,
       regexp_matches('users/' || page_id || '/projects/7/abc0' , '^users/[0-9]+/projects/[0-9]+/[a-f0-9]+$') as ok_key,
       coalesce(nullif('', ''), nullif(url, ''), 'none') as task
from pages
""")
def path_functions(spark, sf_dir):
    p, url = table(spark, sf_dir, "pages"), F.col("url")
    key = F.concat(F.lit("users/"), F.col("page_id").cast("string"), F.lit("/projects/7/abc0"))
    return p.select("page_id", text.basename(url).alias("base"), text.tail(url).alias("tail"), text.rebased(url, "https://", "/mnt/").alias("rebased"), text.is_object_key(key).alias("ok_key"), text.first_filled(F.lit(""), url, F.lit("none")).alias("task"))


@query("bib_predicates", sql="""
with pairs as (
  select c_custkey::varchar as a, ((c_custkey * 7 + 13) % 400)::varchar as b, c_custkey from customer),
p as (
  select *, length(a) as la, length(b) as lb, case when length(a) < length(b) then a else b end as s, case when length(a) < length(b) then b else a end as l from pairs)
select c_custkey,
  case when a = b then true
       when la = lb and la >= 2 then list_sum(list_transform(range(1, la + 1), lambda i: (a[i] <> b[i])::int)) = 1
       when la <> lb and length(s) >= 2 then regexp_matches(l, array_to_string(string_split(s, ''), '.*'))
       else false end as live,
  case when a = b then true
       when la = lb and la >= 2 then list_sum(list_transform(range(1, la + 1), lambda i: (a[i] <> b[i])::int)) = 1
       when length(s) >= 2 and abs(la - lb) <= 2 then contains(l, s) else false end as close,
  case when a = b then true when length(s) >= 2 and abs(la - lb) <= 2 then contains(l, s) else false end as occlusion,
  la >= 3 and (a::int between 100 and 500 or a::int between 900 and 1200) as in_range
from p
""")
def bib_predicates(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("a"), ((F.col("c_custkey") * 7 + 13) % 400).cast("string").alias("b"))
    a, b = F.col("a"), F.col("b")
    return c.select("c_custkey", bibs.compatible(a, b).alias("live"), bibs.compatible_close(a, b).alias("close"), bibs.occluded(a, b).alias("occlusion"), bibs.in_ranges(a, [(100, 500), (900, 1200)]).alias("in_range"))


@query("box_metrics", sql="""
with b as (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity as x1, l_quantity + 10 as x2, l_linenumber * 5.0 as y1, l_linenumber * 5.0 + 20 as y2,
         l_quantity + l_linenumber as u1, l_quantity + l_linenumber + 12 as u2, 10.0 as v1, 30.0 as v2 from lineitem),
i as (
  select *, greatest(0, least(x2, u2) - greatest(x1, u1)) * greatest(0, least(y2, v2) - greatest(y1, v1)) as inter,
         (x2 - x1) * (y2 - y1) as a1, (u2 - u1) * (v2 - v1) as a2 from b)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(inter / (a1 + a2 - inter), 6) as iou, round(inter / least(a1, a2), 6) as containment,
       x1 <= 5 or y1 <= 5 or x2 >= 55 or y2 >= 55 as border, round(x1 / 1920, 4) as bbox_x, round((x2 - x1) * (y2 - y1) / (1920 * 1280), 6) as area_pct
from i
""")
def box_metrics(spark, sf_dir):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    a = (q, n * 5.0, q + 10, n * 5.0 + 20)
    b = (q + n, F.lit(10.0), q + n + 12, F.lit(30.0))
    r = geometry.relative(a, F.lit(0), F.lit(0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(geometry.iou(a, b), 6).alias("iou"), F.round(geometry.containment(a, b), 6).alias("containment"), geometry.touches_border(a, F.lit(60), F.lit(60)).alias("border"), r["bbox_x"].alias("bbox_x"), r["area_pct"].alias("area_pct"))


@query("intent_priority", sql="""
select o_orderkey, case o_orderstatus when 'F' then 0 when 'P' then 2 else 8 end as priority,
       row_number() over (partition by o_custkey order by case o_orderstatus when 'F' then 0 when 'P' then 2 else 8 end, o_orderkey) as place,
       case when o_orderpriority = '1-URGENT' then 640 else 1920 end as preset
from orders
""")
def intent_priority(spark, sf_dir):
    from pyspark.sql import Window

    kind = F.when(F.col("o_orderstatus") == "F", "golden_sample").when(F.col("o_orderstatus") == "P", "golden_delayed").otherwise("unheard_of")
    o = table(spark, sf_dir, "orders").withColumn("priority", text.rank_of(kind, INTENT_PRIORITY, DEFAULT_RANK))
    return o.select("o_orderkey", "priority", F.row_number().over(Window.partitionBy("o_custkey").orderBy("priority", "o_orderkey")).alias("place"), text.image_preset(F.when(F.col("o_orderpriority") == "1-URGENT", "probe_calibration").when(F.col("o_orderpriority") != "5-LOW", "bib_detection")).alias("preset"))


@query("vector_functions", sql="""
with pairs as (
  select a.vec_id, a.embedding::double[] as a, b.embedding::double[] as b from embeddings a join embeddings b on b.vec_id = a.vec_id + 1),
mixed as (
  select *, list_transform(range(1, len(a) + 1), lambda i: 0.8 * a[i] + (1 - 0.8) * b[i]) as m from pairs)
select vec_id, round(list_cosine_similarity(a, b), 6) as sim, round(1 - list_cosine_similarity(a, b), 6) as dist, null::double as dist_null, 0.0::double as sim_null,
       round(m[1] / sqrt(list_sum(list_transform(m, lambda x: x * x))), 6) as ema_first,
       list_cosine_similarity(a, b) >= 0.25 as passes,
       round(case when list_cosine_similarity(a, b) > 0 then list_cosine_similarity(a, b) else 0.5 end, 6) as best,
       round(greatest(0.0, 1 - abs(vec_id % 5 - 2) / 2.0), 6) as proximity
from mixed
""")
def vector_functions(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    p = e.select("vec_id", F.col("embedding").alias("a")).join(e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b")), "vec_id")
    a, b, none = F.col("a"), F.col("b"), F.lit(None).cast("array<float>")
    sim = vectors.cosine(a, b)
    return p.select("vec_id", F.round(sim, 6).alias("sim"), F.round(vectors.cosine_distance(a, b), 6).alias("dist"), vectors.cosine_distance(a, none).alias("dist_null"), vectors.cosine(a, none).alias("sim_null"), F.round(F.get(vectors.ema(a, b), 0), 6).alias("ema_first"), vectors.gate(sim, F.lit(0.0), 0.25, 0.85, 0.88, 0.6).alias("passes"), F.round(vectors.best_similarity(sim, F.lit(0.5)), 6).alias("best"), F.round(text.time_proximity(F.col("vec_id") % 5 - 2, 2.0), 6).alias("proximity"))


@query("fernet_round_trip", sql="""
select c_custkey, c_name as text, true as signed, false as other_key, 1700000000 + c_custkey as made, 4 * ((57 + (strlen(c_name) // 16 + 1) * 16 + 2) // 3) as size from customer
""")
def fernet_round_trip(spark, sf_dir):
    """Tokens that come back with their key and not with another."""
    key, other = (base64.urlsafe_b64encode(bytes(range(n, n + 32))).decode() for n in (0, 7))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    token = crypto.encrypt(F.encode("c_name", "UTF-8"), key, 1_700_000_000 + F.col("c_custkey"), F.unhex(F.md5(F.col("c_custkey").cast("string"))))
    t = c.withColumn("token", token)
    return t.select("c_custkey", crypto.decrypt(F.col("token"), key).cast("string").alias("text"), F.startswith("token", F.lit("gAAAAA")).alias("signed"), crypto.decrypt(F.col("token"), other).isNotNull().alias("other_key"), crypto.issued_at(F.col("token")).alias("made"), F.length("token").cast("long").alias("size"))
