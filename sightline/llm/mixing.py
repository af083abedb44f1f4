"""Mixing sources to target weights.

Targets are water-filled from the sources' sizes. Every document gets a hash-random key; the keys'
leading bits cut each source into ranges that are sorted apart, and the ranges' sums, summed up in
key order, turn the local running sums into sums over the whole source. A source is repeated in
whole epochs while its target allows, and the last epoch is cut at the exact budget.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words_of, stash

#: Rows that a range of a source holds on average.
RANGE_ROWS = 100_000


def source_targets(sizes: DataFrame, weights=(5, 2, 1), cap: int = 3) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with ``target``.

    Sources in code point order, null last, weigh ``weights``, repeating. They share the sum of
    all sizes; no target exceeds ``cap`` times its source's size, and what is cut off is shared
    anew by weight until none exceeds. In closed form: with sources in order of cap over weight,
    those whose cap is at most the level that the rest would get are full, all others get
    level * weight. One row per source passes through the windows, in one task, never one per document:
    fit for millions of sources, of some 50 bytes each.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"))
    a = sizes.withColumn("weight", weight).withColumn("most", (cap * F.col("source_size")).cast("double"))
    up = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    a = a.withColumn("level", (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    a = a.withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    # the sources are full up to the first that is not; levels fall from there on, so its is the largest
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full") | level.isNull(), F.col("most")).otherwise(F.least(F.col("most"), level * F.col("weight")))
    return a.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, seed: str = "mix", weights=(5, 2, 1), cap: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per document: id, size (words), source_size, target and taken (words the mix takes of it).

    taken is epochs * size plus the document's part of the last epoch: all of it before the cut,
    the words up to the cut for the one document that the cut falls into, else nothing. Thus each
    source's taken words are its target, rounded down, and no document exceeds ``cap`` times its
    size. The key is md5 of seed and id, so reruns agree; ties are ordered by id, then size, and
    rows equal in both are interchangeable. Null texts and texts without words have size 0 and are
    taken 0; a null source is a source of its own, the last. An empty table gives no rows.
    """
    key = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 15)
    sized = stash(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words_of(F.col(text_col)).alias("size"), F.conv(key, 16, 10).cast("long").alias("key")), "mix-sizes")
    rows = sized.count()
    bits = min(20, max(0, math.ceil(math.log2(max(1, rows / RANGE_ROWS)))) + 4)
    ranged = sized.withColumn("range", F.shiftright("key", 60 - bits))
    # one shuffled aggregate, one row per source and range
    sums = stash(ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "mix-ranges")
    per_source = Window.partitionBy("source")
    offsets = sums.withColumn("before", F.sum("range_size").over(per_source.orderBy("range")) - F.col("range_size"))
    targets = source_targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, cap)
    offsets = offsets.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    local = Window.partitionBy("source", "range").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    running = ranged.withColumn("upto", F.sum("size").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    o = offsets.select(F.col("source").alias("_s"), F.col("range").alias("_r"), "before", "source_size", "target")
    out = running.join(o, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    start = F.col("before") + F.col("upto") - F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return out.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken"))


def op9_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same in one statement; ``{documents}`` is the table or subquery with the documents.
MIX_SQL = """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 15) as k
  from {documents}),
sources as (
  select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, ([5.0, 2.0, 1.0]::double[])[((row_number() over (order by source is null, encode(source)) - 1) % 3 + 1)::int] as weight,
         (3 * source_size)::double as most, sum(source_size) over ()::double as total from sources),
levels as (
  select *, (total - coalesce(sum(most) over (order by most / weight, source is null, encode(source) rows between unbounded preceding and 1 preceding), 0.0))
            / sum(weight) over (order by most / weight, source is null, encode(source) rows between current row and unbounded following) as level
  from weighed),
judged as (select *, most <= level * weight as is_full from levels),
targets as (
  select source, source_size,
         case when is_full or max(case when not is_full then level end) over () is null then most
              else least(most, max(case when not is_full then level end) over () * weight) end as target
  from judged),
runs as (
  select s.doc_id, s.source, s.size, t.source_size, t.target, floor(t.target)::bigint as budget,
         sum(s.size) over (partition by s.source order by s.k, s.doc_id nulls last, s.size rows between unbounded preceding and current row) - s.size as start
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, {source_column} size, source_size, target,
       (case when source_size > 0 then (budget // source_size) * size
             + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) else 0 end)::bigint as taken
from runs
"""


def op9_sql() -> str:
    return MIX_SQL.format(documents="documents", source_column="")
