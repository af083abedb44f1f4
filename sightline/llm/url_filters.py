"""URL filters by expression digests, DataFrame functions only.

A URL is expanded into all pairs of a host suffix and a path prefix. Each expression's SHA-256 is
joined to the rules' on a short prefix, and then confirmed on the full digest. Of the rules that
fit, the longest wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

#: Rules beyond this number, or of more characters than RULE_CHARS each on average, are joined by a shuffle, not broadcast.
BROADCAST_RULES, RULE_CHARS = 100_000, 200
#: Hexadecimal digits of a digest that expressions and rules are joined on.
SHORT = 8


def split_url(url):
    """(host, path) columns: the host after the first ``://`` up to ``/ ? #``, A-Z lower-cased; the
    path from there to ``?`` or ``#``. Both empty for null and without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    rules: host, path, verdict. A rule fits its host and all subdomains if the URL's path starts
    with its path. The longest (host and path together, then host) wins; of equal rules with
    unlike verdicts, ``block``. URLs that no rule fits get a null rule and ``default``. Null URLs
    and URLs without ``://`` have an empty host and path, which no rule with a host fits. Repeated
    rows are judged each; columns named host, path, rule or verdict are replaced.

    Expressions meet the rules on the first 8 digits of their digests alone; a pair counts as a hit
    if the whole digests are equal. A row is expanded and folded again within its partition (a
    partial aggregate), so one row per page is shuffled, by a row number, not by host: a hot host
    does not gather in a task. All columns of ``pages`` travel with it: select those that are needed.
    """
    held = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    ranked = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    ranked = ranked.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    # a rule's place: the larger struct wins
    place = F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("of_host"), F.concat("host", "path").alias("rule"), "verdict")
    ranked = stash(ranked.select(place.alias("place"), F.length("path").alias("of_path"), _digest(F.col("host"), F.col("path")).alias("digest")), "url-rules")
    count, length = ranked.agg(F.count("*"), F.coalesce(F.sum(F.length("place.rule")), F.lit(0))).first()
    small = count <= broadcast_rules and length <= RULE_CHARS * broadcast_rules
    lengths = [r[0] for r in ranked.select("of_path").distinct().orderBy("of_path").collect()]  # at most one for each path length
    side = ranked.select(F.substring("digest", 1, SHORT).alias("_short"), F.col("digest").alias("_full"), "place")
    side = F.broadcast(side) if small else side

    # the page's columns travel in one struct, so that no name of theirs can clash with those used here
    base = pages.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in held]).alias("_held"), F.col(url_col).alias("_url"))
    host, path = split_url(F.col("_url"))
    base = base.withColumns({"_host": host, "_path": path, "_row": F.monotonically_increasing_id()}).drop("_url")
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_path")), lambda n: F.substring(F.col("_path"), F.lit(1), n)))
    e = base.withColumn("_suffix", F.explode(suffixes)).withColumn("_prefix", F.explode_outer(prefixes))
    e = e.withColumn("_digest", _digest(F.col("_suffix"), F.col("_prefix"))).drop("_suffix", "_prefix").withColumn("_start", F.substring("_digest", 1, SHORT))
    met = e.join(side, F.col("_start") == F.col("_short"), "left")
    sure = F.when(F.col("_digest") == F.col("_full"), F.col("place"))
    best = met.groupBy("_row", "_held", "_host", "_path").agg(F.max(sure).alias("_best"))
    return best.select(*[F.col("_held").getField(c).alias(c) for c in held], F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


#: The contract's rules.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op6_query(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_sql() -> str:
    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
with parts as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
hosts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
rules(rule_host, rule_path, verdict) as (values {values}),
best as (
  select h.page_id, max(struct_pack(n := length(rule_host) + length(rule_path), rule := rule_host || rule_path, verdict := r.verdict)) as b
  from hosts h join rules r on (h.host = rule_host or ends_with(h.host, '.' || rule_host)) and starts_with(h.path, rule_path)
  group by h.page_id)
select h.page_id, h.host, h.path, b.rule as rule, coalesce(b.verdict, 'allow') as verdict
from hosts h left join best on h.page_id = best.page_id
"""
