"""The engine's functions for use in SQL text: temporary functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_CHARS = "filter(split({s}, ''), c -> c <> '')"
_SUB = "aggregate(" + _CHARS.format(s="{long}") + ", 0, (i, c) -> if(substr({short}, i + 1, 1) = c, i + 1, i)) = length({short})"

FUNCTIONS = {
    "bib_compatible(a STRING, b STRING) RETURNS BOOLEAN": f"""coalesce(case
        when length(a) = 0 or length(b) = 0 then false
        when a = b then true
        when length(a) = length(b) and length(a) >= 2 then size(filter(sequence(1, length(a)), i -> substr(a, i, 1) <> substr(b, i, 1))) = 1
        when length(a) < length(b) and length(a) >= 2 then {_SUB.format(long='b', short='a')}
        when length(a) > length(b) and length(b) >= 2 then {_SUB.format(long='a', short='b')}
        else false end, false)""",
    "bib_occluded(a STRING, b STRING) RETURNS BOOLEAN": """coalesce(case
        when length(a) = 0 or length(b) = 0 then false
        when a = b then true
        when least(length(a), length(b)) >= 2 and abs(length(a) - length(b)) <= 2 then contains(a, b) or contains(b, a)
        else false end, false)""",
    "cosine_similarity(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": """coalesce(
        aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)
        / nullif(sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0D, (s, x) -> s + x * x)), 0D), 0D)""",
    "seconds_of_day(t TIMESTAMP_NTZ) RETURNS DOUBLE": "hour(t) * 3600D + minute(t) * 60D + cast(extract(SECOND FROM t) AS DOUBLE)",
    "digit_run(t STRING) RETURNS STRING": "nullif(aggregate(regexp_extract_all(coalesce(t, ''), '([0-9]+)', 1), '', (b, r) -> if(length(r) > length(b), r, b)), '')",
}


def register(spark: SparkSession) -> None:
    """Make FUNCTIONS known to the session, and ``blocking_keys(bib, side)`` as a table function."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")

    @F.udtf(returnType="key string")
    class BlockingKeys:
        def eval(self, bib: str, side: str):
            for key in keys_of(bib, side):
                yield (key,)

    spark.udtf.register("blocking_keys", BlockingKeys)


def keys_of(bib: str | None, side: str) -> set[str]:
    """Keys of which compatible identifiers share one, for single values: as functions.bibs.blocking_keys
    gives them for identifiers of up to its bound of characters."""
    if not bib:
        return set()
    other, n = ("right", len(bib)) if side == "left" else ("left", len(bib))
    keys = {"=" + bib}
    if n >= 2:
        keys |= {f"*{bib[:i]}*{bib[i + 1:]}" for i in range(n)} | {f"{other}s{bib}"}
        shorter = {""}
        for c in bib:
            shorter |= {x + c for x in shorter}
        keys |= {f"{side}s{x}" for x in shorter if 2 <= len(x) < n}
    return keys
