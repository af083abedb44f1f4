"""Quality rules as a short-circuit cascade, DataFrame functions only.

Each rule's cost and selectivity are estimated on a sample; the rules are then chained in one
CASE expression by rejections per second, so a row that one rule rejects is not measured by the
next. The verdict is a conjunction and does not depend on the order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, free_name, let, n_words_of, stash, words_of

#: Rows of the sample, on average.
SAMPLE_ROWS = 400
#: Runs of each rule over the sample.
TIMES = 3


def word_chars(text: Column) -> Column:
    """Code points in words."""
    text = F.coalesce(text, F.lit(""))
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, WORD, ""))).cast("long")


def n_symbols(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^#*$%&|<>]+", "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(worded_lines(text), lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("long")


def n_repeat_words(text: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text, the first included.

    Windows are compared by a 64-bit hash within one text. Repeated windows come from sorting
    (hash, position) pairs, so very long and very repetitive texts cost n log n, not n squared.
    """

    def grams(w):
        return F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))

    def starts(g):
        pairs = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(pairs, lambda a: F.filter(a, lambda x, i: (x["h"] == F.get(a, i - 1)["h"]) | (x["h"] == F.get(a, i + 1)["h"])))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def covered(p):
        parts = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def of(g):
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint")).otherwise(let(starts(g), covered))

    return let(words_of(text), lambda w: let(grams(w), of))


def n_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.size(worded_lines(text)).cast("long")


def n_upper(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{Lu}]+", "")).cast("long")


def n_letters(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]+", "")).cast("long")


MEASURES = {"n_words": n_words_of, "word_chars": word_chars, "n_symbols": n_symbols, "n_lines": n_lines, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words, "n_upper": n_upper, "n_letters": n_letters}


class Measures:
    """The measures of a text by name: each an expression over the text, or, of those in ``known``,
    the column that holds it already."""

    def __init__(self, text: Column, known: tuple[str, ...] = ()):
        self.text, self.known = text, known

    def __getattr__(self, name: str) -> Column:
        return F.col(name) if name in self.known else MEASURES[name](self.text)


@dataclass(frozen=True)
class Rule:
    """``rejects(measures)``: a Boolean column, never null."""

    name: str
    rejects: Callable[[Measures], Column]


#: The base of the contract, and the rules of this engine. Each is a share of the text, so texts of any length are judged alike.
RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words),
    Rule("upper_case", lambda m: 100 * m.n_upper > 30 * m.n_letters),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 40 * m.n_lines),
    Rule("word_length", lambda m: (m.word_chars > 15 * m.n_words) | (m.word_chars < 2 * m.n_words)),
)


def estimate(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """(rule, seconds a row, rejected share) of each rule, measured on a Bernoulli sample.

    The sample is drawn where the rows are, and only its rows are gathered and written. A rule's
    time is the least of TIMES runs, less that of a scan that measures nothing."""
    rows = docs.count()
    sample = stash(docs.select(F.col(text_col).alias("t")).sample(min(1.0, sample_rows / max(1, rows)), seed).repartition(1), "quality-sample")
    n = max(1, sample.count())

    def timed(what: Column) -> tuple[float, int]:
        times, hit = [], 0
        for _ in range(TIMES):
            began = time.perf_counter()
            hit = sample.agg(F.count_if(what)).first()[0]
            times.append(time.perf_counter() - began)
        return min(times), hit

    floor = timed(F.length("t") > 0)[0]
    out = []
    for rule in rules:
        seconds, hit = timed(rule.rejects(Measures(F.col("t"))))
        out.append((rule, max(seconds - floor, 1e-4) / n, hit / n))
    return out


def cascade(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, known: tuple[str, ...] = ()) -> tuple[Column, list[str]]:
    """The verdict column (true: kept) with the rules in the order of rejections per cost, and that
    order. known: measures that the rows will carry as columns, so that they are not taken twice."""
    ranked = sorted(estimate(docs, rules, text_col, sample_rows), key=lambda x: (-(x[2] / x[1]), x[1]))
    verdict = F.lit(True)
    for rule, _, _ in reversed(ranked):
        verdict = F.when(rule.rejects(Measures(F.col(text_col), known)), F.lit(False)).otherwise(verdict)
    return verdict, [r.name for r, _, _ in ranked]


def judge_quality(docs: DataFrame, rules=RULES, text_col: str = "text", kept_col: str = "kept") -> DataFrame:
    """``docs`` with ``kept``. A null or blank text has no words and is rejected by few_words; equal
    texts get equal verdicts; other columns stay. A column of that name gets underscores in front."""
    verdict, _ = cascade(docs, rules, text_col)
    return docs.withColumn(free_name(docs, kept_col), verdict)


def op2_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    asked = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    verdict, _ = cascade(docs, known=asked)
    measured = docs.withColumns({m: MEASURES[m](F.col("text")) for m in asked})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.select("doc_id", *asked, failed.alias("base_failed"), (verdict & ~failed).alias("kept"))


#: The measures and verdicts in one statement; ``{documents}`` is the table with the documents.
QUALITY_SQL = """
with w as (
  select doc_id, text, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines, {columns}
         row_number() over () as rid from {documents}),
grams as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from w)),
again as (
  select rid, i from grams join (select rid, g from grams group by rid, g having count(*) > 1) using (rid, g)),
covered as (
  select rid, count(distinct i + k) as n from again cross join (values (0), (1), (2)) s(k) group by rid),
m as (
  select w.*, len(words)::bigint as n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words,
         length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) as n_upper, length(regexp_replace(t, '[^\\p{{L}}]', '', 'g')) as n_letters
  from w left join covered c using (rid)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         not (n_words < 50 or 100 * n_repeat_words > 30 * n_words or 10 * n_symbols > 3 * n_words or 100 * n_upper > 30 * n_letters
              or 100 * n_dup_lines > 40 * len(lines) or word_chars > 15 * n_words or word_chars < 2 * n_words) as kept
  from m)
"""


def op2_sql() -> str:
    return QUALITY_SQL.format(documents="documents", columns="") + "select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept from judged"
