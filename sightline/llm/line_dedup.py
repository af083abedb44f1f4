"""Line dedup by a deletion-neighbourhood join, for an edit bound of one character.

Distinct lines within one edit agree on all of q blocks but one, whichever length class (of the
shorter line) the blocks are cut for. Lines that share such a key with no other line have no
neighbour and are set aside: first by the two ends of a line, then, for the rest, with q = 16. The lines left emit
their deletion variants as hashed keys - only inside the block that may differ, as all others are
known to be equal. Equal variants are joined, edit distance is verified, and the earliest is kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import free_name, kept, scratch, slices, stash

#: Lines with fewer characters are not compared by edits, as one edit makes another word of them; see ``exact_short``.
LEAST_CHARS = 20
_ODD_SPACE = re.compile(r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]")
_HALF = 1 << 63
_NO_ENDS = (None, None, None, None)


def normal_line(line: str) -> str:
    """Words of the line with one space between them."""
    return (_ODD_SPACE.sub(" ", line) if _ODD_SPACE.search(line) else line).strip(" ")


def _end_keys(norm: str, n: int) -> tuple[int, int, int | None, int | None]:
    """Hashes of the line's two ends. An end has 8 * (n div 16) characters, at most half; lines whose
    length may be one over a multiple of 16 give the shorter ends too, so that two lines within one
    edit share an end whatever their lengths. The third and fourth are null for most lines."""
    k = n // 16 * 8
    hashed = lambda part, seed: xxhash.xxh3_64_intdigest(part.encode(), seed) - _HALF
    out = hashed(norm[:k], 2 * k), hashed(norm[n - k :], 2 * k + 1)
    if n % 16:
        return *out, None, None
    j = k - 8
    return *out, hashed(norm[:j], 2 * j), hashed(norm[n - j :], 2 * j + 1)


def _lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int, exact_short: bool) -> DataFrame:
    """at, h1, h2 (128 bits of the line's normal form) and end keys of all lines that count; short lines have no end keys."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "version", "line_no", "h1", "h2", "k0", "k1", "k2", "k3"]
    shortest = 1 if exact_short else least_chars

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows, source = [], []
            for text in b.column(2).to_pylist():
                before = len(rows)
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= shortest and (n := len(norm := normal_line(line))) >= shortest:
                        h = xxhash.xxh3_128_intdigest(norm.encode())
                        rows.append((i, (h >> 64) - _HALF, (h & (1 << 64) - 1) - _HALF, *(_end_keys(norm, n) if n >= least_chars else _NO_ENDS)))
                source.append(len(rows) - before)
            same = pa.array(np.repeat(np.arange(len(source)), source))
            cols = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), *(pa.array(c, pa.int64() if k else pa.int32()) for k, c in enumerate(cols))], names=names)

    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))
    found = base.mapInArrow(scan, f"doc_id {id_type}, version long, line_no int, " + ", ".join(f"{n} long" for n in names[3:]))
    return found.select(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "version", "line_no").alias("at"), *names[3:])


def _classes(n: Column) -> Column:
    """The lengths of the shorter line of a pair that a line of n characters can be in."""
    return F.array(n, n - 1)


def _block_keys(norm: Column, n: Column, q: int) -> Column:
    """Structs (m, i, lo, tail, key): for each length class m and block i, what stands around it.

    The block starts after ``lo`` characters, and ``tail`` characters follow it."""

    def of_class(m):
        def of_block(i):
            lo = F.floor(m * i / q).cast("int")
            tail = (m - F.floor(m * (i + 1) / q)).cast("int")
            key = F.xxhash64(m, i, F.substring(norm, F.lit(1), lo), F.when(tail > 0, F.substring(norm, n - tail + 1, tail)).otherwise(F.lit("")))
            return F.struct(m.alias("m"), i.alias("i"), lo.alias("lo"), tail.alias("tail"), key.alias("key"))

        return F.transform(F.sequence(F.lit(0), F.lit(q - 1)), of_block)

    return F.flatten(F.transform(_classes(n), of_class))


def _packed(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the text compressed, and _version: texts cross the shuffles at a third of their size."""
    names = [*docs.columns, "_version"]
    at = names.index(text_col)
    fields = [StructField(f.name, BinaryType() if f.name == text_col else f.dataType) for f in docs.schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches):
            texts = pa.array([None if t is None else z(t.encode()) for t in b.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(b.columns)], names=names)

    version = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.withColumn("_version", version).mapInArrow(pack, StructType([*fields, StructField("_version", LongType())]))


def _asked_lines(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """at, n, norm, h1, h2 of the lines that ``asked`` lists (doc_id, version, asked), once each."""
    id_type = docs.schema[id_col].dataType.simpleString()
    wanted = asked.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "asked")
    packed = _packed(docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text")), "_text")
    joined = packed.join(wanted, F.col("_key").eqNullSafe(F.col("_d")) & (F.col("_version") == F.col("_v"))).select("_key", "_version", "_text", "asked")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            rows, source = [], []
            for i, (data, lines) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                text = unpack(data).decode().split("\n")
                for x in lines:
                    rows.append((x["line_no"], normal_line(text[x["line_no"]]), x["h1"], x["h2"]))
                source += [i] * len(lines)
            same = pa.array(source, pa.int64())
            kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["doc_id", "version", "line_no", "norm", "h1", "h2"])

    found = joined.mapInArrow(pick, f"doc_id {id_type}, version long, line_no int, norm string, h1 long, h2 long")
    at = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "version", "line_no").alias("at")
    return found.select(at, F.char_length("norm").alias("n"), "norm", "h1", "h2").dropDuplicates(["h1", "h2"])


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, exact_short: bool = False) -> DataFrame:
    """(doc_id, version, line_no) of the lines to drop. version is a hash of the text, so that rows that
    repeat an id with another text are told apart; rows equal in both share their result.

    A line is dropped if an equal or one-edit line (insertion, deletion or substitution of one
    character, in normal form) stands earlier, in the order of doc_id (null last), version and line
    number, whether or not that earlier line is itself dropped. Lines below ``least_chars`` are left
    alone, or with ``exact_short`` dropped if an equal line stands earlier.
    """
    occurrences = stash(_lines(docs, id_col, text_col, least_chars, exact_short), "lines")
    names = ["k0", "k1", "k2", "k3"]
    distinct = stash(occurrences.groupBy("h1", "h2").agg(F.min("at").alias("first"), F.count("*").alias("times"), *[F.first(k).alias(k) for k in names]), "distinct-lines")

    # lines that share an end with another distinct line; 64 bits name a line here, as this only sets others aside
    halves = distinct.select("h1", F.explode(F.array_compact(F.array(*names))).alias("key"))
    # (written, so that the join has a plain exchange on both sides and a hot key can be split)
    twice = stash(halves.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "twice")
    some = halves.join(twice, "key", "left_semi").select("h1").distinct()
    maybe = distinct.select("h1", "h2", "first").join(some, "h1", "left_semi")
    # their texts, at their first place
    asked = maybe.groupBy("first.doc_id", "first.version").agg(F.collect_list(F.struct("first.line_no", "h1", "h2")).alias("asked"))
    texts = stash(_asked_lines(docs, asked, id_col, text_col), "maybe-texts")
    # lines that share all blocks but one
    fine = texts.select("h1", "h2", "at", "n", "norm", F.explode(_block_keys(F.col("norm"), F.col("n"), 16)).alias("b"))
    fine_keys = texts.select(F.explode(F.transform(_block_keys(F.col("norm"), F.col("n"), 16), lambda b: b["key"])).alias("key"))
    again = fine_keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    fine = fine.select("h1", "h2", "at", "n", F.col("b.m").alias("m"), F.col("b.key").alias("key"), F.expr("substring(norm, b.lo + 1, n - b.lo - b.tail)").alias("middle")).join(again, "key", "left_semi")

    # deletion variants inside the block: a line of the class's length meets others of that length
    # where one character at one place is left out, and longer lines with one character left out where it is whole
    size = F.char_length("middle")
    spots = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    without = lambda j: F.concat(F.substring(F.col("middle"), F.lit(1), j - 1), F.substring(F.col("middle"), j + 1, size))
    variant = lambda j, kind, s: F.struct(kind.alias("kind"), F.xxhash64("key", s, j).alias("v"))
    same_length = F.concat(
        F.transform(spots, lambda j: variant(j, F.lit(0), without(j))),
        F.array(variant(F.lit(0), F.lit(1), F.col("middle"))),
    )
    longer = F.array_distinct(F.transform(spots, lambda j: variant(F.lit(0), F.lit(2), without(j))))
    emitted = fine.select("h1", "h2", "at", F.explode(F.when(F.col("n") == F.col("m"), same_length).otherwise(longer)).alias("e")).select("h1", "h2", "at", F.col("e.kind").alias("kind"), F.col("e.v").alias("v"))
    emitted = stash(emitted, "variants")
    # the earliest of each kind under each variant; kind 0 meets 0, 1 meets 2
    low = emitted.groupBy("v").agg(*[F.min(F.when(F.col("kind") == k, F.struct("at", "h1", "h2"))).alias(f"low{k}") for k in range(3)], F.count("*").alias("c")).where("c > 1").drop("c")
    met = emitted.join(low, "v").withColumn("other", F.when(F.col("kind") == 0, F.col("low0")).when(F.col("kind") == 1, F.col("low2")).otherwise(F.col("low1")))
    pairs = met.where(F.col("other").isNotNull() & (F.col("other.at") < F.col("at"))).groupBy("h1", "h2", "at").agg(F.min("other").alias("other"))
    pairs = pairs.select("h1", "h2", "at", F.col("other.at").alias("other"))
    # verify on the texts
    a = texts.select(F.col("at").alias("_a"), F.col("norm").alias("norm_a"))
    b = texts.select(F.col("at").alias("_b"), F.col("norm").alias("norm_b"))
    sure = pairs.join(a, F.col("at") == F.col("_a")).join(b, F.col("other") == F.col("_b")).where(F.levenshtein("norm_a", "norm_b", 1).between(0, 1))
    near = stash(sure.select("h1", "h2", F.lit(True).alias("near")), "near-lines")

    fate = stash(distinct.select("h1", "h2", "first", "times").join(near, ["h1", "h2"], "left").where("times > 1 or near").drop("times"), "line-fates")
    out = occurrences.select("at", "h1", "h2").join(fate, ["h1", "h2"]).where((F.col("at") != F.col("first")) | F.col("near"))
    return out.select("at.doc_id", "at.version", "at.line_no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, exact_short: bool = False) -> DataFrame:
    """``docs`` with dropped lines cut out of the text, and n_lines and n_dropped in new columns.

    A null text stays null, with 0 lines; other texts keep their remaining lines as they are, and
    lines without words, and without ``exact_short`` those below ``least_chars``, are never dropped. No row is lost.
    """
    with scratch():
        gone = kept(stash(dropped_lines(docs, id_col, text_col, least_chars, exact_short).groupBy("doc_id", "version").agg(F.collect_set("line_no").alias("_gone")), "dropped-lines"))
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "_gone")
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    # other columns travel in one struct, so that no name of theirs can clash with those used here
    others = [c for c in docs.columns if c != text_col]
    held = docs.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in others]).alias("_held"), F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    joined = _packed(held, "_text").join(gone, F.col("_key").eqNullSafe(F.col("_d")) & (F.col("_version") == F.col("_v")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in slices(batches):
            texts, lines, dropped = [], [], []
            for data, drop in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                text = None if data is None else unpack(data).decode()
                parts = [] if text is None else text.split("\n")
                if drop:
                    out = set(drop)
                    text = "\n".join(x for i, x in enumerate(parts) if i not in out)
                texts.append(text), lines.append(len(parts)), dropped.append(len(drop or ()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=["_held", "_text", "_lines", "_dropped"])

    schema = StructType([StructField("_held", held.schema["_held"].dataType), StructField("_text", StringType()), StructField("_lines", LongType()), StructField("_dropped", LongType())])
    out = joined.select("_held", "_text", "_gone").mapInArrow(cut, schema)
    return out.select(*[F.col("_text").alias(c) if c == text_col else F.col("_held").getField(c).alias(c) for c in docs.columns], F.col("_lines").alias(n_lines), F.col("_dropped").alias(n_dropped))


def op8_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs, exact_short=True)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
