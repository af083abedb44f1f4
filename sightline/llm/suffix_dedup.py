"""Repeated-substring removal through suffix order and a Burrows-Wheeler transform.

Part 1, anchors: of each window of ``length`` bytes, the smallest hashed 32-byte gram (the leftmost
on ties) is its anchor. Equal windows have equal anchors at equal places, so a window can only
repeat if its anchor's gram does. Part 2, contexts: the bytes of all windows that a repeated anchor
stands for. Part 3: contexts are dealt out by the anchor's gram, and in blocks of bounded size
their suffixes are sorted to the depth of a window, the Burrows-Wheeler transform is taken, and
intervals are extended backwards breadth-first, which derives common prefixes by increasing value
and stops at ``length``: suffixes whose common prefix is still open then start a repeated window.
Equal contexts are represented by one of them, and repeat by that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, scratch, slices, stash
from .near_dup import _mix

GRAM = 32


def grams(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the 32 bytes from each position."""
    n = len(b) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = np.lib.stride_tricks.as_strided(b[: len(b)], shape=(len(b) - 7, 8), strides=(1, 1))
    words = np.ascontiguousarray(wide).view(np.uint64).ravel()
    with np.errstate(over="ignore"):
        acc = words[:n] * np.uint64(0x9E3779B97F4A7C15)
        for k, p in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0x27D4EB2F165667C5)):
            acc ^= acc >> np.uint64(31)
            acc += words[k : k + n]
            acc *= np.uint64(p)
        return _mix(acc)


def anchors(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start, gram hash): each run of window starts and its anchor."""
    if len(b) < length:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    h = grams(b)
    width, starts = length - GRAM + 1, len(b) - length + 1
    out = []
    step = 1 << 22
    for at in range(0, starts, step):
        count = min(step, starts - at)
        part = h[at : at + count + width - 1]
        key = (part >> np.uint64(24) << np.uint64(24)) | np.arange(len(part), dtype=np.uint64)
        pad = -len(key) % width
        rows = np.concatenate([key, np.full(pad, np.uint64(2**64 - 1))]).reshape(-1, width)
        ahead = np.minimum.accumulate(rows, 1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
        low = np.minimum(back[:count], ahead[width - 1 : width - 1 + count])
        pos = (low & np.uint64(0xFFFFFF)).astype(np.int64) + at
        new = np.flatnonzero(np.diff(pos, prepend=-1))
        out.append((pos[new], new + at, np.append(new[1:], count) - 1 + at))
    a, first, last = (np.concatenate(x) for x in zip(*out, strict=True))
    return a, first, last, h[a]


#: Cells that the places of an anchor in a window are split into.
CELLS = 4
#: Bytes of contexts that are sorted together, about, and the most that one anchor's contexts may
#: have there; beyond it the anchor's windows are counted by digest instead.
BLOCK_BYTES, MOST_BYTES = 3 << 20, 6 << 20
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 17)
        _powers[:] = []
        with np.errstate(over="ignore"):
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                p = np.full(size, np.uint64(base & (2**64 - 1)))
                p[0] = 1
                _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


#: Window starts of a text that are looked at together; bounds memory for very long texts.
CHUNK = 1 << 21


def cells(b: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(gram hash, cell hash, first start, last start, anchor) for each anchor and each cell of its places.

    All windows of a cell share the bytes that the cell hash covers, at least ``length`` less a
    cell's width; windows that are equal lie in equal cells with equal hashes."""
    if len(b) < CHUNK + length:
        return _cells(b, length)
    parts = [(at, _cells(b[at : at + CHUNK + length - 1], length)) for at in range(0, len(b) - length + 1, CHUNK)]
    return tuple(np.concatenate([x[k] + at if k > 1 else x[k] for at, x in parts]) for k in range(5))


def _cells(b: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    a, first, last, h = anchors(b, length)
    if not len(a):
        return h, h, a, a, a
    power, inverse = _power_tables(len(b) + 1)
    with np.errstate(over="ignore"):
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)], dtype=np.uint64)])
        width = (length - GRAM) // CELLS
        out = []
        for j in range(CELLS):
            low, high = j * width, (j + 1) * width - 1 if j < CELLS - 1 else length - GRAM
            s0, s1 = np.maximum(first, a - high), np.minimum(last, a - low)
            on = s0 <= s1
            x, y = (a - low)[on], (a - high + length)[on]
            key = _mix((prefix[y] - prefix[x]) * inverse[x] + np.uint64(j))
            out.append((h[on], key, s0[on], s1[on], a[on]))
    parts = [np.concatenate(x) for x in zip(*out, strict=True)]
    order = np.argsort(parts[2], kind="stable")
    return tuple(x[order] for x in parts)


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their first ``depth`` symbols or more; symbols below 2^16, the last one unique."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(3, text.dtype)]).astype(np.uint64)
    key = (padded[:n] << np.uint64(48)) | (padded[1 : n + 1] << np.uint64(32)) | (padded[2 : n + 2] << np.uint64(16)) | padded[3 : n + 3]
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    head = np.empty(n, bool)
    head[0] = True
    np.not_equal(key[1:], key[:-1], out=head[1:])
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    h = 4
    place = sa
    while True:
        # the rank of a group is the slot of its first member
        starts = np.flatnonzero(head)
        sizes = np.diff(np.append(starts, len(slots)))
        rank[place] = np.repeat(slots[starts], sizes)
        several = np.repeat(sizes > 1, sizes)
        slots = slots[several]
        if h >= depth or not len(slots):
            return sa
        place = sa[slots]
        key = rank[place] * n + rank[np.minimum(place + h, n - 1)]
        order = np.argsort(key)
        place = place[order]
        sa[slots] = place
        key = key[order]
        head = np.empty(len(slots), bool)
        head[0] = True
        np.not_equal(key[1:], key[:-1], out=head[1:])
        h *= 2


def open_prefixes(text: np.ndarray, sa: np.ndarray, first_letter: int, length: int) -> np.ndarray:
    """For each slot of the suffix order whether its common prefix with the slot before has ``length``
    symbols or more, from the Burrows-Wheeler transform alone.

    Symbols below ``first_letter`` are separators, each unique. Intervals of equal prefixes are
    extended by one symbol to the left, all of one prefix length at a time; an interval's end closes
    a slot, with that length as its common prefix, if the slot is still open, and only then is it
    extended further. What is open after ``length`` rounds shares ``length`` symbols.
    """
    n = len(text)
    bwt = text[sa - 1]  # the text is a circle
    order = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[order] = np.arange(n)
    letter = bwt >= first_letter
    opened = np.ones(n + 1, bool)
    opened[0] = opened[n] = False
    # intervals of one symbol, separators too; extensions are by letters only
    values, lo = np.unique(text[sa], return_index=True)
    hi = np.append(lo[1:], n)
    opened[hi] = False
    symbols = values[values >= first_letter]
    sorted_bwt = bwt[order]
    places = [order[np.searchsorted(sorted_bwt, v) : np.searchsorted(sorted_bwt, v, "right")] for v in symbols]
    for _ in range(1, length):
        if not len(lo):
            break
        size = hi - lo
        new_lo, new_hi = [], []
        one = lo[size == 1]
        one = lf[one[letter[one]]]
        new_lo.append(one)
        new_hi.append(one + 1)
        big = size > 48
        if big.any():  # by rank of each symbol at both ends
            for v, place in enumerate(places):
                i, j = np.searchsorted(place, lo[big]), np.searchsorted(place, hi[big])
                some = i < j
                i, j = i[some], j[some]
                new_lo.append(lf[place[i]])
                new_hi.append(lf[place[j - 1]] + 1)
        few = (size > 1) & ~big
        if few.any():  # by sorting the members' places after the step: one run a symbol
            l, s = lo[few], size[few]
            ends = np.cumsum(s)
            member = np.arange(ends[-1]) - np.repeat(ends - s - l, s)
            group = np.repeat(np.arange(len(l)), s)
            good = letter[member]
            member, group = member[good], group[good]
            key = np.sort(group * n + lf[member])
            to, group = key % n, key // n
            symbol = text[sa[to]]
            cut = np.ones(len(key), bool)
            cut[1:] = (group[1:] != group[:-1]) | (symbol[1:] != symbol[:-1])
            begins, last = np.flatnonzero(cut), np.flatnonzero(np.append(cut[1:], len(key) > 0)[: len(key)])
            new_lo.append(to[begins])
            new_hi.append(to[last] + 1)
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        live = opened[hi]
        lo, hi = lo[live], hi[live]
        opened[hi] = False
    return opened[:n]


def repeated_starts(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """For each context, whether the window at each start is found at another start of any context."""
    if len(contexts) > 60_000:  # separators and letters must fit in 16 bits
        raise ValueError("too many contexts in a block")
    out: list[np.ndarray] = []
    m = len(contexts)
    parts = []
    for i, c in enumerate(contexts):
        parts += [np.frombuffer(c, np.uint8).astype(np.uint32) + m, np.array([i], np.uint32)]
    text = np.concatenate(parts)
    sa = sort_suffixes(text, length)
    same = open_prefixes(text, sa, m, length)
    hit = np.zeros(len(text) + 1, bool)
    hit[sa[same]] = True
    hit[sa[np.flatnonzero(same) - 1]] = True
    at = 0
    for c in contexts:
        out.append(hit[at : at + max(0, len(c) - length + 1)])
        at += len(c) + 1
    return out


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs [from, to) of the union."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


RANGES = "array<struct<a: long, b: long>>"


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, spans): for documents that hold a repeated string of ``length`` bytes, the
    spans [a, b) of bytes that such strings cover, as a list that may overlap.

    version is a hash of the text. A repeated row is a repetition of all its text. Null texts are
    empty. Every join is on a document or on a context's digest: hot contexts are on the split side
    of a skewed join, and counts are combined before the shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), text.cast("binary").alias("bytes")).where(F.octet_length("bytes") >= length)
    id_type = docs.schema[id_col].dataType.simpleString()

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "version", "gram", "cell", "s0", "s1", "anchor"]
        for b in slices(batches):
            found = [cells(np.frombuffer(data, np.uint8), length) for data in b.column(2).to_pylist()]
            if not found:
                continue
            rows = pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for x in found]))
            h, key, s0, s1, at = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(h.view(np.int64)), pa.array(key.view(np.int64)), pa.array(s0), pa.array(s1), pa.array(at)], names=names)

    found = stash(base.mapInArrow(to_cells, f"doc_id {id_type}, version long, gram long, cell long, s0 long, s1 long, anchor long"), "cells")
    # written, so that the join below has a plain exchange on both sides and a hot cell can be split
    twice = stash(found.groupBy("cell").agg(F.count("*").alias("c")).where("c > 1").select("cell"), "twice")
    asked = found.join(twice, "cell", "left_semi").groupBy("doc_id", "version").agg(F.array_sort(F.collect_set(F.struct("s0", "s1", "gram", "anchor"))).alias("asked"))
    asked = asked.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "asked")

    def to_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        names = ["doc_id", "version", "gram", "start", "c1", "c2", "context"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for b in slices(batches):
            lists, rows, source = b.column(3), [], []
            edges, flat = lists.offsets.to_numpy(), lists.values
            first, last, gram, anchor = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            for i, data in enumerate(b.column(2).to_pylist()):
                x, y = edges[i], edges[i + 1]
                # cells of one anchor that follow each other are one context
                new = np.ones(y - x, bool)
                new[1:] = (anchor[x + 1 : y] != anchor[x : y - 1]) | (first[x + 1 : y] != last[x : y - 1] + 1)
                begin = np.flatnonzero(new) + x
                end = np.append(begin[1:], y) - 1
                for s0, s1, g in zip(first[begin].tolist(), last[end].tolist(), gram[begin].tolist(), strict=True):
                    context = data[s0 : s1 + length]
                    d = hashlib.blake2b(context, digest_size=16).digest()
                    fresh = d not in seen  # sent once a task
                    if fresh:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(d)
                    rows.append((g, s0, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), context if fresh else None))
                source.append(len(begin))
            same = pa.array(np.repeat(np.arange(len(source)), source))
            yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=names)

    joined = base.join(asked, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("version") == F.col("_v"))).select("doc_id", "version", "bytes", "asked")
    contexts = stash(joined.mapInArrow(to_contexts, f"doc_id {id_type}, version long, gram long, start long, c1 long, c2 long, context binary"), "contexts")
    places = contexts.select("doc_id", "version", "start", "c1", "c2")

    # contexts of anchors that have several different ones; a hot anchor's go the other way
    kinds = contexts.groupBy("gram", "c1", "c2").agg(F.count("*").alias("n"), F.max(F.octet_length("context")).alias("size"))
    kinds = stash(kinds, "context-kinds")
    grouped = kinds.groupBy("gram").agg(F.count("*").alias("k"), F.sum("size").alias("total")).where("k > 1")
    grouped = stash(grouped.select("gram", (F.col("total") > MOST_BYTES).alias("hot")), "anchors")
    various = contexts.where("context is not null").select("gram", "c1", "c2", "context").join(grouped, "gram")
    schema = f"c1 long, c2 long, hits {RANGES}"

    def by_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], bytes] = {}
        size, last = 0, None

        def close():
            hits = repeated_starts(list(held.values()), length)
            rows = [(k, r) for k, h in zip(held, hits, strict=True) if (r := _ranges(h))]
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k, _ in rows], pa.int64()), pa.array([k[1] for k, _ in rows], pa.int64()), pa.array([[{"a": a, "b": z} for a, z in r] for _, r in rows], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["c1", "c2", "hits"])

        for b in slices(batches):
            for gram, c1, c2, context in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if gram != last and size >= BLOCK_BYTES:
                    yield close()
                    held, size = {}, 0
                last = gram
                if (c1, c2) not in held:
                    held[c1, c2] = context
                    size += len(context)
        if held:
            yield close()

    # (by the gram's hash: on the gram alone the shuffle is left out after the join on it, and a gram may come to several tasks)
    dealt = various.where("not hot").select("gram", "c1", "c2", "context").repartition(F.xxhash64("gram")).sortWithinPartitions("gram")
    hits = dealt.mapInArrow(by_blocks, schema)
    hits = hits.unionByName(_by_digest(various.where("hot").select("c1", "c2", "context").dropDuplicates(["c1", "c2"]), length, schema))
    hits = stash(hits, "hits")

    several = kinds.select("c1", "c2", (F.col("n") > 1).alias("whole"), "size")
    known = several.join(hits, ["c1", "c2"], "left").where("whole or hits is not null")
    spans = F.when(F.col("whole"), F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").cast("long").alias("b")))).otherwise(F.transform("hits", lambda x: F.struct(x["a"].alias("a"), (x["b"] + length).alias("b"))))
    known = stash(known.select("c1", "c2", spans.alias("spans")), "known-contexts")
    covered = places.join(known, ["c1", "c2"]).select("doc_id", "version", F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b"))).alias("spans"))
    return covered.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _by_digest(contexts: DataFrame, length: int, schema: str) -> DataFrame:
    """The exact way for hot anchors: their contexts' windows by 128-bit digest, counted in a
    combined aggregate; the windows of a digest that occurs twice are hits."""

    def to_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in slices(batches):
            for c1, c2, context in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(context) - length + 1
                view = memoryview(context)
                d = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[i : i + length]) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c1)), pa.array(np.full(n, c2)), pa.array(np.arange(n)), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())], names=["c1", "c2", "s", "w1", "w2"])

    w = contexts.mapInArrow(to_windows, "c1 long, c2 long, s long, w1 long, w2 long")
    twice = w.groupBy("w1", "w2").agg(F.count("*").alias("c")).where("c > 1").select("w1", "w2")
    hit = w.join(twice, ["w1", "w2"], "left_semi").groupBy("c1", "c2").agg(F.collect_list(F.struct(F.col("s").alias("a"), F.col("s").alias("b"))).alias("hits"))
    return hit.select("c1", "c2", F.col("hits").cast(RANGES).alias("hits"))


def cut_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept (the
    remaining bytes): every byte that a string of ``length`` bytes covers that also starts anywhere
    else goes, judged on the input. Texts below ``length`` bytes and null texts lose nothing."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    with scratch():
        spans = kept(stash(repeated_spans(docs, length, id_col, text_col), "spans"))
    spans = spans.select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "spans")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("version"), text.cast("binary").alias("bytes"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("version") == F.col("_v")), "left").select("doc_id", "bytes", "spans")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for data, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                runs = merged([(x["a"], x["b"]) for x in found or []])
                parts, at = [], 0
                for x, y in runs:
                    parts.append(data[at:x])
                    at = y
                rest = b"".join([*parts, data[at:]]) if runs else data
                rows.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest if keep_bytes else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_query(spark, sf_dir) -> DataFrame:
    """The contract's columns, and ``repeated``: whether anything was removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return cut_repeats(docs, 400, keep_bytes=False).drop("kept").withColumn("repeated", F.col("n_removed") > 0)


def op4_sql() -> str:
    """All windows of 400 bytes by hash, and the runs that the repeated ones cover; texts as hexadecimal digits."""
    return r"""
with d as (select row_number() over () as rid, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
p as (select rid, j, substr(h, 2 * j + 1, 1822) as part from (select rid, h, unnest(range(0, length(h) // 2 - 399, 512)) as j from d)),
w as (select rid, j + o as i, hash(substr(part, 2 * o + 1, 800)) as g from (select rid, j, part, unnest(range(0, least(512, length(part) // 2 - 399))) as o from p)),
again as (select rid, i from w join (select g from w group by g having count(*) > 1) using (g)),
edges as (select rid, i, i > coalesce(max(i) over (partition by rid order by i rows between unbounded preceding and 1 preceding), -401) + 400 as opens from again),
runs as (select rid, min(i) as a, max(i) + 400 as z from (select rid, i, sum(opens::int) over (partition by rid order by i rows unbounded preceding) as k from edges) group by rid, k),
spans as (select rid, list(struct_pack(a := a, z := z) order by a) as s from runs group by rid),
kept as (
  select d.*, coalesce(s, []) as s, case when s is null then h else array_to_string(list_transform(range(0, len(s) + 1), lambda k: substr(h, case when k = 0 then 1 else 2 * s[k].z + 1 end, case when k = len(s) then length(h) else 2 * (s[k + 1].a - case when k = 0 then 0 else s[k].z end) end)), '') end as rest
  from d left join spans using (rid))
select doc_id, (length(h) // 2)::bigint as n_bytes, ((length(h) - length(rest)) // 2)::bigint as n_removed, len(s)::bigint as n_spans, sha256(unhex(rest)) as kept_sha256, length(h) > length(rest) as repeated from kept
"""
