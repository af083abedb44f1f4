"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item is a weighted set of word shingles (weights are counts) and a 128-bit SimHash.
The windows of a document that are as long as an item, at every word, get a fingerprint too (a
document shorter than an item is one window). Windows that hold fewer shingles of any item than the
similarity takes are passed over, which loses nothing. Fingerprints meet in a multi-index: within
radius r = 31, one of 8 blocks of 16 bits differs in at most 3; items are held under all values of a
block that are some errors away and windows asked under all that are the rest away, so that no pair
within the radius is missed. Candidates are verified by exact weighted similarity.

A benchmark of up to BROADCAST_BYTES is sent to the tasks as an index; beyond it, blocks are rows of
tables that are joined on the block's number and value. Either way the documents are read once.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stash
from .near_dup import WordHash, _mix, shingles, word_hashes

BITS, BLOCKS, RADIUS = 128, 8, 31
#: UTF-8 bytes of the items' texts up to which their index is broadcast; it has a few times that size.
BROADCAST_BYTES = 16 << 20
#: Bits of the filter of item shingles that is broadcast for a larger benchmark: 16 for each shingle, 2^28 (32 MB) at most.
LEAST_BITS, MOST_BITS = 16, 28
#: Contaminated documents up to which their keys (16 bytes) are broadcast.
BROADCAST_KEYS = 1_000_000


def words_of(text: str | None, memo: WordHash) -> np.ndarray:
    """Hashes of the lower-cased words."""
    return word_hashes((text or "").lower().encode(), memo)


def _signs(s: np.ndarray) -> np.ndarray:
    """+1 and -1 for each bit of the 128-bit expansion of each shingle hash."""
    with np.errstate(over="ignore"):
        wide = np.stack([_mix(s + np.uint64(0x51)), _mix(s + np.uint64(0xA7F3))], 1)
    bits = np.unpackbits(wide.view(np.uint8).reshape(len(s), 16), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as 8 words of 16 bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


def _masks(errors: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for e in range(errors + 1) for c in combinations(range(16), e)], np.uint16)


#: By errors, the differences of a block's value. Items' side and windows' side allow RADIUS // BLOCKS together.
MASKS = [_masks(e) for e in range(RADIUS // BLOCKS + 1)]
#: Of these, the items' side takes 2 in tables that are joined, and in an index as many as fit in so many bytes.
ITEM_ERRORS, INDEX_BYTES = 2, 64 << 20


def item_errors(items: int) -> int:
    """The most errors for which the index of so many items fits, 1 at least; what it holds does not change what is found."""
    return max((e for e, m in enumerate(MASKS) if 4 * BLOCKS * items * len(m) <= INDEX_BYTES), default=1) or 1


def least_common(a: int, b: int, percent: int) -> int:
    """The least sum of smaller counts for which sets of a and b shingles are similar enough."""
    return -(-percent * (a + b) // (100 + percent))


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """(sum of smaller counts, sum of larger counts)"""
    both = (a & b).total()
    return both, a.total() + b.total() - both


def suspects(s: np.ndarray, known: np.ndarray, lengths: list[int], n: int, percent: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(item length in words, window starts, shingles of a window): the windows of shingles ``s`` that
    hold so many that are ``known`` as a similar item would take. lengths: of the items, ascending."""
    upto = np.concatenate([[0], np.cumsum(known)])
    for k in lengths:
        width = k - n + 1
        size = min(width, len(s))  # a text shorter than the item is one window
        need = least_common(size, width, percent)
        if upto[-1] < need or size < need:
            if size == width:
                break  # longer items need more
            continue
        starts = np.flatnonzero(upto[size:] - upto[:-size] >= need)
        if len(starts):
            yield k, starts, size


def window_prints(s: np.ndarray, starts: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, fingerprints) of windows that lie together, at most 4096 at a time."""
    gaps = np.flatnonzero(np.diff(starts) > size) + 1
    for part in (p[i : i + 4096] for p in np.split(starts, gaps) for i in range(0, len(p), 4096)):
        lo, hi = part[0], part[-1] + size
        sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(_signs(s[lo:hi]), 0, dtype=np.int32)])
        yield part, _pack(sums[part - lo + size] - sums[part - lo])


class Index:
    """The benchmark's items."""

    def __init__(self, items: list[tuple[int, str]], n: int, percent: int, errors: int | None = None):
        self.n, self.percent, memo = n, percent, WordHash()
        self.ids, self.counts, self.lengths, prints, known = [], [], [], [], defaultdict(set)
        for item_id, text in items:
            words = words_of(text, memo)
            if not len(words):
                continue
            s = shingles(words, n)
            self.ids.append(item_id)
            self.counts.append(Counter(s.tolist()))
            self.lengths.append(len(words))
            prints.append(_pack(_signs(s).sum(0, keepdims=True))[0])
            for x in set(s.tolist()):
                known[x].add(len(words))
        self.prints = np.array(prints, np.uint16).reshape(-1, BLOCKS)
        self.item_lengths = np.array(self.lengths, np.int64)
        self.distinct_lengths = sorted(set(self.lengths))
        # the items' shingles, and the lengths of the items that have them
        self.known = np.array(sorted(known), np.uint64)
        held = [sorted(known[x]) for x in self.known.tolist()]
        self.held_from = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
        self.held_lengths = np.array([k for x in held for k in x], np.int64)
        # for each block, items by every block value within the item side's errors
        errors = item_errors(len(self.ids)) if errors is None else errors
        own, self.asked = MASKS[errors], MASKS[RADIUS // BLOCKS - errors]
        self.tables = []
        for b in range(BLOCKS):
            key = (self.prints[:, b : b + 1] ^ own[None, :]).ravel()
            order = np.argsort(key, kind="stable")
            self.tables.append((np.concatenate([[0], np.cumsum(np.bincount(key, minlength=65536))]), np.repeat(np.arange(len(self.ids), dtype=np.int32), len(own))[order]))

    def lookup(self, prints: np.ndarray, length: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) within the radius, each once; of the items of a length, if it is given."""
        found, size, step = [], max(1, len(self.ids)), max(1, 65536 // len(self.asked))
        for b, (start, items) in enumerate(self.tables):
            for at in range(0, len(prints), step):
                key = (prints[at : at + step, b : b + 1] ^ self.asked[None, :]).ravel().astype(np.int64)
                lo = start[key]
                count = start[key + 1] - lo
                on = np.flatnonzero(count)
                lo, count = lo[on], count[on]
                ends = np.cumsum(count)
                item = items[np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - ends + count, count)]
                w = np.repeat(on // len(self.asked) + at, count)
                if length is not None:
                    fit = self.item_lengths[item] == length
                    w, item = w[fit], item[fit]
                found.append(w * size + item)
        pair = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        w, i = pair // size, pair % size
        near = np.bitwise_count(prints[w] ^ self.prints[i]).sum(1) <= RADIUS
        return w[near], i[near]

    def matches(self, text: str | None, memo: WordHash) -> list[tuple[int, float, int, int]]:
        """(item id, similarity, first word, words) of the best window for each item that the text holds."""
        if not text or not len(self.known):
            return []
        words = words_of(text, memo)
        best: dict[int, tuple[float, int]] = {}
        for n, _ in shingle_sizes(self.distinct_lengths, self.n):
            if len(words) < n:
                continue
            s = shingles(words, n)
            at = np.searchsorted(self.known, s)
            at[at == len(self.known)] = 0
            for k, known in self._known(s, self.known[at] == s, at, n):
                for _, starts, size in suspects(s, known, [k], n, self.percent):
                    self._compare(s, k, starts, size, best)
        return [(self.ids[i], sim, start, min(self.lengths[i], len(words))) for i, (sim, start) in sorted(best.items())]

    def _known(self, s: np.ndarray, hit: np.ndarray, at: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """(item length, places of shingles that an item of that length has) where these could be enough."""
        places = np.flatnonzero(hit)
        if not len(places):
            return
        lo = self.held_from[at[places]]
        count = self.held_from[at[places] + 1] - lo
        ends = np.cumsum(count)
        lengths = self.held_lengths[np.arange(ends[-1]) + np.repeat(lo - ends + count, count)]
        places = np.repeat(places, count)
        order = np.argsort(lengths, kind="stable")
        lengths, places = lengths[order], places[order]
        cuts = np.flatnonzero(np.diff(lengths)) + 1
        for k, held in zip(lengths[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts), strict=True):
            width = k - n + 1
            if min(self.n, k) == n and len(held) >= least_common(min(width, len(s)), width, self.percent):
                known = np.zeros(len(s), bool)
                known[held] = True
                yield k, known

    def _compare(self, s: np.ndarray, k: int, starts: np.ndarray, size: int, best: dict[int, tuple[float, int]]) -> None:
        for part, prints in window_prints(s, starts, size):
            w, i = self.lookup(prints, k)
            for start, item in zip(part[w].tolist(), i.tolist(), strict=True):
                both, union = similarity(Counter(s[start : start + size].tolist()), self.counts[item])
                if 100 * both >= self.percent * union:
                    sim = both / union
                    if item not in best or (sim, -start) > (best[item][0], -best[item][1]):
                        best[item] = (sim, start)


def shingle_sizes(lengths: list[int], n: int) -> list[tuple[int, list[int]]]:
    """(shingle size, the item lengths that use it): items shorter than a shingle have windows of one shingle of their own size."""
    out = defaultdict(list)
    for k in lengths:
        out[min(n, k)].append(k)
    return sorted(out.items())


def _benchmark(benchmark: DataFrame) -> tuple[DataFrame, int]:
    """The items, written, and the bytes of their texts."""
    held = stash(benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text"), "benchmark")
    return held, held.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _broadcast_items(items: DataFrame) -> Broadcast:
    return items.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in items.orderBy("item_id").collect()])


_FOUND = "doc_id long, version long, item_id long, similarity double, first_word long, n_words long"


def find_contamination(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and item that it holds: doc_id, version (a hash of the text), item_id,
    similarity, first_word, n_words.

    A document holds an item if one of its windows of as many words as the item has a weighted
    shingle similarity (sum of smaller counts over sum of larger counts) of ``percent`` or more and
    a fingerprint within the radius; the best window is reported, the first on ties. A document of
    fewer words than the item is one window, with n_words of its own. Words are lower-cased. Null and
    wordless texts hold nothing, items without words are held by nothing, and items with equal texts
    are each reported. Whole texts are searched. Null ids and repeated rows are found like others;
    beyond ``broadcast_bytes``, rows that are equal in id and text are reported once.
    """
    text = F.col(text_col)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), text.alias("text"))
    items, size = _benchmark(benchmark)
    if size > broadcast_bytes:
        return _find_by_join(texts, items, words, percent)
    shared = _broadcast_items(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = Index(shared.value, words, percent), WordHash()
        for b in slices(batches):
            found = [index.matches(t, memo) for t in b.column(2).to_pylist()]
            rows = [m for x in found for m in x]
            same = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), *(pa.array([r[c] for r in rows], kind) for c, kind in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64())))], names=["doc_id", "version", "item_id", "similarity", "first_word", "n_words"])

    return texts.mapInArrow(run, _FOUND)


def _prepared(items: DataFrame, words: int) -> DataFrame:
    """item_id, k (words), p0 and p1 (fingerprint), shingles (sorted hashes, repeats too)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in slices(batches):
            rows = []
            for item_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if len(w := words_of(text, memo)):
                    s = shingles(w, words)
                    p = _pack(_signs(s).sum(0, keepdims=True))[0].view(np.int64)
                    rows.append((item_id, len(w), int(p[0]), int(p[1]), np.sort(s).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64() if c < 4 else pa.binary()) for c in range(5)], names=["item_id", "k", "p0", "p1", "shingles"])

    return stash(items.mapInArrow(run, "item_id long, k long, p0 long, p1 long, shingles binary"), "items")


def _shingle_filter(prepared: DataFrame) -> np.ndarray:
    """A bit for each value of the last bits of the items' shingle hashes."""
    count = prepared.agg(F.coalesce(F.sum(F.octet_length("shingles") / 8), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * max(1, count)))))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for data in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array((np.frombuffer(data, np.uint64) & np.uint64((1 << bits) - 1)).astype(np.int64))], names=["slot"])

    found = prepared.select("shingles").mapInArrow(slots, "slot long")
    found = found.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow()  # 2^bits / 64 rows at most
    out = np.zeros(1 << bits - 6, np.int64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy()
    return out


def _blocks(df: DataFrame, masks: np.ndarray, *keep: str) -> DataFrame:
    """A row for each block of a fingerprint and each of its values that the masks reach."""
    value = lambda i: F.expr(f"cast(shiftrightunsigned(p{i // 4}, {i % 4 * 16}) & 65535 as int)")
    held = df.select(*keep, F.posexplode(F.array(*[value(i) for i in range(BLOCKS)])).alias("block", "value"))
    mask = F.explode(F.array(*[F.lit(int(m)) for m in masks])).alias("mask")
    return held.select(*keep, "block", "value", mask).select(*keep, "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))


def _find_by_join(texts: DataFrame, items: DataFrame, words: int, percent: int) -> DataFrame:
    """find_contamination for benchmarks that are too large to send to every task."""
    prepared = _prepared(items, words)
    lengths = [r[0] for r in prepared.select("k").distinct().orderBy("k").collect()]  # distinct lengths, not items
    shared = texts.sparkSession.sparkContext.broadcast((_shingle_filter(prepared), shingle_sizes(lengths, words)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (held, sizes), memo = shared.value, WordHash()
        last = np.uint64(64 * len(held) - 1)
        names = ["doc_id", "version", "k", "first_word", "n_words", "p0", "p1", "shingles"]
        for b in slices(batches):
            for row, text in enumerate(b.column(2).to_pylist()):
                w = words_of(text, memo)
                for n, ks in sizes:
                    if len(w) < n:
                        continue
                    s = shingles(w, n)
                    slot = s & last
                    known = (held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)).astype(np.int64) & 1).astype(bool)
                    for k, starts, size in suspects(s, known, ks, n, percent):
                        for part, prints in window_prints(s, starts, size):
                            p, same = prints.view(np.int64), pa.array(np.full(len(part), row))
                            yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), pa.array(np.full(len(part), k)), pa.array(part.astype(np.int64)), pa.array(np.full(len(part), min(k, len(w)))), pa.array(p[:, 0].copy()), pa.array(p[:, 1].copy()), pa.array([s[x : x + size].tobytes() for x in part.tolist()], pa.binary())], names=names)

    windows = texts.mapInArrow(scan, "doc_id long, version long, k long, first_word long, n_words long, p0 long, p1 long, shingles binary")
    windows = stash(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
    asked = _blocks(windows.select("window", "k", "p0", "p1"), MASKS[RADIUS // BLOCKS - ITEM_ERRORS], "window", "k", "p0", "p1")
    there = _blocks(prepared.select("item_id", "k", F.col("p0").alias("q0"), F.col("p1").alias("q1"), "p0", "p1"), MASKS[ITEM_ERRORS], "item_id", "k", "q0", "q1")
    apart = F.bit_count(F.col("p0").bitwiseXOR(F.col("q0"))) + F.bit_count(F.col("p1").bitwiseXOR(F.col("q1")))
    pairs = stash(asked.join(there, ["k", "block", "value"]).where(apart <= RADIUS).select("window", "item_id").distinct(), "candidates")
    both = pairs.join(windows.select("window", "doc_id", "version", "first_word", "n_words", "shingles"), "window").join(prepared.select("item_id", F.col("shingles").alias("theirs")), "item_id").select("doc_id", "version", "item_id", "first_word", "n_words", "shingles", "theirs")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = lambda data: Counter(np.frombuffer(data, np.uint64).tolist())
        for b in slices(batches):
            found = [similarity(count(x), count(y)) for x, y in zip(b.column(5).to_pylist(), b.column(6).to_pylist(), strict=True)]
            b = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([x / max(1, u) for x, u in found], pa.float64()), b.column(3), b.column(4)], names=["doc_id", "version", "item_id", "similarity", "first_word", "n_words"])
            yield b.filter(pa.array([100 * x >= percent * u for x, u in found], pa.bool_()))

    sure = both.mapInArrow(verify, _FOUND)
    best = sure.groupBy("doc_id", "version", "item_id").agg(F.max(F.struct("similarity", (-F.col("first_word")).alias("at"), "n_words")).alias("best"))
    return best.select("doc_id", "version", "item_id", "best.similarity", (-F.col("best.at")).alias("first_word"), "best.n_words")


def _is_found(found: DataFrame) -> tuple[DataFrame, object]:
    """``found`` with its keys renamed, broadcast if it is small, and the condition that a row of
    _key, _version is in it."""
    out = found.withColumnsRenamed({"doc_id": "_d", "version": "_v"})
    out = F.broadcast(out) if out.count() <= BROADCAST_KEYS else out
    return out, F.col("_key").eqNullSafe(F.col("_d")) & (F.col("_version") == F.col("_v"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, broadcast_bytes: int = BROADCAST_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item, as find_contamination judges them. Rows pass
    through with all their columns; nothing is shuffled where the benchmark's index is broadcast."""
    items, size = _benchmark(benchmark)
    if size > broadcast_bytes:
        found = find_contamination(docs, items, words, percent, broadcast_bytes, id_col, text_col)
        found, same = _is_found(stash(found.select("doc_id", "version").distinct(), "contaminated"))
        held = docs.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in docs.columns]).alias("_held"), F.col(id_col).cast("long").alias("_key"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_version"))
        return held.join(found, same, "left_anti").select(*[F.col("_held").getField(c).alias(c) for c in docs.columns])
    at, shared = docs.columns.index(text_col), _broadcast_items(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, memo = Index(shared.value, words, percent), WordHash()
        for b in slices(batches):
            yield b.filter(pa.array([not index.matches(t, memo) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document (id and text) that holds an item: doc_id, version, item_ids (sorted), similarity (the largest)."""
    found = find_contamination(docs, benchmark, **options)
    return found.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity"))


def op3_query(spark, sf_dir) -> DataFrame:
    """Every row of documents, null ids too, with the items that it holds."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found, same = _is_found(stash(contaminated_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "contaminated"))
    out = docs.select(F.col("doc_id").alias("_key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_version")).join(found, same, "left")
    return out.select(F.col("_key").alias("doc_id"), F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.round("similarity", 6).alias("similarity"))


def op3_sql() -> str:
    """All windows of each text that share enough shingles with an item, with their exact similarity; no fingerprints."""
    return r"""
with t as (
  select row_number() over () as rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') as w from documents),
b as (
  select item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') as w from benchmark where text is not null and item_id is not null),
i as (select item_id, w, len(w) as k, least(5, len(w)) as n from b where len(w) > 0),
si as (select item_id, k, n, g, count(*) as c from (select item_id, k, n, array_to_string(w[j:j + n - 1], ' ') as g from i, unnest(range(1, k - n + 2)) as u(j)) group by all),
sd as (select rid, n, p, array_to_string(w[p:p + n - 1], ' ') as g from t, (select distinct n from i), unnest(range(1, len(w) - n + 2)) as u(p)),
met as (select d.rid, s.item_id, s.k, s.n, d.p, d.g, s.c from sd d join si s on d.n = s.n and d.g = s.g),
size as (select m.rid, m.item_id, m.k, m.n, least(m.k, len(any_value(t.w))) as words from met m join t using (rid) group by m.rid, m.item_id, m.k, m.n),
likely as (select m.*, z.words - z.n + 1 as width, m.k - m.n + 1 as of_item from met m join size z using (rid, item_id)
           qualify count(*) over (partition by m.rid, m.item_id) >= 0.8 / 1.8 * (width + of_item) - 1e-9),
starts as (select rid, item_id, p, lead(p, greatest(0, ceil(0.8 / 1.8 * (width + of_item) - 1e-9)::int - 1)) over (partition by rid, item_id order by p) as far, width, of_item, len(t.w) - n + 1 as last from likely join t using (rid)),
wins as (select distinct rid, item_id, width, of_item, s from starts, unnest(range(greatest(1, far - width + 1), least(p, last - width + 1) + 1)) as u(s) where far - p < width),
pair as (
  select w.rid, w.item_id, w.s, width, of_item, sum(least(here, c)) as n_both
  from (select w.rid, w.item_id, w.s, w.width, w.of_item, l.g, l.c, count(*) as here from wins w join likely l on l.rid = w.rid and l.item_id = w.item_id and l.p between w.s and w.s + w.width - 1 group by all) w group by all),
held as (select rid, item_id, max(n_both / (width + of_item - n_both)) as similarity from pair where 100 * n_both >= 80 * (width + of_item - n_both) group by all),
found as (select rid, list_sort(list(item_id)) as item_ids, max(similarity) as similarity from held group by rid)
select doc_id, f.rid is not null as contaminated, coalesce(item_ids, []::bigint[]) as item_ids, round(similarity, 6) as similarity from t left join found f using (rid)
"""
