"""MinHash near-duplicates by a multi-index Hamming join.

A document's signature is K min-hashes of b = 16 bits. Two sets with Jaccard J differ in about
K(1 - J) of them, so a radius r is set 4.2 standard deviations above that. The signature is split
into m chunks with 2m > r: by pigeonhole, two signatures within r differ in at most one value of
some chunk. Each chunk therefore emits one key per value, with that value left out (all errors that
are allowed); every pair within the radius shares a key. Pairs within it are compared on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, scratch, slices, stash, unstash, word_pieces
from .components import connected_components

K = 72
#: Members that one task compares among themselves; larger buckets go in pairs of blocks.
BLOCK = 1024
#: Members that one copy of a hub's set serves.
LEADER_ROWS = 256
#: Pairs within the radius, for each member of two blocks, beyond which the blocks' sets are compared as a whole.
DENSE = 16
#: Shingles of such a block, about: 16 MB of hashes.
BLOCK_SHINGLES = 2_000_000
#: Comparisons of signatures that cost as much as one row of a shuffle.
PAIRS_A_ROW = 256
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x = x ^ (x >> np.uint64(33))
    x = x * _M2
    return x ^ (x >> np.uint64(33))


class WordHash(dict):
    """64-bit hashes of words (bytes), remembered; emptied beyond a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(data: bytes, memo: WordHash) -> np.ndarray:
    parts = [np.fromiter(map(memo.__getitem__, w), np.uint64, len(w)) for w in word_pieces(data)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingles(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles, in order; of the whole sequence if it is shorter."""
    if not len(h):
        return h
    n = min(n, len(h))
    with np.errstate(over="ignore"):
        acc = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            acc = _mix(acc ^ h[i : len(h) - n + 1 + i]) + np.uint64(0x9E3779B97F4A7C15)
    return acc


def shingle_hashes(text: str | None, words: int, memo: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; fewer words: the whole sequence as one."""
    return np.unique(shingles(word_hashes((text or "").encode().lower(), memo), words))  # bytes are lower-cased by ASCII alone


def chunks_for(similarity: float, k: int = K) -> int:
    """The number of chunks m for which 2m - 1 covers K(1 - J) and 4.2 standard deviations."""
    p = 1 - similarity
    return min(k // 2, math.ceil((k * p + 4.2 * math.sqrt(k * p * (1 - p)) + 1) / 2))


def _signature(sets: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """16-bit min-hashes of one set."""
    out = np.full(len(seeds), np.uint64(2**64 - 1))
    with np.errstate(over="ignore"):
        for at in range(0, len(sets), 1024):  # multiplication by an odd number permutes the 64-bit hashes
            out = np.minimum(out, np.multiply.outer(seeds, sets[at : at + 1024]).min(1))
        return (_mix(out) & np.uint64(0xFFFF)).astype(np.uint16)


def _keys(signatures: np.ndarray, m: int) -> np.ndarray:
    """For each signature one key for each value of each chunk: the chunk's other values."""
    width = signatures.shape[1]
    with np.errstate(over="ignore"):
        value = _mix(signatures.astype(np.uint64) + (np.arange(width, dtype=np.uint64) << np.uint64(20)) + np.uint64(1))
        out = np.empty(signatures.shape, np.uint64)
        for c in np.array_split(np.arange(width), m):
            out[:, c] = _mix(value[:, c].sum(1, dtype=np.uint64, keepdims=True) - value[:, c] + _mix(c.astype(np.uint64) + np.uint64(99)))
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    """A row for each signature of a binary column."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), K)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of values in which each signature of ``a`` differs from each of ``b``."""
    out = np.zeros((len(a), len(b)), np.uint8)
    for x, y in zip(a.T, b.T, strict=True):
        out += x[:, None] != y[None, :]
    return out


class _Forest(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            self[x] = x = self[self[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        return True


def link_block(ids: list[int], sets: list[np.ndarray], left: int, percent: int, groups: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``ids``: 100 * intersection >= percent * union.

    left: if not 0, only pairs between the first ``left`` and the rest (and what connects through
    them). groups: ids of one group count as linked already. Intersections of all pairs are
    counted through the shingles that occur twice or more.
    """
    n = len(ids)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    uniq, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[inverse] > 1
    owner, col = owner[several], np.unique(inverse[several], return_inverse=True)[1]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    common = np.zeros((n, n), np.float32)
    total = int(col[-1]) + 1 if len(col) else 0
    for at in range(0, total, 2048):
        lo, hi = np.searchsorted(col, [at, at + 2048])
        x = np.zeros((n, min(2048, total - at)), np.float32)
        x[owner[lo:hi], col[lo:hi] - at] = 1
        common += x @ x.T
    inter = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    linked = np.triu(100 * inter >= percent * union, 1)
    if left:
        linked[:left, :left] = False
        linked[left:, left:] = False
    if groups is not None:
        g = np.array(groups)
        linked &= g[:, None] != g[None, :]
    names = ids if groups is None else groups
    forest, out = _Forest(), []
    for a, b in zip(*np.nonzero(linked), strict=True):
        if forest.join(names[a], names[b]):
            out.append((ids[a], ids[b]))
    return out


def linked_sets(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    inter = int(np.count_nonzero(large[at] == small))
    return 100 * inter >= percent * (len(a) + len(b) - inter)


_LINKS = "u long, v long"


def _link_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def _hubs(shared: DataFrame) -> DataFrame:
    """Two members of each bucket that the others are compared with: the one that meets most others in
    all its buckets, as an original does among its copies, and one at random. shared: key, node, c (the
    bucket's size)."""
    met = stash(shared.groupBy("node").agg(F.sum("c").alias("met")), "bucket-mates")
    ranked = shared.select("key", "node").join(met, "node")
    chosen = ranked.groupBy("key").agg(F.max(F.struct("met", "node")).alias("most"), F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node")).alias("any"))
    return chosen.select("key", F.col("most.node").alias("most"), F.col("any.node").alias("any"))


def _leader_pairs(shared: DataFrame, hubs: DataFrame) -> DataFrame:
    """The distinct pairs (hub, node) of the members of each bucket with its hubs."""
    pairs = shared.select("key", "node").join(hubs, "key").select("node", F.explode(F.array_distinct(F.array("most", "any"))).alias("hub")).where("hub <> node")
    return pairs.select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node")).distinct()


def _within(pairs: DataFrame, marks: DataFrame, percent: int, radius: int) -> DataFrame:
    """Of distinct pairs (hub, node) those with a signature distance within the radius and sizes that
    allow the similarity. marks: node, sig, n."""
    a = pairs.join(marks.select("node", "sig", "n"), "node")
    both = a.join(marks.select(F.col("node").alias("hub"), F.col("sig").alias("sig2"), F.col("n").alias("n2")), "hub").where(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")).select("hub", "node", "sig", "sig2")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            if b.num_rows:
                fit = (_signatures(b.column(2)) != _signatures(b.column(3))).sum(1) <= radius
                yield b.select([0, 1]).filter(pa.array(fit))

    return both.mapInArrow(near, "hub long, node long")


def _links_of(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) among the pairs (hub, node), on full sets. A hub's set is sent once for every
    LEADER_ROWS of its pairs."""
    parts = stash(pairs.groupBy("hub").agg(F.ceil(F.count("*") / LEADER_ROWS).cast("int").alias("parts")), "hub-parts")
    members = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "node")
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("hub").alias("node"))
    dealt = members.unionByName(hubs).join(sets, "node").select("hub", "part", "node", "set").repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("node") != F.col("hub"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held = None
        for b in slices(batches):
            found = []
            for hub, part, node, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if node == hub:
                    at, held = (hub, part), np.frombuffer(data, np.uint64)
                elif at != (hub, part):
                    raise ValueError("a hub's set has not arrived before its members")
                elif linked_sets(held, np.frombuffer(data, np.uint64), percent):
                    found.append((hub, node))
            yield _link_batch(found)

    return dealt.mapInArrow(compare, _LINKS)


def _groups_of(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key, rows) of rows that arrive sorted by their first ``width`` columns; a group is a bounded pair of blocks."""
    at, held = None, []
    for b in slices(batches):
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[:width] != at:
                if held:
                    yield at, held
                at, held = row[:width], []
            held.append(row[width:])
    if held:
        yield at, held


def _overlapping(members: DataFrame) -> DataFrame:
    """Members (key, node, comp, n) of buckets, with buckets that share members brought together where that
    makes fewer rows and comparisons: near copies share up to K buckets, which hold much the same members.

    A pair within the radius shares a bucket in any case, so the candidates stay the same; each is then
    found once, and not in every bucket that both are in."""
    cost = lambda n: n + n * n / PAIRS_A_ROW
    buckets = stash(members.groupBy("key").agg(F.min("node").alias("low"), F.count("*").alias("size")), "bucket-lows")
    reach = stash(connected_components(members.join(buckets, "key").select(F.col("node").alias("u"), F.col("low").alias("v"))), "bucket-groups")
    apart = buckets.join(reach.withColumnRenamed("id", "low"), "low").select("key", "component", cost(F.col("size")).alias("cost"))
    apart = stash(apart, "bucket-costs")
    whole = reach.groupBy("component").agg(cost(F.count("*")).alias("whole"))
    fewer = apart.groupBy("component").agg(F.sum("cost").alias("cost")).join(whole, "component").where("whole <= cost").select("component")
    homes = stash(apart.join(fewer, "component").select("key", F.col("component").alias("home")), "bucket-homes")
    out = stash(members.join(homes, "key", "left").select(F.coalesce("home", "key").alias("key"), "node", "comp", "n").distinct(), "open-groups")
    for t in (buckets, reach, apart, homes):
        unstash(t)
    return out


def _open_links(shared: DataFrame, component: DataFrame, marks: DataFrame, sets: DataFrame, percent: int, radius: int) -> DataFrame:
    """Links (u, v) within buckets whose members are in several components still.

    Buckets of equal members are looked at once, overlapping ones together. A bucket's members go to blocks, those of a large
    component to blocks of their own, and pairs of blocks are compared but for pairs of blocks of
    one component, whose members need no more links. Signatures are compared first. Where few pairs
    of a pair of blocks are within the radius, these are compared on full sets; where many are, the
    two blocks' sets are brought together and compared there, so that no group emits its pairs."""
    named = shared.select("key", "node").join(component.select(F.col("id").alias("node"), "component"), "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
    named = stash(named, "bucket-members")
    several = named.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("z"), F.count("*").alias("n"), *[F.sum(F.xxhash64("node", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(2)]).where("a < z")
    once = stash(several.groupBy("n", "s0", "s1").agg(F.min("key").alias("key")).select("key"), "open-buckets")
    left = stash(named.join(once, "key", "left_semi").join(marks.select("node", "n"), "node"), "open-members")
    unstash(named), unstash(once)
    members, left = left, _overlapping(left)
    unstash(members)

    def parts(count, size):
        return F.greatest(F.ceil(count / BLOCK), F.ceil(size / BLOCK_SHINGLES)).cast("int")

    comps = stash(left.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("s")), "bucket-components")
    # a bucket that fits in a block is not split; else large components get blocks of their own
    whole = comps.groupBy("key").agg(parts(F.sum("c"), F.sum("s")).alias("blocks"))
    own = (F.col("blocks") > 1) & ((F.col("c") > BLOCK // 4) | (F.col("s") > BLOCK_SHINGLES // 4))
    comps = comps.join(whole, "key").withColumn("own", own)
    pool = comps.where("not own").groupBy("key").agg(parts(F.sum("c"), F.sum("s")).alias("pool"))
    where = stash(comps.join(pool, "key", "left").select("key", "comp", F.when(F.col("own"), F.col("comp")).otherwise(F.lit(-1)).alias("owner"), F.when(F.col("own"), parts(F.col("c"), F.col("s"))).otherwise(F.col("pool")).alias("parts")), "bucket-blocks")
    part = F.pmod(F.xxhash64(F.when(F.col("owner") < 0, F.col("comp")).otherwise(F.col("node"))), F.col("parts")).cast("int")
    placed = stash(left.join(where, ["key", "comp"]).select("key", "node", "comp", "owner", part.alias("part")), "placed")
    blocks = placed.select("key", F.struct("owner", "part").alias("block")).distinct()
    # pairs of blocks, one row each; those of a pooled block with itself too
    pairs = blocks.join(blocks.withColumnRenamed("block", "other"), "key").where((F.col("block") <= F.col("other")) & ((F.col("block.owner") < 0) | (F.col("block.owner") != F.col("other.owner"))))
    at = ["key", "io", "ip", "jo", "jp"]
    pairs = stash(pairs.select("key", *[F.col(f"{x}.{y}").alias(z) for z, x, y in (("io", "block", "owner"), ("ip", "block", "part"), ("jo", "other", "owner"), ("jp", "other", "part"))]), "block-pairs")

    def dealt(pairs: DataFrame, payload: DataFrame) -> DataFrame:
        """The members of both blocks of each pair, those of the first block first."""
        ends = F.explode(F.array_distinct(F.array(F.struct(F.col("io").alias("owner"), F.col("ip").alias("part")), F.struct(F.col("jo").alias("owner"), F.col("jp").alias("part")))))
        sent = pairs.select(*at, ends.alias("e")).select(*at, "e.*")
        work = placed.join(sent, ["key", "owner", "part"]).join(payload, "node")
        first = (F.col("owner") == F.col("io")) & (F.col("part") == F.col("ip"))
        return work.select(*at, first.alias("first"), "node", "comp", payload.columns[1]).repartition(*at).sortWithinPartitions(*at, F.desc("first"), "node")

    def by_signature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []

        def out():
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["hub", "node", *at])

        for key, held in _groups_of(batches, 5):
            first = sum(r[0] for r in held)
            nodes, comp = np.array([r[1] for r in held]), np.array([r[2] for r in held])
            sig = np.frombuffer(b"".join(r[3] for r in held), np.uint16).reshape(-1, K)
            alone = key[1:3] == key[3:]
            x, y = (slice(None), slice(None)) if alone else (slice(0, first), slice(first, None))
            near = (distances(sig[x], sig[y]) <= radius) & (comp[x][:, None] != comp[y][None, :])
            i, j = np.nonzero(np.triu(near) if alone else near)
            if len(i) > DENSE * len(held):
                rows.append((None, None, *key))
            else:
                a, b = nodes[x][i], nodes[y][j]
                rows.extend((*p, None, None, None, None, None) for p in zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
            if len(rows) > 10_000:
                yield out()
                rows.clear()
        yield out()

    schema = "hub long, node long, key long, io long, ip int, jo long, jp int"
    found = stash(dealt(pairs, marks.select("node", "sig")).mapInArrow(by_signature, schema), "open-pairs")
    few = stash(found.where("hub is not null").select("hub", "node").distinct().join(marks.select("node", "n"), "node").join(marks.select(F.col("node").alias("hub"), F.col("n").alias("n2")), "hub").where(100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")).select("hub", "node"), "few-pairs")

    def by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, held in _groups_of(batches, 5):
            first = sum(r[0] for r in held)
            yield _link_batch(link_block([r[1] for r in held], [np.frombuffer(r[3], np.uint64) for r in held], first if key[1:3] != key[3:] else 0, percent, [r[2] for r in held]))

    many = found.where("hub is null").select(*at)
    links = _links_of(few, sets, percent)
    return links if many.isEmpty() else links.unionByName(dealt(many, sets).mapInArrow(by_sets, _LINKS))


def near_groups(docs: DataFrame, words: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: doc_id, version (a hash of the text), n_shingles, and
    component_id and component_version, those of the component's first document: the smallest
    doc_id (nulls last), then version.

    A-Z are lower-cased. Null texts and texts without words have no shingles and link with nothing;
    they are components of their own. Equal sets are one class from the start and compared once, so
    a group of copies costs as much as one text. Nodes are classes, not ids: rows that repeat an id
    with another text are documents of their own, and null ids take part like any other.

    Candidates are the pairs of a bucket of equal keys whose signatures are within the radius. First
    the members of each bucket are compared with two of them; most buckets are then of one component. In those that are not, the members of unlike components are compared, in pairs of
    blocks, at every size alike.
    """
    m = chunks_for(percent / 100)
    seeds = np.random.default_rng(20240501).integers(1, 2**63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    schema = "doc_id long, version long, n_shingles long, c1 long, c2 long, sig binary"

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHash()
        for b in slices(batches):
            n, c1, c2, sig = [], [], [], []
            for text in b.column(2).to_pylist():
                s = shingle_hashes(text, words, memo)
                n.append(len(s))
                if not len(s):
                    c1.append(0), c2.append(0), sig.append(None)
                    continue
                with np.errstate(over="ignore"):
                    c1.append(int(_mix(s).sum(dtype=np.uint64).view(np.int64)))
                    c2.append(int(_mix(s + np.uint64(77)).sum(dtype=np.uint64).view(np.int64)))
                sig.append(_signature(s, seeds).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "version", "n_shingles", "c1", "c2", "sig"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            if b.num_rows:
                same = pa.array(np.repeat(np.arange(b.num_rows), K))
                yield pa.RecordBatch.from_arrays([b.column(0).take(same), pa.array(_keys(_signatures(b.column(1)), m).ravel().view(np.int64))], names=["node", "key"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"), F.col(text_col).alias("text"))
    sketches = stash(texts.mapInArrow(sketch, schema), "sketches")
    doc = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "version")
    member = sketches.select("doc_id", "version", "n_shingles", "c1", "c2")
    # classes of equal sets, by size and 128 bits of the set's sum; numbered as they are written
    classes = sketches.where("n_shingles > 0").groupBy("n_shingles", "c1", "c2").agg(F.min(doc).alias("rep"), F.first("sig").alias("sig"))
    classes = stash(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    keyed = stash(classes.select("node", "sig").mapInArrow(keys, "node long, key long"), "keys")
    # buckets with two members or more
    # (written, so that the join has a plain exchange on both sides and a hot key can be split)
    sizes = stash(keyed.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "bucket-sizes")
    shared = stash(keyed.join(sizes, "key"), "buckets")
    hubs = stash(_hubs(shared), "hubs")
    unstash(sizes), unstash(keyed)

    def set_bytes(batches):
        memo = WordHash()
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_hashes(t, words, memo).tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["node", "set"])

    # the sets of the members, once; of rows that repeat the class's first document any will do
    asked = classes.select("node", "rep.*").join(shared.select("node").distinct(), "node", "left_semi")
    asked = stash(asked.select("node", F.col("doc_id").alias("_d"), F.col("version").alias("_v")), "asked")
    # (always by a shuffle of both sides: the list of what is asked grows with the table)
    rows = texts.join(asked.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("version") == F.col("_v"))).select("node", "text").dropDuplicates(["node"])
    sets = stash(rows.mapInArrow(set_bytes, "node long, set binary"), "sets")
    marks = stash(classes.select("node", "sig", F.col("n_shingles").alias("n")).join(sets.select("node"), "node", "left_semi"), "marks")
    leaders = stash(_within(_leader_pairs(shared, hubs), marks, percent, 2 * m - 1), "leader-pairs")
    star = stash(connected_components(stash(_links_of(leaders, sets, percent), "leader-links")), "leader-components")
    more = stash(_open_links(shared, star, marks, sets, percent, 2 * m - 1), "open-links")
    comps = star if more.isEmpty() else stash(connected_components(star.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(more)), "components")
    # the first document of each component of several classes
    named = stash(comps.join(classes.select(F.col("node").alias("id"), "rep"), "id").select("id", "component", "rep"), "component-members")
    best = named.groupBy("component").agg(F.min("rep").alias("best"))
    firsts = named.join(stash(best, "component-firsts"), "component").select(F.col("id").alias("node"), "best")
    rep = stash(classes.select("node", "n_shingles", "c1", "c2", "rep").join(firsts, "node", "left").select("n_shingles", "c1", "c2", F.coalesce("best", "rep").alias("best")), "class-components")
    unstash(shared), unstash(sets)
    out = member.join(rep, ["n_shingles", "c1", "c2"], "left")
    of = lambda name: F.when(F.col("n_shingles") > 0, F.col(f"best.{name}")).otherwise(F.col(name)).alias(f"component_{name.removeprefix('doc_')}")
    return out.select("doc_id", "version", "n_shingles", of("doc_id"), of("version"))


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable, itself
    included; null if all are null) and kept (doc_id is that). See near_groups; rows that repeat an
    id with texts of one component are all kept or none."""
    groups = near_groups(docs, words, percent, id_col, text_col)
    return groups.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def first_of_groups(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest doc_id (nulls
    last), then version. Rows are told apart by id and text, so that of two texts under one id only
    the duplicate goes; of rows equal in both any one stays. Rows without words all stay but for
    such repeats. All columns stay as they are."""
    with scratch():
        groups = kept(stash(near_groups(docs, words, percent, id_col, text_col).select("doc_id", "version", "component_id", "component_version"), "near-groups"))
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("version") == F.col("component_version"))
    fate = groups.groupBy("doc_id", "version").agg(F.count("*").alias("n"), F.min(first).alias("first"))
    fate = stash(fate.where("n > 1 or not first").select(F.col("doc_id").alias("_d"), F.col("version").alias("_v"), "first"), "near-fates")
    held = docs.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in docs.columns]).alias("_held"), F.col(id_col).cast("long").alias("_key"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_version"))
    same = F.col("_key").eqNullSafe(F.col("_d")) & (F.col("_version") == F.col("_v"))
    columns = [F.col("_held").getField(c).alias(c) for c in docs.columns]
    single = held.join(fate, same, "left_anti").select(*columns)
    again = fate.where("first")
    if again.isEmpty():
        return single
    # rows that repeat a document, combined before the shuffle
    return single.unionByName(held.join(again, same, "left_semi").dropDuplicates(["_key", "_version"]).select(*columns))


def op5_query(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=85)


def op5_sql() -> str:
    return """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 3 then [array_to_string(w, ' ')]
                                      else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select distinct doc_id as id, doc_id as c from documents union select e.b, r.c from r join e on r.id = e.a),
m as (select id, min(c) as component_id from r group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, d.doc_id = m.component_id as kept
from documents d left join n on n.doc_id = d.doc_id left join m on m.id = d.doc_id
"""
