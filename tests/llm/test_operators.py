"""The training-data operators against plain models, and their edge cases."""

import hashlib
import random
import re
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from sightline.llm import components, decontaminate, html_text, line_dedup, mixing, near_dup, quality, suffix_dedup, token_counts, url_filters, warc
from sightline.llm.components import connected_components
from sightline.llm.queries import ORACLES, QUERIES

from ..conftest import SF, rows_of
from . import brute

DOCS = "doc_id long, text string"
VOCAB = [f"w{i}" for i in range(40)]


def words(n, seed):
    return random.Random(seed).choices(VOCAB, k=n)


def docs_with_copies(n=60, seed=0):
    r = random.Random(seed)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, "Two Words"), (6, "two words")]
    base = [r.choices(VOCAB, k=r.randint(30, 120)) for _ in range(8)]
    for i in range(7, n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
            w[r.randrange(len(w))] = r.choice(["new", "x", "y"])
        rows.append((i, "  ".join(w) if r.random() < 0.5 else "\n".join(w)))
    return rows


# ---- token counts ----


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    return path, lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


def test_token_counts(spark, tokenizer, tmp_path):
    path, count = tokenizer
    texts = [None, "", "  ", "Hello  world", "Hello world", " hello\tWORLD ", "a<|endoftext|>b", "<|ENDOFTEXT|>", "it's we'll 3.14", "é ́x", " x y", "日本語 text", "x" * 5000, "a b " * 4000, "\r\n\x0b\x0cq"]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, digest int")
    cache = f"file://{tmp_path}/cache"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.digest) for r in token_counts.count_tokens(df, path, cache).collect()}
    assert got == {i: (len((t or "").encode()), count(t), 7) for i, t in enumerate(texts)}
    first = spark.read.parquet(cache).count()
    again = token_counts.count_tokens(df.limit(5), path, cache).collect()
    assert spark.read.parquet(cache).count() == first and all(r.cached for r in again)  # nothing new was encoded
    spark.conf.set(token_counts.CACHE_SETTING, cache)  # a cache that the session names
    try:
        more = spark.createDataFrame([(0, texts[3], 1), (1, "a text that is new", 1)], "doc_id long, text string, digest int")
        got = {r.doc_id: (r.n_tokens, r.cached) for r in token_counts.count_tokens(more, path).collect()}
    finally:
        spark.conf.unset(token_counts.CACHE_SETTING)
    assert got == {0: (count(texts[3]), True), 1: (count("a text that is new"), False)}
    assert spark.read.parquet(cache).count() == first + 1
    assert token_counts.count_tokens(df.limit(0), path).count() == 0


def test_token_counts_over_random_texts(spark, tokenizer):
    path, count = tokenizer
    r = random.Random(2)
    alphabet = list("ab'sT.3 \n\t\x0b\x0c\r\x1f\x85  éÉéßǅ日한ᄒ<|>") + ["<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 30))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    assert {x.doc_id: x.n_tokens for x in token_counts.count_tokens(df, path).collect()} == {i: count(t) for i, t in enumerate(texts)}


# ---- quality ----


def test_quality_oracle(spark, oracle):
    assert rows_of(quality.op2_query(spark, SF).toPandas()) == rows_of(oracle(quality.op2_sql()))


def test_quality_measures_of_edge_cases(spark):
    texts = [None, "", " ", "a b c a b c", "a b c d\na b c d\n \n\n", "x y", "a a a a", "#*$ & é<>|%"]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    got = df.select(quality.n_repeat_words(F.col("text")), quality.n_dup_lines(F.col("text")), quality.n_symbols(F.col("text")), quality.word_chars(F.col("text"))).collect()
    assert [tuple(r) for r in got] == [(0, 0, 0, 0), (0, 0, 0, 0), (0, 0, 0, 0), (6, 0, 0, 6), (8, 1, 0, 8), (0, 0, 0, 2), (4, 0, 0, 4), (0, 0, 8, 9)]
    judged = quality.judge_quality(df)
    assert set(judged.columns) == {"doc_id", "text", "kept", "_kept"} and judged.where("_kept").count() == 0
    assert quality.judge_quality(df.limit(0)).count() == 0


def test_quality_order_does_not_change_verdicts(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    key = lambda rules: {r.doc_id: r.kept for r in quality.judge_quality(df, rules).select("doc_id", "kept").collect()}
    assert key(quality.RULES) == key(quality.RULES[::-1])


def test_quality_keeps_clean_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    judged = quality.judge_quality(df).where(F.size(F.split("text", r"\s+")) >= 60)
    assert judged.where("quality = 1 and not kept").count() == 0
    assert judged.where("quality = 0 and kept").count() <= 0.1 * judged.where("quality = 0").count() + 1


# ---- decontamination ----


def test_decontamination(spark):
    r = random.Random(5)
    items = [(i, " ".join(r.choices(VOCAB, k=r.randint(3, 40)))) for i in range(12)] + [(90, None), (91, " "), (92, "lone")]
    rows = [(0, None), (1, ""), (2, "Lone"), (3, "short")]
    for d in range(4, 50):
        w = r.choices(["z" + x for x in VOCAB], k=r.randint(0, 60))
        if r.random() < 0.7:
            part = items[r.randrange(12)][1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                part[r.randrange(len(part))] = r.choice(["Q", "q"])
            at = r.randint(0, len(w))
            w[at:at] = [x.upper() for x in part]
        rows.append((d, " ".join(w)))
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    want = brute.contaminated(rows, items)
    for size in (decontaminate.BROADCAST_BYTES, 0):  # as an index, and by a join
        got = {r.doc_id: set(r.item_ids) for r in decontaminate.contaminated_documents(docs, bench, broadcast_bytes=size).collect()}
        assert got == want
        left = decontaminate.drop_contaminated(docs, bench, broadcast_bytes=size).select("doc_id").toPandas().doc_id
        assert set(left) == {d for d, _ in rows} - set(want)
    assert decontaminate.find_contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def test_decontamination_of_texts_shorter_than_an_item(spark):
    r = random.Random(9)
    items = [(i, " ".join(r.choices(VOCAB, k=k))) for i, k in enumerate([59, 59, 58, 30, 9, 6, 5, 4, 3])]
    rows = []
    for i, text in items:
        w = text.split()
        for less in range(0, min(len(w), 14)):
            rows += [(len(rows), " ".join(w[less:])), (len(rows) + 1, " ".join(w[: len(w) - less]).upper())]
            part = w[: len(w) - less]
            part[r.randrange(len(part))] = "other"
            rows.append((len(rows), " ".join(part)))
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    short, same = brute.contaminated_whole(rows, items), brute.contaminated(rows, items)
    want = {d: short.get(d, set()) | same.get(d, set()) for d in {*short, *same}}
    assert len(short) > 20
    found = decontaminate.find_contamination(docs, bench).collect()
    joined = decontaminate.find_contamination(docs, bench, broadcast_bytes=0).collect()
    assert sorted(map(tuple, joined)) == sorted(map(tuple, found))
    got = {}
    for x in found:
        got.setdefault(x.doc_id, set()).add(x.item_id)
    assert got == want
    assert all(x.n_words == min(len(rows[x.doc_id][1].split()), len(items[x.item_id][1].split())) for x in found)
    left = {x.doc_id for x in decontaminate.drop_contaminated(docs, bench).select("doc_id").collect()}
    assert left == {d for d, _ in rows} - set(want)


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_suffix_dedup", "op10_html_text"])
def test_oracles_over_whole_texts(spark, oracle, name):
    got, want = QUERIES[name](spark, SF).toPandas(), oracle(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


@pytest.mark.parametrize("errors", [1, 2, 3])
def test_index_finds_every_fingerprint_within_the_radius(errors):
    rng = np.random.default_rng(1)
    items = [(i, " ".join(words(20, i))) for i in range(30)]
    index = decontaminate.Index(items, 5, 80, errors)
    base = index.prints[rng.integers(0, 30, 500)]
    bits = np.unpackbits(base.view(np.uint8), axis=1)
    for row in bits:
        row[rng.choice(128, rng.integers(0, 34), replace=False)] ^= 1
    probes = np.packbits(bits, axis=1).view(np.uint16)
    w, i = index.lookup(probes)
    near = np.bitwise_count(probes[:, None, :] ^ index.prints[None, :, :]).sum(2) <= decontaminate.RADIUS
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_decontamination_recall_near_the_threshold():
    """Windows with a similarity of 0.8 to 0.85, among other words: the fingerprints find 0.98 of them or more."""
    r = random.Random(12)
    pool = [f"v{i}" for i in range(4000)]
    items = [(i, " ".join(r.choices(pool, k=r.randint(40, 90)))) for i in range(300)]
    index, memo, near, found = decontaminate.Index(items, 5, 80), near_dup.WordHash(), 0, 0
    for i, text in items:
        for _ in range(8):
            w = text.split()
            for _ in range(r.randint(1, 3)):
                w[r.choice([0, 1, 2, -1, -2, r.randrange(len(w))])] = "other"
            both, union = decontaminate.similarity(*(decontaminate.Counter(near_dup.shingles(decontaminate.words_of(x, memo), 5).tolist()) for x in (" ".join(w), text)))
            if 80 <= 100 * both / union < 85:
                near += 1
                found += i in [m[0] for m in index.matches(" ".join([*r.choices(pool, k=50), *w, *r.choices(pool, k=50)]), memo)]
    assert near > 300 and found >= 0.98 * near


def test_decontamination_of_null_ids_repeated_rows_and_clashing_names(spark, tmp_path):
    item = " ".join(words(30, 77))
    clash = ["_held", "_key", "_d", "version", "_v", "item_id"]
    rows = [(None, "x " + item), (None, "clean text"), (None, None), (1, item), (1, item), (1, "clean too"), (2, "y " * 200_000 + item + " z" * 200_000)]
    docs = spark.createDataFrame([(*x, *clash) for x in rows], DOCS + ", " + ", ".join(f"`{c}` string" for c in clash))
    bench = spark.createDataFrame([(5, item), (6, item)], "item_id long, text string")
    for size in (decontaminate.BROADCAST_BYTES, 0):
        left = decontaminate.drop_contaminated(docs, bench, broadcast_bytes=size)
        assert left.columns == docs.columns
        assert sorted((x.doc_id or 0, x.text or "", x._held) for x in left.collect()) == [(0, "", "_held"), (0, "clean text", "_held"), (1, "clean too", "_held")]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((x.doc_id or 0, x.contaminated, tuple(x.item_ids)) for x in decontaminate.op3_query(spark, str(tmp_path)).collect())
    assert got == [(0, False, ()), (0, False, ()), (0, True, (5, 6)), (1, False, ()), (1, True, (5, 6)), (1, True, (5, 6)), (2, True, (5, 6))]


# ---- suffix dedup ----


@pytest.mark.parametrize("most", [suffix_dedup.MOST_BYTES, 0])
def test_suffix_dedup(spark, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST_BYTES", most)  # 0: all anchors count as hot
    r = random.Random(3)
    passage = ["".join(r.choices("abcdé ", k=n)) for n in (90, 140, 300)]
    texts = [None, "", "x" * 100, "ab" * 200, passage[0], passage[0]]
    for _ in range(30):
        texts.append("".join(r.choice([r.choice(passage), r.choice(passage)[r.randrange(60) :], "".join(r.choices("xyz", k=r.randint(1, 50)))]) for _ in range(r.randint(1, 4))))
    texts.append(texts[-1])
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.cut_repeats(df, 60).collect()}
    assert got == dict(enumerate(brute.cut_repeats(texts, 60)))


def test_suffix_dedup_query_over_ten_thousand_documents(spark):
    """op4 over the whole sf0.1 table equals a count of all its windows, row by row."""
    sf = SF.replace("0.001", "0.1")
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute.cut_repeats_by_hash([r.text for r in rows], 400)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.op4_query(spark, sf).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want, strict=True)} and sum(w[1] > 0 for w in want) > 1000
    small = [r.text for r in rows[:40]]
    assert brute.cut_repeats_by_hash(small, 400) == brute.cut_repeats(small, 400)


def test_suffix_dedup_of_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "q" * 10 + "".join(map(str, range(200)))), (None, "q" * 10 + "".join(map(str, range(200))))], DOCS)
    got = suffix_dedup.cut_repeats(df, 400).collect()
    assert [r.n_removed for r in got] == [500, 500] and [r.n_spans for r in got] == [1, 1]
    assert suffix_dedup.cut_repeats(df.limit(0)).count() == 0
    assert suffix_dedup.cut_repeats(df.limit(1)).first().n_removed == 0


def test_interval_expansion():
    r = random.Random(7)
    for _ in range(60):
        parts = [bytes(r.choice(b"ab c") for _ in range(r.choice([20, 60, 200]))) for _ in range(3)]
        texts = [b"".join(r.choice(parts)[r.randrange(10) :][: r.randrange(10, 200)] for _ in range(r.randint(0, 4))) for _ in range(r.randint(1, 8))]
        length = r.choice([34, 50])
        count = {}
        for c in texts:
            for i in range(len(c) - length + 1):
                count[c[i : i + length]] = count.get(c[i : i + length], 0) + 1
        want = [[count[c[i : i + length]] > 1 for i in range(len(c) - length + 1)] for c in texts]
        assert [g.tolist() for g in suffix_dedup.repeated_starts(texts, length)] == want


# ---- near duplicates ----


@pytest.mark.parametrize("k,percent,block", [(3, 85, near_dup.BLOCK), (5, 80, 1)])
def test_near_duplicates(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)  # small: pairs of blocks
    monkeypatch.setattr(near_dup, "LEADER_ROWS", min(256, 2 * block))
    rows = docs_with_copies()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component_id int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, k, percent).collect()}
    assert got == brute.near_components(rows, k, percent)


@pytest.mark.parametrize("block,dense", [(near_dup.BLOCK, near_dup.DENSE), (4, 0)])
def test_open_links_join_what_leaders_leave_apart(spark, monkeypatch, block, dense):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "DENSE", dense)  # 0: the sets of all blocks with a candidate are brought together
    r = random.Random(block)
    chain = [frozenset(range(i, i + 60)) for i in range(1, 241, 3)]  # neighbours are linked, ends are not
    sets = [*chain, *(frozenset(r.sample(range(1000, 1100), 60)) for _ in range(20))]
    seeds = np.random.default_rng(1).integers(1, 2**63, near_dup.K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    data = [(i, near_dup._mix(np.array(sorted(x), np.uint64))) for i, x in enumerate(sets)]
    s = spark.createDataFrame([(i, np.sort(x).tobytes()) for i, x in data], "node long, set binary")
    marks = spark.createDataFrame([(i, near_dup._signature(x, seeds).tobytes(), len(x)) for i, x in data], "node long, sig binary, n long")
    shared = spark.createDataFrame([(key, i, len(sets)) for key in (5, 6) for i in range(len(sets))], "key long, node long, c long")  # one hot bucket, twice
    radius = 2 * near_dup.chunks_for(0.85) - 1
    leaders = near_dup._within(near_dup._leader_pairs(shared, near_dup._hubs(shared)), marks, 85, radius)
    star = connected_components(near_dup._links_of(leaders, s, 85))
    links = star.select(F.col("id").alias("u"), F.col("component").alias("v")).unionByName(near_dup._open_links(shared, star, marks, s, 85, radius))
    got = {x.id: x.component for x in connected_components(links).collect()}
    linked = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    want = {}
    for i in range(len(sets)):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = [y for y in range(len(sets)) if y not in seen and linked(sets[x], sets[y])]
            seen.update(new), todo.extend(new)
        want[i] = min(seen)
    assert {i: got.get(i, i) for i in range(len(sets))} == want and len(set(want.values())) > 2


def test_overlapping_buckets_are_looked_at_together(spark):
    """A group whose members share many buckets is placed once; a path of buckets, which would make more pairs, stays as it is."""
    r = random.Random(1)
    group = [(key, node) for key in range(100, 140) for node in sorted(r.sample(range(50), 40))]
    path = [(1000 + i, 1000 + i + d) for i in range(2000) for d in (0, 1)]
    members = spark.createDataFrame([(k, n, n, 9) for k, n in group + path], "key long, node long, comp long, n long")
    got = [tuple(x) for x in near_dup._overlapping(members).collect()]
    assert len(got) == len(set(got)) == 50 + len(path)
    buckets = {}
    for key, node, comp, n in got:
        assert (comp, n) == (node, 9)
        buckets.setdefault(key, set()).add(node)
    old = {}
    for key, node in group + path:
        old.setdefault(key, set()).add(node)
    assert all(any(x <= y for y in buckets.values()) for x in list(old.values())[:60])
    assert {tuple(sorted(x)) for x in buckets.values()} >= {(i, i + 1) for i in range(1000, 3000)}


def test_near_duplicates_of_repeated_rows_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (None, "a b c d"), (3, None), (None, "x y z")], DOCS)
    got = sorted([(r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in near_dup.near_duplicates(df).collect()])
    assert got == [(-1, 1, -1, True), (-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_repeated_ids_with_unlike_texts(spark):
    a, b = " ".join(words(30, 1)), " ".join(words(30, 2))
    near = a.replace(a.split()[0], "other", 1)
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (3, None, 4), (3, None, 5), (4, "", 6), (None, b, 7), (5, near, 8), (5, near, 9), (1, a, 1), (None, "lone", 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _held int")
    left = near_dup.first_of_groups(df)
    assert left.columns == df.columns
    got = sorted(((r.doc_id or 0, r.text or "") for r in left.collect()))
    assert got == sorted([(1, a), (2, b), (3, ""), (4, ""), (0, "lone")])
    comps = {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(df, 5, 80).collect()}
    assert comps == {(1, 1), (2, 1), (2, 2), (3, 3), (4, 4), (None, 2), (5, 1), (None, None)}


def test_signatures_within_the_radius_share_a_key():
    rng = np.random.default_rng(0)
    m = near_dup.chunks_for(0.85)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dup.K).astype(np.uint16)
        b = a.copy()
        b[rng.choice(near_dup.K, 2 * m - 1, replace=False)] ^= 1
        assert np.intersect1d(*near_dup._keys(np.stack([a, b]), m)).size
        assert near_dup.distances(a[None], b[None])[0, 0] == 2 * m - 1


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == dict.fromkeys(range(201), 0) | {400: 400, 500: 400}

def component_edges(seed):
    """Paths, stars with a late hub, cliques, loops, repeats and nulls, with ids of both signs."""
    r = random.Random(seed)
    path = r.sample(range(-10_000, 0), 120)
    edges = [*zip(path, path[1:], strict=False), *((5000, i) for i in range(100, 160)), *((i, j) for i in range(200, 212) for j in range(200, 212))]
    edges += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(260)]
    edges += [(7, 7), (None, 8), (9, None), (2**62, -(2**62)), *edges[:20]]
    r.shuffle(edges)
    forest = near_dup._Forest()
    for u, v in edges:
        if u is not None and v is not None and u != v:
            forest.join(u, v)
    return edges, {u: forest.find(u) for u in list(forest)}


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_components_both_ways(spark, monkeypatch, bound):
    monkeypatch.setattr(components, "TASK_EDGES", bound)
    edges, want = component_edges(bound)
    assert {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()} == want
    assert connected_components(spark.createDataFrame([(1, 1)], "u long, v long")).collect() == []


def test_components_of_few_edges_take_few_jobs(spark):
    edges = spark.createDataFrame(component_edges(3)[0], "u long, v long")
    spark.sparkContext.setJobGroup("components", "")
    try:
        connected_components(edges).collect()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("components")) <= 6
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


# ---- URL filters ----


def test_url_filters(spark):
    urls = ["http://www.EXAMPLE.com/en/x", "https://example.com/en/", "http://example.com/fr?x=/en/", "http://example.com", "//x", None, "", "no scheme", "http://a.net/es/1#f", "http://net/fr/", "http://xnet/fr/", "ftp://u@h.com:80/en/", "http://badexample.com/en/"]
    df = spark.createDataFrame([(i % 11, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")

    def want(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [(len(h + p), h + p, v) for h, p, v in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fit)[1:] if fit else (None, "allow")))

    for most in (100, 0):  # broadcast, and joined by a shuffle
        got = url_filters.judge_urls(df, rules, broadcast_rules=most).collect()
        assert sorted(((r.page_id, r.url or "", r.host, r.path, r.rule or "", r.verdict) for r in got)) == sorted((i % 11, u or "", *(x or "" for x in want(u))) for i, u in enumerate(urls))
    assert url_filters.judge_urls(df.limit(0), rules).count() == 0
    assert url_filters.judge_urls(df, rules.limit(0)).where("verdict = 'allow'").count() == len(urls)


def test_url_oracle(spark, oracle):
    assert rows_of(url_filters.op6_query(spark, SF).toPandas()) == rows_of(oracle(url_filters.op6_sql()))


# ---- WARC ----


def test_warc_round_trip(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (3, "a\nb", None), (4, "x", ""), (5, "y", "uniq\r\n\r\nWARC/1.0\r\n\r\n"), (6, "z", "日本"), (7, "z", "a" * 200_000), (None, "n", "null id"), (8, "r", "again"), (8, "r", "again")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.round_trip(df).collect()
    first = {}
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", p)
    want = []
    for p, u, h in rows:
        data, kind = (h or "").encode(), "response" if first[h or ""] == p else "revisit"
        want.append((f"<urn:page:{'null' if p is None else p}>", kind, (u or "").replace("\n", "%0A"), f"<urn:page:{first[h or '']}>" if kind == "revisit" else "", "sha1:" + warc.payload_sha1(data), len(data), data if kind == "response" else b""))
    assert sorted((r.record_id, r.record_type, r.uri or "", r.refers_to or "", r.digest, r.payload_bytes, bytes(r.payload or b"")) for r in got) == sorted(want)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_normaliser_takes_members_cut_anywhere(tmp_path):
    import gzip

    record = lambda i, body: f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <{i}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    bodies = [b"", b"x" * 3_000_000, b"WARC/1.1\r\n\r\n", bytes(range(256)) * 50]
    whole = b"".join(record(i, b) for i, b in enumerate(bodies))
    for cuts in ([], [10], [1, 5000, 2_000_000]):
        parts = [whole[a:z] for a, z in zip([0, *cuts], [*cuts, len(whole)], strict=True)]
        (tmp_path / "in.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
        index = warc.normalise_file(str(tmp_path / "in.gz"), str(tmp_path / "out.warc.gz"))
        out = (tmp_path / "out.warc.gz").read_bytes()
        assert gzip.decompress(out) == whole
        assert [gzip.decompress(out[o : o + n]) for _, o, n, _, _ in index] == [record(i, b) for i, b in enumerate(bodies)]
        assert (tmp_path / "out.warc.gz.idx").read_text().count("\n") == len(bodies)
    (tmp_path / "in.gz").write_bytes(gzip.compress(whole)[:-2000])
    with pytest.raises((EOFError, ValueError)):
        warc.normalise_file(str(tmp_path / "in.gz"), str(tmp_path / "bad.warc.gz"))
    assert not (tmp_path / "bad.warc.gz").exists()


# ---- line dedup ----


def test_line_dedup(spark):
    r = random.Random(1)
    base = ["alpha beta gamma delta epsilon zeta", "the quick brown fox jumps over it", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa bb", "ab ab ab ab ab ab ab ab ab ab ab", "0123456789012345", "日本語の行は二十文字より長いことが必要です。はい"]
    rows = [(900, None), (901, ""), (902, "\n\n"), (903, "short\nshort")]
    for i in range(80):
        lines = []
        for _ in range(5):
            s = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                p, op = r.randrange(len(s)), r.random()
                if op < 0.33:
                    s[p] = r.choice("abz")
                elif op < 0.66:
                    del s[p]
                else:
                    s.insert(p, r.choice("abz"))
            lines.append(r.choice(["", "  ", "\t"]) + "".join(s))
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, n_lines int")
    for least in (15, 20):
        out = line_dedup.dedup_lines(df, least_chars=least)
        assert out.columns == ["doc_id", "text", "n_lines", "_n_lines", "n_dropped"]
        assert {x.doc_id: x.text for x in out.collect()} == brute.dedup_lines(rows, least)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_of_repeated_rows(spark):
    line = "a line that is long enough to be compared"
    df = spark.createDataFrame([(1, line), (1, line), (2, line + "\nother"), (None, line)], DOCS)
    got = sorted((x.doc_id or -1, x.text) for x in line_dedup.dedup_lines(df).collect())
    assert got == [(-1, ""), (1, line), (1, line), (2, "other")]


def test_line_dedup_of_short_lines(spark):
    r = random.Random(3)
    long = "a line that is long enough to be compared"
    pool = ["}", "Read more", "Read  more ", "Read mare", "", "  ", "日本", "nineteen characters", "nineteen character", "twenty characters ok", long, long + "!"]
    rows = [(900, None), *((i, "\n".join(r.choices(pool, k=4))) for i in range(20))]
    df = spark.createDataFrame(rows, DOCS)
    got = {x.doc_id: x.text for x in line_dedup.dedup_lines(df, exact_short=True).collect()}
    assert got == brute.dedup_lines(rows, 20, exact_short=True)


# ---- mixing ----


def test_targets(spark):
    r = random.Random(5)
    for _ in range(6):
        sizes = {(f"s{i}" if i else None): r.choice([0, 1, 5, 100, 1000, 50000]) for i in range(r.randint(1, 9))}
        got = {x.source: x.target for x in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        assert got == pytest.approx(brute.targets(sizes))


def test_mix(spark, oracle):
    r = random.Random(8)
    rows = [(i, " ".join(words(r.randint(0, 30), i)), r.choice(["a", "b", "é", None, "Z"])) for i in range(300)] + [(7, None, "a"), (None, "x y", "b"), (7, "x y", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).toPandas()
    assert len(out) == len(rows) and (out.taken <= 3 * out["size"]).all() and (out.taken >= 0).all()
    by = out.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (by.taken == np.floor(by.target)).all()
    assert rows_of(out) == rows_of(mixing.mix(df.orderBy(F.rand(2))).toPandas())
    assert mixing.mix(df.limit(0)).count() == 0
    assert rows_of(mixing.op9_query(spark, SF).toPandas()) == rows_of(oracle(mixing.op9_sql()))


# ---- HTML ----

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a><li><a href=/x>X</a></ul></nav><div class="ad banner">Buy now</div><div id="cookie-notice">We use cookies, a lot of them, to make this better.</div>
<header><h1>Site</h1></header>{article}<aside>More of this</aside><section class="comments"><p>First! {long}</p></section><form>Name <input></form><footer>&copy; me</footer></body></html>"""
LONG = "words that go on and on, with commas, and more words after them. " * 5


def test_html_text():
    article = f"<article><header><h1>A &amp; B</h1></header><p>One&nbsp; two<br>three\n four<p><b>{LONG}<br><p>end &#233;</article>"
    got = html_text.extract(PAGE.format(article=article, long=LONG * 3))
    assert got == f"A & B\nOne two three four\n{LONG.strip()}\nend é"
    plain = f"<div id=main><div><p>{LONG}</p><p>{LONG}</p></div></div>"
    assert html_text.extract(PAGE.format(article=plain, long="x")) == "\n".join([LONG.strip()] * 2)


@pytest.mark.parametrize("html", [None, "", "<", "<>", "</p>", "<p", "<!-- x", "<script>x", "<a href='", "<p don't>a</p>", "<table><tr><td>a<tr><td>b</table>", "<b><i></b></i>", "&#xFFFFFFFF; &nosuch;", "<p>" * 3000, "<div>" * 3000 + "deep", "\x00"])
def test_html_never_fails(html):
    assert isinstance(html_text.extract(html), str)


def test_html_small_cases():
    assert html_text.extract("<p don't>a</p><p>b") == "a\nb"
    assert html_text.extract("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"
    assert html_text.extract("plain &lt;text") == "plain <text"
    assert html_text.extract("<ul><li>1<li>2</ul>3") == "1\n2\n3"


def test_html_over_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = html_text.extract_pages(pages.withColumn("text", F.lit(1))).toPandas().merge(pages.toPandas(), on="page_id")
    assert len(out) == pages.count()
    for r in out.itertuples():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1|div|ul|li)>", body)]
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_digest_of_a_payload(spark):
    df = spark.createDataFrame([("",), ("abc",), ("日本" * 50,)], "t string")
    got = [r[0] for r in df.select(warc.base32_sha1(F.col("t").cast("binary"))).collect()]
    assert got == [warc.payload_sha1(t.encode()) for t in ["", "abc", "日本" * 50]]
    assert hashlib.sha1(b"").hexdigest()[:4] == "da39"


def test_html_layouts():
    two = f"<body><article><p>Short.</p></article><article><p>{LONG}</p></article></body>"
    assert html_text.extract(two) == f"Short.\n{LONG.strip()}"
    sections = f"<body><div role='navigation'>nav</div><section><h2>H</h2><p>{LONG}</p></section><section><h2>I</h2><p>{LONG}</p></section></body>"
    assert html_text.extract(sections) == f"H\n{LONG.strip()}\nI\n{LONG.strip()}"
    links = f"<body><div class=top><a href=1>Home</a> <a href=2>News</a></div><div id=content><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><div><ul><li><a href=1>one</a></ul></div></body>"
    assert html_text.extract(links) == f"T\n{LONG.strip()}\n{LONG.strip()}"
    own = f"<body><article><div class='article-header'><h1>T</h1></div><p>{LONG}</p><div class='share'>Tweet</div></article><div id=comments><p>{LONG * 9}</p></div></body>"
    assert html_text.extract(own) == f"T\n{LONG.strip()}"


def test_html_articles_split_over_elements():
    text = [f"{i} {LONG.strip()}" for i in range(10)]
    p = "".join
    split = f"<body><div class=top><a href=1>Home</a></div><div id=content><h1>T</h1><div class=lead>{p(f'<p>{x}</p>' for x in text[:3])}</div><ul><li><a href=2>two</a></ul><div class=text>{p(f'<p>{x}</p>' for x in text[3:])}</div>End.</div></body>"
    assert html_text.extract(split) == "\n".join(["T", *text, "End."])
    deep = f"<body><div><h2>Head</h2><div><div>{p(f'<p>{x}</p>' for x in text)}</div></div><span>Short.</span></div><div><a href=1>one</a> <a href=2>two</a></div></body>"
    assert html_text.extract(deep) == "\n".join(["Head", *text, "Short."])


@pytest.mark.parametrize("start, end", [("<div class='content no-sidebar'>", "</div>"), ("<div class='site has-sidebar'><article>", "</article></div>"), ("<div id=content-sidebar-wrap>", "</div>"), ("<form action=/><div>", "</div></form>"), ("<div class=sidebar><main>", "</main></div>"), ("<div class='related-work'>", "</div>"), ("<div class='social-science'>", "</div>")])
def test_html_wrappers_named_like_boilerplate(start, end):
    page = f"<body><nav><a href=/>Home</a></nav>{start}<p title='the hidden cost'>{LONG}</p><p>{LONG}</p>{end}<div class='site-footer'>Us</div><div class='ad-slot-2'>Buy</div><div hidden=''>gone</div><p HIDDEN>gone</p></body>"
    assert html_text.extract(page) == "\n".join([LONG.strip()] * 2)


def test_html_text_that_is_not_boilerplate():
    page = f"<body><div><p>{LONG}</p><p>Let <math><mi>x</mi></math> be <label>one</label></p><xmp>a &lt; <b></xmp><object>fall back</object></div><div class='comments-area'><article><p>{LONG * 3}</p></article></div></body>"
    assert html_text.extract(page) == f"{LONG.strip()}\nLet x be one\na &lt; <b>\nfall back"


def densities(node, whole=None):
    """The composite density of every element by its definition, each counted from scratch."""
    def parts(n):
        """(characters, those in links, tags, link tags) below n"""
        c = lc = t = lt = 0
        for k in n.kids:
            if isinstance(k, str):
                c += len(re.sub(r"\s", "", k))
            elif k.cut != html_text.HARD:
                x = parts(k)
                c, lc, t, lt = c + x[0], lc + x[1], t + x[2] + 1, lt + x[3] + (k.tag == "a")
        return c, c if n.tag == "a" else lc, t, lt

    whole = whole or parts(next((n for n in html_text._walk(node) if n.tag == "body"), node))
    c, lc, t, lt = parts(node)
    d = 0.0
    if c:
        t, lt1, lc1 = max(1, t), max(1, lt), max(1, lc)
        d = c / t * np.log(max(c / lc1 * t / lt1, 1) + 1) / np.log(c / max(1, c - lc) * lc + whole[1] / whole[0] * c + np.e)
    return [max(0.0, d)] + [x for k in node.kids if not isinstance(k, str) and k.cut != html_text.HARD for x in densities(k, whole)]


def test_html_densities_by_definition():
    r = random.Random(11)
    for _ in range(60):
        page = "<body>" + "".join(r.choice(["<div>", "</div>", "<p>", "<a href=x>", "</a>", "<ul><li>", "</ul>", "<b>", "</b>", "some words ", LONG, "<script>x</script>", "<section>", "</section>"]) for _ in range(40))
        root = html_text.parse(page)
        assert [n.density for n in html_text.measure(root)] == pytest.approx(densities(root))


def cut_body(page):
    """The text of the whole page less what its names mark."""
    root = html_text.parse(page)
    for n in html_text._walk(root):
        n.cut = n.cut or 0
    return html_text.text_of(next(n for n in html_text._walk(root) if n.tag == "body"))


def test_html_density_decides_without_any_names():
    nav = "<div><ul>" + "".join(f"<li><a href=/{i}>Section {i}</a></li>" for i in range(9)) + "</ul></div>"
    text = "".join(f"<p>{i} {LONG}</p>" for i in range(4))
    page = f"<body>{nav}<div>Buy one, get two.</div><div><h1>Title</h1>{text}</div><div>&copy; a company</div></body>"
    want = "\n".join(["Title", *(f"{i} {LONG.strip()}" for i in range(4))])
    assert html_text.extract(page) == want != cut_body(page)
    wrapped = f"<body><div><div>{nav}</div><div><div>{text}</div><div>Buy one, get two.</div></div></div></body>"
    assert html_text.extract(wrapped) == want.removeprefix("Title\n") != cut_body(wrapped)


def test_html_density_decides_on_the_test_pages(spark):
    """Articles in a div, and no element or class that marks boilerplate: those well over ten times as long as the blocks beside them are found exactly."""
    long = 0
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        want = html_text.extract(r.html)
        page = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", r.html).replace('class="ad"', 'class="x"')
        if len(want) > 1500:
            long += 1
            assert html_text.extract(page) == want
    assert long > 10, long


def test_html_names_are_a_feature_only():
    body = lambda x: html_text.extract(f"<body><article><p>{LONG}</p>{x}<p>{LONG}</p></article></body>").split("\n")[1:-1]
    keep = ["<p class='market share'>kept</p>", "<p class='related work'>kept</p>", "<section id='notice-of-rights'>kept</section>", "<p title='the hidden valley'>kept</p>", "<p data-x='a>b hidden'>kept</p>", "<h2 class=share>kept</h2>"]
    assert [body(x) for x in keep] == [["kept"]] * len(keep)
    assert body(f"<div class='market share'><p>{LONG}</p></div>") == [LONG.strip()]
    gone = ["<div class=share>Tweet</div>", "<div hidden=''>gone</div>", "<div hidden>gone</div>", "<div class='widget xyz'>few words</div>", "<div style='display: none'>gone</div>", "<div role=navigation>gone</div>"]
    assert [body(x) for x in gone] == [[]] * len(gone)


@pytest.mark.parametrize("part", ["<div>", "<p>", "<b>", "<p><button>", "<table><tr><td>", "<b><table>", "<li>", "<div class=x>a<a href=y>"])
def test_html_deep_pages_take_linear_time(part):
    import time

    began = time.process_time()
    assert "deep" in html_text.extract("<body>" + part * 100_000 + "deep" + "</b></p></i></div>" * 100_000) or "button" in part
    assert time.process_time() - began < 60


def test_word_pieces():
    from sightline.llm.common import word_pieces

    r = random.Random(1)
    for _ in range(200):
        data = "".join(r.choices("ab é \t\n\x0b\x0c\r\x85 ", k=r.randint(0, 60))).encode()
        for size in (1, 7, 100):
            assert [w for p in word_pieces(data, size) for w in p] == [m.encode() for m in re.findall(r"[^\x20\x09-\x0D]+", data.decode())]


def test_cells_of_long_texts_in_chunks(monkeypatch):
    data = np.frombuffer("".join(random.Random(2).choices("abcd ", k=5000)).encode(), np.uint8)

    def windows(parts):
        gram, cell, first, last, anchor = parts
        return {(s, g, a) for g, x, z, a in zip(gram.tolist(), first.tolist(), last.tolist(), anchor.tolist(), strict=True) for s in range(x, z + 1)}

    whole = windows(suffix_dedup.cells(data, 100))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    assert windows(suffix_dedup.cells(data, 100)) == whole and len(whole) == 4901


def test_clashing_names(spark, tokenizer):
    clash = ["_held", "_version", "_key", "_gone", "_text", "_digest", "_content", "n_tokens", "_row", "_host", "_url", "digest", "n_lines", "_d"]
    line = "a line that is long enough to be compared"
    df = spark.createDataFrame([(1, line, *clash), (2, line, *clash)], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in clash))
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "_n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r._row) for r in out.collect()) == [(1, line, "_row"), (2, "", "_row")]
    counted = token_counts.count_tokens(df, tokenizer[0]).collect()
    assert {r.doc_id: r.n_tokens for r in counted} == dict.fromkeys((1, 2), tokenizer[1](line)) and counted[0]._held == "_held"
    pages = df.withColumnsRenamed({"doc_id": "page_id", "text": "url"}).withColumn("url", F.lit("http://x.net/fr/1"))
    judged = url_filters.judge_urls(pages, spark.createDataFrame(url_filters.RULES, "host string, path string, verdict string")).collect()
    assert [(r.rule, r._host) for r in judged] == [("net/fr/", "_host")] * 2
