"""Token counts through a digest cache.

Each text is reduced to a normalised content that provably has the same token count, and to that
content's digest. Counts stored under (tokenizer digest, content digest) are joined; only distinct
contents that the cache lacks are encoded, and their counts are appended to it.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CHARS, drop_at_end, fresh_path, slices, stash, word_pieces

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: The session's setting that names a cache folder on the shared store, which then outlives the run.
CACHE_SETTING = "spark.sightline.tokenCache"
#: Words whose counts a Python worker remembers; the memo is emptied beyond this.
MEMO_WORDS = 400_000


def space_insensitive(tokenizer_json: bytes) -> bool:
    """Whether white space only separates pieces for this tokenizer: every run becomes one space,
    and the pre-tokenizer then drops it. Only then may contents differ in white space and the
    words of a text be counted one by one."""
    spec = json.loads(tokenizer_json)
    steps = spec.get("normalizer") or {}
    steps = steps.get("normalizers", [steps])
    collapses = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"} and s.get("content") == " " for s in steps)
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and first.get("pattern", {}).get("Regex", "").endswith("|[^\\s\\p{L}\\p{N}]+")
    plain = all(not t.get("lstrip") and not t.get("rstrip") and not any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", []))
    return collapses and drops and plain


def normalised(text: Column, insensitive: bool) -> Column:
    text = F.coalesce(text, F.lit(""))
    if not insensitive:
        return text
    return F.regexp_replace(F.btrim(text, F.lit(SPACE_CHARS)), SPACE, " ")


def _counter(spec: bytes, insensitive: bool):
    """A function from a list of contents to their token counts."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec.decode())
    tok.no_truncation()
    tok.no_padding()
    encode = getattr(tok, "encode_batch_fast", tok.encode_batch)
    memo: dict[bytes, int] = {}

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in encode(texts, add_special_tokens=False)]

    def by_word(texts: list[str]) -> list[int]:
        nonlocal memo
        out = []
        for text in texts:
            n = 0
            for words in word_pieces(text.encode()):
                new = [w for w in set(words) if w not in memo]
                for i in range(0, len(new), 20_000):
                    part = new[i : i + 20_000]
                    memo.update(zip(part, whole([w.decode() for w in part]), strict=True))
                n += sum(map(memo.__getitem__, words))
            out.append(n)
            if len(memo) > MEMO_WORDS:
                memo = {}
        return out

    return by_word if insensitive else whole


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``: the tokens of each whole text, without special tokens added, and
    ``cached``: whether the count was stored before this call.

    tokenizer_path: a ``tokenizers`` JSON file, read on the driver and sent with the tasks.
    cache_path: a Parquet folder of CACHE_SCHEMA that is read and appended to, and kept; if None the
    one that the session names under CACHE_SETTING, and if it names none a new one in the work folder,
    which is removed at the end. A null text counts as empty. Other columns stay as they are, but for
    n_bytes, n_tokens and cached, which are replaced; rows that repeat get the same count. A count
    that is appended twice by a doubled run does no harm: the cache is read distinct.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        spec = f.read()
    version, insensitive = hashlib.sha256(spec).hexdigest(), space_insensitive(spec)
    cache_path = cache_path or spark.conf.get(CACHE_SETTING, None)
    own = not cache_path
    cache_path = cache_path or fresh_path(spark, "token-cache")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)  # the folder exists from here on
    if own:
        drop_at_end(spark, cache_path)
    stored = lambda: spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == version).groupBy(F.col("digest").alias("_digest")).agg(F.max("n_tokens").alias("n_tokens"))

    digest = F.unhex(F.sha2(F.col("_content").cast("binary"), 256)).alias("_digest")
    contents = docs.select(normalised(F.col(text_col), insensitive).alias("_content")).select("_content", digest)
    known = stash(stored(), "known-tokens")  # written, as the cache grows below
    cold = known.isEmpty()
    misses = contents if cold else contents.join(known, "_digest", "left_anti")
    misses = misses.dropDuplicates(["_digest"])  # combined before the shuffle: a hot content leaves each task once
    shared = spark.sparkContext.broadcast(spec)  # one tokenizer file

    def encode(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        count = _counter(shared.value, insensitive)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([version] * b.num_rows, pa.string()), b.column("_digest"), pa.array(count(b.column("_content").to_pylist()), pa.int64())], names=["tokenizer", "digest", "n_tokens"])

    misses.select("_digest", "_content").mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    # other columns travel in one struct, so that no name of theirs can clash with those used here
    keep = [c for c in docs.columns if c != text_col and c.lower() not in ("n_bytes", "n_tokens", "cached")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.struct(F.lit(0).alias("_"), *[f"`{c}`" for c in keep]).alias("_held"), F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.sha2(normalised(F.col(text_col), insensitive).cast("binary"), 256)).alias("_digest"))
    # written, so that the join has a plain exchange on both sides and a hot content can be split
    before = known.select("_digest", F.lit(True).alias("_before"))
    counts = stored() if cold else stored().join(before, "_digest", "left")
    counts = stash(counts.select("_digest", "n_tokens", (F.lit(False) if cold else F.col("_before").isNotNull()).alias("cached")), "token-counts")
    return keyed.join(counts, "_digest", "left").select(*[F.col("_held").getField(c).alias(c) for c in keep], "n_bytes", "n_tokens", "cached")


def op1_query(spark, sf_dir, vocabulary: str = "word_bpe_49k.json", limit: int = 2048) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = count_tokens(docs, public_tokenizers.path(vocabulary))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "cached")
