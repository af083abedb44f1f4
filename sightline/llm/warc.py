"""WARC archives: writing, normalising monolithic gzip files, and reading by offset.

Archives are written as one gzip stream a file (Spark's text writer, so any file system will do).
The normaliser inflates each such stream once, front to back, in pieces of bounded size, rewrites
every record as a gzip member of its own, and writes a sidecar index of offsets; records can then
be read at random.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_at_end, fresh_path, open_input, stash, write_atomically

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: RFC 4648
#: Duplicate digests beyond this number are joined by a shuffle, not broadcast. A row is under 0.1 KB.
BROADCAST_DUPLICATES = 200_000
PIECE = 1 << 20
EPOCH = "1970-01-01T00:00:00Z"  # records carry no time of their own here; reruns agree
INDEX_SCHEMA = "archive string, offset long, length long, record_id string, record_type string"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the payload's SHA-1."""
    parts = []
    for i in range(4):
        bits = F.conv(F.substring(F.sha1(payload), 1 + 10 * i, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(BASE32), (F.shiftright(bits, 35 - 5 * k).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for k in range(8)]
    return F.concat(*parts)


def decide_revisits(pages: DataFrame, id_col: str, payload: Column, least_bytes: int = 0) -> DataFrame:
    """``pages`` with _bytes, _digest and _first: of records with equal payloads of at least
    ``least_bytes`` bytes, the smallest id (null for records that stand alone or are smaller).

    Only digests that occur twice are kept for the join, after a combined aggregate; they are
    broadcast up to BROADCAST_DUPLICATES, and beyond that joined by a shuffle.
    """
    binary = payload.cast("binary")
    measured = pages.withColumns({"_bytes": F.octet_length(payload).cast("long"), "_digest": base32_sha1(binary)})
    pairs = measured.where(F.col("_bytes") >= least_bytes).groupBy("_digest").agg(F.min(id_col).alias("_first"), F.count("*").alias("_n"))
    twice = stash(pairs.where("_n > 1").select(F.col("_digest").alias("_d"), "_first"), "warc-twice")
    side = F.broadcast(twice) if twice.count() <= BROADCAST_DUPLICATES else twice
    return measured.join(side, (F.col("_digest") == F.col("_d")) & (F.col("_bytes") >= least_bytes), "left").drop("_d")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> None:
    """Write one record per row to monolithic gzip files under ``path``: a response, or a revisit
    (headers without payload) of the response with the smallest id. Line ends in URLs are escaped."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    d = decide_revisits(pages.select(id_col, url_col, payload_col), id_col, payload, least_bytes)
    revisit = F.coalesce(F.col("_first") != F.col(id_col), F.lit(False))
    rid = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    uri = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, payload))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", rid(F.col(id_col))), line("WARC-Date", F.lit(EPOCH)),
        F.when(uri != "", line("WARC-Target-URI", uri)).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", rid(F.col("_first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    # the writer ends each row with lineSep, which is what ends a WARC record
    d.select(F.concat(head, block).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


class _Inflated:
    """Reads through gzip members of a file as one stream, holding one piece at a time."""

    def __init__(self, file):
        self.file, self.z, self.buffer, self.over = file, zlib.decompressobj(31), bytearray(), False

    def more(self) -> bool:
        while not self.over:
            data = self.z.unconsumed_tail or self.z.unused_data or self.file.read(PIECE)
            if self.z.eof:
                data = data.lstrip(b"\0") or self.file.read(PIECE)
                if data:
                    self.z = zlib.decompressobj(31)
            if not data:
                self.over = True
                if not self.z.eof and self.z.unconsumed_tail == b"" and self.started:
                    raise EOFError("the gzip stream is cut off")
                break
            self.started = True
            out = self.z.decompress(data, PIECE)
            if out:
                self.buffer += out
                return True
        return False

    started = False

    def until(self, mark: bytes, at: int = 0) -> int:
        """The place of ``mark`` in the buffer, which grows as needed; -1 at the end."""
        while (i := self.buffer.find(mark, at)) < 0:
            at = max(at, len(self.buffer) - len(mark) + 1)
            if not self.more():
                return -1
        return i

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise EOFError("the archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def records_of(file):
    """(header bytes, block bytes) of each record of a gzip file, however its members are cut."""
    s = _Inflated(file)
    while True:
        while (s.buffer or s.more()) and s.buffer[:1] in (b"\r", b"\n"):
            del s.buffer[:1]
        if not s.buffer and not s.more():
            return
        end = s.until(b"\r\n\r\n")
        if end < 0:
            raise ValueError("a record's header does not end")
        head = s.take(end + 4)
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        yield head, s.take(int(header(head, "Content-Length") or 0))


def header(head: bytes, name: str) -> str | None:
    m = re.search(rf"^{re.escape(name)}:[ \t]*(.*?)[ \t]*\r?$".encode(), head, re.I | re.M)
    return m[1].decode("utf-8", "replace") if m else None


def normalise_file(source: str, target: str) -> list[tuple]:
    """Rewrite one archive with a gzip member per record, beside it ``target``.idx with lines of
    offset, length, record id and type; returns the index rows."""
    index: list[tuple] = []

    def fill(out):
        offset = 0
        with open_input(source) as f:
            for head, block in records_of(f):
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = z.compress(head) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()
                out.write(member)
                index.append((target, offset, len(member), header(head, "WARC-Record-ID"), header(head, "WARC-Type")))
                offset += len(member)

    write_atomically(target, fill)
    write_atomically(target + ".idx", lambda out: out.writelines(f"{o}\t{n}\t{rid or ''}\t{kind or ''}\n".encode() for _, o, n, rid, kind in index))
    return index


def _listed(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Files under ``path``: names only, one for each archive."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(ending))


def normalise(spark: SparkSession, source: str, target: str, ending: str = ".gz") -> DataFrame:
    """Normalise every archive under ``source`` into the folder ``target``, one task a file; returns
    the index (INDEX_SCHEMA). Files are replaced whole, so a task that is run twice does no harm."""
    files = _listed(spark, source, ending)
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(target)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                name = path.rsplit("/", 1)[1].removesuffix(".gz").removesuffix(".txt").removesuffix(".warc")
                rows = normalise_file(path, f"{target}/{name}.warc.gz")
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["archive", "offset", "length", "record_id", "record_type"])

    listed = spark.createDataFrame([(f,) for f in files], "path string")
    if files:
        listed = listed.repartition(len(files), "path") if len(files) < 2 else listed.repartitionByRange(len(files), "path")
    return stash(listed.mapInArrow(run, INDEX_SCHEMA), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """Read the records that an index lists, by offset: record_id, record_type, uri, refers_to,
    digest (as the header has it), payload_bytes (as the HTTP header has it), payload (null for revisits)."""
    schema = "record_id string, record_type string, uri string, refers_to string, digest string, payload_bytes long, payload binary"

    def run(batches):
        name, f = None, None
        for b in batches:
            held: list[tuple] = []
            weight = 0
            for archive, offset, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if archive != name:
                    if f is not None:
                        f.close()
                    name, f = archive, open_input(archive)
                f.seek(offset)
                data = zlib.decompress(f.read(length), 31)
                cut = data.index(b"\r\n\r\n") + 4
                head, block = data[:cut], data[cut : cut + int(header(data[:cut], "Content-Length"))]
                kind, at = header(head, "WARC-Type"), block.index(b"\r\n\r\n") + 4
                held.append((header(head, "WARC-Record-ID"), kind, header(head, "WARC-Target-URI"), header(head, "WARC-Refers-To"), header(head, "WARC-Payload-Digest"), int(header(block[:at], "Content-Length")), None if kind == "revisit" else block[at:]))
                weight += len(block)
                if weight > 8 * PIECE:
                    yield batch(held)
                    held, weight = [], 0
            yield batch(held)
        if f is not None:
            f.close()

    def batch(rows):
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return index.select("archive", "offset", "length").mapInArrow(run, schema)


def payload_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, normalise them and read all records back.

    Null payloads are empty, null URLs give no target URI, rows that repeat an id give a record
    each (equal payloads under the same id are all responses, as none refers to another id). An
    empty table gives no records.
    """
    spark = pages.sparkSession
    raw, whole = fresh_path(spark, "warc-raw"), fresh_path(spark, "warc")
    write_archives(pages, raw, id_col, url_col, payload_col, least_bytes)
    index = normalise(spark, raw, whole)
    drop_at_end(spark, raw), drop_at_end(spark, whole)
    return read_records(index)


def op7_query(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    r = round_trip(pages)
    # a response's digest is taken from the payload that was read, a revisit's from its header
    digest = F.when(F.col("record_type") == "response", base32_sha1(F.col("payload"))).otherwise(F.regexp_replace("digest", "^sha1:", ""))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return r.select(number(F.col("record_id")).alias("page_id"), size.alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number(F.col("refers_to")).alias("refers_to"))


def op7_sql() -> str:
    return f"""
with p as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
d as (
  select page_id, strlen(payload)::bigint as payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', (((('0x' || substr(h, (1 + 10 * (i // 8))::int, 10))::ubigint >> (35 - 5 * (i % 8))::ubigint) & 31) + 1)::int, 1)), '') as payload_digest,
         min(page_id) over (partition by payload) as first
  from p)
select page_id, payload_bytes, payload_digest, case when first = page_id then 'response' else 'revisit' end as record_type, case when first <> page_id then first end as refers_to from d
"""
