"""Dictionary-compressed WARC archives, written and read by Spark.

Every record is a Zstandard frame of its own, compressed with a dictionary
trained on archived records; the dictionary stands in a skippable frame at the
start of each archive.  Archives are written through Spark's text writer, so
any store and its commit protocol serve: a row is a frame, and the line
separator is an empty skippable frame, which Zstandard readers pass over.

Records with equal payloads: the one with the smallest page id is a response,
the others are revisits that refer to it.  Only ids and digests are grouped,
with a map-side minimum; whole pages are shuffled once, by id and digest, so
a payload with a third of all rows lands in no single task.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.scratch import cut

#: Magic numbers of Zstandard frames, of skippable frames, and of the one with the dictionary.
FRAME, SKIPPABLE, DICTIONARY = 0xFD2FB528, 0x184D2A50, 0x184D2A5D
#: An empty skippable frame, which is all ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE, 0).decode("ascii")
#: Profile of revisits, and the date of all records (pages carry none).
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

#: Records, their largest size and the dictionary's size in training; bytes of payload in an archive.
TRAIN_RECORDS, TRAIN_BYTES, DICT_BYTES = 600, 32 << 10, 64 << 10
ARCHIVE_BYTES = 8 << 20
LEVEL = 6
SALTS = 32
LAST_ID = (1 << 63) - 1


def digest_text(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    name = uri[len("<urn:page:"):-1]
    return None if name == "null" else int(name)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; revisits keep the HTTP header but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest_text(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """Header fields (lower-case names), HTTP header fields under ``http`` and the payload."""
    def fields(raw: bytes) -> dict:
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in raw.decode().split("\r\n")[1:])}

    head, _, rest = record.partition(b"\r\n\r\n")
    out = fields(head)
    block = rest[:int(out["content-length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record does not end as its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return out | {"http": fields(http), "payload": payload}


def train(records: list[bytes]) -> bytes:
    """A dictionary from sample records; raw content where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, records, k=512, d=8, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICT_BYTES]


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one by one."""
    view, at, dictionary = memoryview(archive), 0, None
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            if magic == DICTIONARY:
                dictionary = zstandard.ZstdCompressionDict(bytes(view[at + 8:at + 8 + size]))
            at += 8 + size
            continue
        if magic != FRAME:
            raise ValueError(f"no frame at byte {at}")
        reader = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts, step = [], 1 << 14
        while not reader.eof:
            if at >= len(view):
                raise ValueError("an archive ends within a frame")
            chunk = view[at:at + step]
            parts.append(reader.decompress(chunk))
            at += len(chunk) - len(reader.unused_data)
            step = min(step * 4, 1 << 22)
        yield b"".join(parts)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per row of ``pages`` (``page_id, url, html``) to new archives under ``path``.

    The payload is the html in UTF-8, NULL as empty.  Of equal payloads of at
    least ``min_bytes`` bytes one is a response: that with the smallest id (no
    id comes last), of repeated rows the first.  Other columns are ignored; an
    empty table gives no record.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "page_id", F.coalesce("page_id", F.lit(LAST_ID)).alias("key"), "url", "html", F.sha1("html").alias("digest"))
    size = F.octet_length("html")
    whole = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    archives = max(1, math.ceil(whole["bytes"] / ARCHIVE_BYTES))

    share = min(1.0, TRAIN_RECORDS / max(1, whole["n"]))  # of the range of a hash of the page
    sample = rows.filter((size <= TRAIN_BYTES) & (F.xxhash64("key", "digest").cast("double") <= (share * 2 - 1) * 2.0**63))
    picked = sorted((r.key, r.url or "", r.html) for r in sample.select("key", "url", "html").collect())
    dictionary = train([build_record(k, u, h.encode(), None, False) for k, u, h in picked])

    narrow = rows.select("key", "digest", size.alias("size")).filter(F.col("size") >= min_bytes)
    firsts = narrow.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    placed = (
        narrow.select("key", "digest", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(firsts, ["digest", "salt"]).select("key", "digest", "first").distinct()
    )
    # repeated rows lie together, so that the first of them can be told from the others
    dealt = rows.repartition(archives, "key", "digest").sortWithinPartitions("key", "digest")
    joined = dealt.join(placed, ["key", "digest"], "left").select(
        "page_id", "key", "url", "html", "digest", "first")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if trained:
            trained.precompute_compress(level=LEVEL)
        compressor, started, before = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained), False, None
        for batch in batches:
            out = []
            if not started and dictionary:
                out.append(struct.pack("<II", DICTIONARY, len(dictionary)) + dictionary)
            started = True
            for page_id, key, url, html, digest, first in zip(*(batch.column(i) for i in range(6))):
                row = (key.as_py(), digest.as_py())
                first = first.as_py()
                revisit = first is not None and (first != row[0] or row == before)
                before = row
                refers = None if first in (None, LAST_ID) else first
                out.append(compressor.compress(build_record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers, revisit)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    made = joined.mapInArrow(compress, "frame binary").select(F.col("frame").cast("string").alias("value"))
    made.write.option("lineSep", SEPARATOR).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: ``page_id, url, record_type,
    payload_bytes, payload_digest, refers_to, payload`` (NULL for revisits).

    Lengths and digests of responses are taken from the payloads that were
    read, those of revisits from their headers.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for raw in frames(content.as_py()):
                    r = parse_record(raw)
                    page, url = page_of(r["warc-record-id"]), r["warc-target-uri"]
                    if r["warc-type"] == "response":
                        payload = r["payload"]
                        rows.append((page, url, "response", len(payload), digest_text(payload), None, payload))
                        held += len(payload)
                    else:
                        rows.append((page, url, "revisit", int(r["http"]["content-length"]),
                                     r["warc-payload-digest"].removeprefix("sha1:"), page_of(r["warc-refers-to"]), None))
                    if held > 4 << 20 or len(rows) >= 5000:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(
        records, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def op4_warc(spark, sf_dir: str) -> DataFrame:
    """Writes archives under the shared scratch folder, reads them back into a
    checkpoint of the contract's columns, and removes the archives."""
    from marginlens.plans.session import shared_scratch

    path = shared_scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    read = cut(read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return read
