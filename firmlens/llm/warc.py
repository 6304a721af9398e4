"""WARC archives in Zstandard frames: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.common import get_file, materialize, new_folder, put_file, text_bytes

#: Fixed values of the archive format: the skippable frame that holds a dictionary, Zstandard's frame and dictionary magic numbers.
DICT_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
ZSTD_DICT_MAGIC = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads shorter than this are always stored.
MIN_REVISIT_BYTES = 100
#: Compressed bytes after which a file is closed.
FILE_BYTES = 16 << 20
#: The dictionary is trained on so many pages, of each so many characters; it only affects the size of the files.
DICT_PAGES, DICT_CHARS, DICT_BYTES = 400, 4096, 16 << 10

RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, error string"


# ---------------------------------------------------------------- records and files

def info(number: str, date: str) -> bytes:
    """The record that says how an archive was made."""
    block = b"software: firmlens\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:warcinfo:{number}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def record(page_id, url, digest: str, payload: bytes, refers_to, date: str, again: int | None = None) -> bytes:
    """One WARC/1.1 record. refers_to: None for a response; a revisit keeps the HTTP header but no payload. A record is
    named by page and digest; again tells repeated rows of one page and payload apart."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{digest[:32]}{'' if again is None else f':{again}'}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}:{digest[:32]}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(raw: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields (names in lower case) of a header block; ValueError where a line has no colon."""
    first, *lines = raw.decode("utf-8").split("\r\n")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"bad header line {line[:80]!r}")
        if name.strip().lower() in fields:
            raise ValueError(f"repeated header {name.strip()}")
        fields[name.strip().lower()] = value.strip()
    return first, fields


def _page(uri: str):
    m = re.fullmatch(r"<urn:page:(-?\d*):[0-9a-f]{32}(?::\d+)?>", uri)
    if not m:
        raise ValueError(f"bad record id {uri[:80]!r}")
    return int(m[1]) if m[1] else None


def parse(raw: bytes) -> dict:
    """A record's fields, after checks of version, required headers, lengths and, for a response, the payload's digest."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the WARC header")
    version, fields = headers(head)
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"bad version {version[:40]!r}")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit() or int(fields["content-length"]) + 4 != len(rest) or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("the block is not as long as Content-Length says")
    kind = fields["warc-type"]
    if kind == "warcinfo":
        return dict.fromkeys(f.split()[0] for f in RECORDS.split(", ")) | {"record_type": kind}
    if kind not in ("response", "revisit"):
        raise ValueError(f"unknown record type {kind[:40]!r}")
    http, gap, payload = rest[:-4].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no end of the HTTP header")
    status, inner = headers(http)
    length = inner.get("content-length", "")
    digest = fields.get("warc-payload-digest", "")
    if not status.startswith("HTTP/") or not length.isdigit() or not digest.startswith("sha256:"):
        raise ValueError("bad HTTP header or payload digest")
    if kind == "revisit":
        if payload or "warc-refers-to" not in fields or "warc-profile" not in fields:
            raise ValueError("a revisit has a payload, or does not say what it refers to")
    elif int(length) != len(payload) or hashlib.sha256(payload).hexdigest() != digest[7:]:
        raise ValueError("the payload is not what its length or digest says")
    return {
        "page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_digest": digest[7:], "payload_bytes": int(length),
        "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None, "error": None}


class ArchiveWriter:
    """Bytes of one archive: the dictionary's frame, then a frame for each record, first the archive's own."""

    def __init__(self, dictionary: bytes, level: int = 3, first: bytes | None = None):
        self.parts = [struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary] if dictionary else []
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True).compress
        if first is not None:
            self.parts.append(self.compress(first))
        self.size, self.records = sum(map(len, self.parts)), 0

    def add(self, raw: bytes) -> None:
        frame = self.compress(raw)
        self.parts.append(frame)
        self.size += len(frame)
        self.records += 1

    def bytes(self) -> bytes:
        return b"".join(self.parts)


def read_frames(body: bytes):
    """The records' bytes of an archive. The leading skippable frame, if any, is the dictionary, raw or itself compressed."""
    at, dictionary = 0, None
    if len(body) >= 8 and struct.unpack_from("<I", body)[0] == DICT_MAGIC:
        at = 8 + struct.unpack_from("<I", body, 4)[0]
        if at > len(body):
            raise ValueError("the dictionary's frame is cut short")
        raw = body[8:at]
        if raw[:4] == ZSTD_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=1 << 27)
        dictionary = zstandard.ZstdCompressionDict(raw)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    step = 1 << 14
    while at < len(body):
        if 0x184D2A50 <= struct.unpack_from("<I", body.ljust(at + 4, b"\0"), at)[0] <= 0x184D2A5F:  # a skippable frame between records
            at += 8 + struct.unpack_from("<I", body, at + 4)[0]
            continue
        one, out = reader.decompressobj(), []
        while not one.eof:
            if at >= len(body):
                raise ValueError("the last frame is cut short")
            piece = body[at : at + step]
            out.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(out)


# ---------------------------------------------------------------- tables

def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample of pages; a plain prefix of a record where there is too little to train on."""
    rows = pages.where(F.length("html") > 0).select(F.left("html", F.lit(DICT_CHARS)).alias("html")).limit(DICT_PAGES).collect()
    samples = [record(i, "http://www.example.com/", "0" * 64, r["html"].encode(), None, "2000-01-01T00:00:00Z") for i, r in enumerate(rows)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return record(0, "http://www.example.com/", "0" * 64, b"<!DOCTYPE html><html><head><title></title></head><body></body></html>", None, "2000-01-01T00:00:00Z")


def write_archives(pages: DataFrame, folder: str, *, date: str = "2000-01-01T00:00:00Z", min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write pages(page_id, url, html) as archives in folder; a written table of (file, records, bytes).

    Of pages with equal payloads of at least min_revisit_bytes, those with the smallest page_id are responses, the
    others revisits of it. Only digests are grouped; a digest that many pages share is a skewed plain join, which
    adaptive execution splits. Null html: empty; null page_id: larger than all; equal page_id: each a record; no url:
    no target header. A file is named by its content and put in place whole, so that a repeated task does no harm;
    readers take the files of the returned table only. Record ids are made of page and digest, of rows equal in both with
    a running number. Pages of any length are one record. An empty table gives no file; further columns are not read.
    """
    digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    dictionary = train_dictionary(pages)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    firsts = pages.where(F.octet_length("html") >= min_revisit_bytes).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = firsts.where((F.col("copies") > 1) & F.col("first").isNotNull()).select(F.col("digest").alias("_digest"), "first")
    # rows of one page and payload (there are mostly none): all but the first get a number of their own
    same = pages.groupBy(F.col("page_id").alias("_page"), F.col("digest").alias("_same")).agg(F.min("row").alias("lowest"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    same = materialize(same, "repeated-pages")
    ready = pages.join(firsts, F.col("digest") == F.col("_digest"), "left")
    if same.head(1):
        ready = ready.join(same, (F.col("digest") == F.col("_same")) & F.col("page_id").eqNullSafe(F.col("_page")), "left").withColumn("again", F.when(F.col("row") > F.col("lowest"), F.col("row")))
    else:
        ready = ready.withColumn("again", F.lit(None).cast("long"))
    ready = ready.select("page_id", "url", "html", "digest", "again", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")).alias("refers_to"))

    def write(frames):
        part, seq = TaskContext.get().partitionId(), 0
        start = lambda: ArchiveWriter(dictionary, first=info(f"{part}-{seq}", date))
        archive = start()

        def close():
            body = archive.bytes()
            name = hashlib.sha256(body).hexdigest()[:32] + ".warc.zst"
            put_file(folder, name, body)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([archive.records], pa.int64()), pa.array([len(body)], pa.int64())], names=["file", "records", "bytes"])

        for frame in frames:
            body, at = text_bytes(frame.column(2))
            view = body.tobytes()
            ids, urls, digests, again, refs = (frame.column(i).to_pylist() for i in (0, 1, 3, 4, 5))
            for i in range(frame.num_rows):
                archive.add(record(ids[i], urls[i], digests[i], view[at[i] : at[i + 1]], refs[i], date, again[i]))
                if archive.size >= FILE_BYTES:
                    yield close()
                    seq += 1
                    archive = start()
        if archive.records:
            yield close()

    return materialize(ready.mapInArrow(write, "file string, records long, bytes long"), "warc-files")


def read_archives(files: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """The records of an archive table's files, but for those about the archives. A record that fails a check comes with
    `error` and null fields. An empty table gives no rows."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    spark = files.sparkSession

    def read(frames):
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string())])
        for frame in frames:
            for name in frame.column(0).to_pylist():
                rows, held = [], 0
                for raw in read_frames(get_file(folder, name)):
                    try:
                        row = parse(raw)
                    except ValueError as e:
                        row = dict.fromkeys(names) | {"error": str(e)[:500]}
                    if row["record_type"] == "warcinfo":
                        continue
                    if not payloads:
                        row["payload"] = None
                    held += len(row["payload"] or b"")
                    rows.append(row)
                    if len(rows) >= 4096 or held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return files.select("file").repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))).mapInArrow(read, RECORDS)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    files = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    out = read_archives(files, folder, payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


OP9_SQL = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
