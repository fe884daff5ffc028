"""WARC: a deterministic sharded writer and its reader.

Digests and revisits are settled on narrow rows first (payload digest, page id). Whole pages are then
shuffled once, dealt by ranges of their id (of the digest within a hot id, or without ids), and sorted; in front of a page that repeats an earlier
payload stands the row that says so. Every record is a gzip member of its own. A file is rolled once
its compressed size passes a limit, written under a temporary name and renamed; a manifest, itself a table that the tasks write,
lists the files of a complete run, so that no list of files comes to the driver. Headers, record ids and digests are made anew from the rows alone, so a rerun
writes the same bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, input_partitions, range_buckets
from .files import committed, drop_temporary, open_store, save_table, spread

#: Compressed bytes after which a file is closed.
ROLL = 32 << 20
#: Payloads below this size are never written as revisits.
MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
LEVEL = 3
#: Compressed bytes that the reader hands to the decoder at once; what lies beyond a record's end is copied.
_READ_BYTES = 4096
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hex=hashlib.sha256(f'{page_id}/{digest}'.encode()).hexdigest()[:32])}>"


def _uri(url: str | None, page_id: int | None) -> str:
    text = url or f"urn:page:{page_id}"
    return "".join(c if " " < c != "\x7f" else "".join(f"%{x:02X}" for x in c.encode()) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record; a revisit holds the response's headers without the payload."""
    digest = hashlib.sha256(payload).hexdigest()
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url, page_id)}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, block) of one record; the block's digest must hold."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != fields["warc-block-digest"]:
        raise ValueError(f"damaged block in {fields['warc-record-id']}")
    return fields, block


def members(blocks):
    """The records of a compressed archive, given in blocks, one at a time."""
    d, out = zlib.decompressobj(31), []
    for block in blocks:
        at = 0
        while at < len(block):
            piece = block[at : at + _READ_BYTES]
            out.append(d.decompress(piece))
            at += len(piece) - len(d.unused_data)
            if d.eof:
                yield b"".join(out)
                d, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("a record is cut off")


def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """(id, digest, refers_to) of the rows that repeat the payload of a row with a smaller id.

    Rows of the very id that holds the response, and rows without an id, are responses.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    long_ones = pages.where(F.octet_length(payload) >= MIN_REVISIT)
    digests = cut_lineage(long_ones.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha2(payload, 256)).alias("digest")))
    first = digests.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return digests.join(first, "digest").where("id > refers_to").select("id", "digest", "refers_to").distinct()


_FILES = pa.schema([("name", pa.string()), *[(c, pa.int64()) for c in ("bucket", "number", "records", "bytes")]])


def write_warc(pages: DataFrame, uri: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll: int = ROLL) -> DataFrame:
    """Write one record per row of pages below ``uri`` and return the manifest: a table of files, stored beside them.

    Null payloads are empty, whatever their size payloads are one record each; null and empty addresses become a name made of the id. Rows without an id come first; repeated
    rows are written as often as they occur; an empty table gives no files.
    """
    parts = input_partitions(pages)
    ranges = range_buckets(pages, id_col, parts)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    key = F.col(id_col).cast("long")
    rows = pages.select(key.alias("id"), F.unhex(F.sha2(payload, 256)).alias("digest"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    marks = revisits(pages, id_col, payload_col).select("id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    both = rows.unionByName(marks).withColumn("tie", F.xxhash64("digest"))
    dealt = both.withColumn("bucket", ranges.bucket(F.col("id"), F.col("tie"))).repartitionById(ranges.buckets, "bucket")
    dealt = dealt.sortWithinPartitions("bucket", "id", "tie", "digest", "kind", "url").select("bucket", "id", "digest", "refers_to", "url", "payload", "kind")

    def write(batches):
        held: list[bytes] = []
        size, now, number, mark = 0, None, 0, None

        def close():
            nonlocal held, size, number
            done = []
            if held:
                name = f"part-{now:06d}-{number:06d}.warc.gz"
                with committed(uri, name) as out:
                    for x in held:
                        out.write(x)
                done.append({"name": name, "bucket": now, "number": number, "records": len(held), "bytes": size})
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pylist(done, schema=_FILES)

        for b in batches:
            for bucket, key, digest, refers, url, payload, kind in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    mark = (key, digest, refers)
                    continue
                if bucket != now:
                    yield close()
                    now, number = bucket, 0
                refers = mark[2] if mark and mark[:2] == (key, digest) else None
                held.append(gzip.compress(record(key, url, payload, refers), LEVEL, mtime=0))
                size += len(held[-1])
                if size >= roll:
                    yield close()
        yield close()

    manifest = save_table(dealt.mapInArrow(write, "name string, bucket long, number long, records long, bytes long"), uri, "manifest")
    drop_temporary(uri)
    return manifest


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def _blocks(stream):
    while block := stream.read(1 << 20):
        yield block


def read_warc(manifest: DataFrame, uri: str) -> DataFrame:
    """One row per record of the files in a manifest, from headers and blocks alone; files are streamed."""

    def read(batches):
        store, top = open_store(uri)
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    for fields, block in map(parse, members(_blocks(stream))):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
                        if kind == "response":
                            digest_now, size = hashlib.sha256(payload).hexdigest(), len(payload)
                            if digest_now != digest:
                                raise ValueError(f"damaged payload in {fields['warc-record-id']}")
                        else:
                            size = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
                        at, to = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                        rows.append({"page_id": at and int(at), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": to and int(to), "url": fields["warc-target-uri"]})
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return spread(manifest.select("name")).mapInArrow(read, schema)
