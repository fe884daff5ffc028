"""Token files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Documents are range-dealt by id, encoded once, and each range writes files. A file ranks its own ids,
the commonest first, and keeps that table, so it can be read alone and no pass over the whole corpus
has to come first. Then follow two control bits per id, giving the length of 1 to 4 bytes of its rank, and those
bytes. The decoder finds the lengths of four ids at once in a table of 256 rows and gathers all with numpy.

A file is ``GSV1``, then the numbers of documents, ids, data bytes and different ids (64-bit), then per
document its id, a byte telling whether it has one, and its number of ids, then the ids by rank (32-bit),
control bytes and data bytes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import input_partitions, range_buckets, scratch_dir
from .files import committed, drop_temporary, open_store, save_table, spread
from .tokenize import default_vocabulary, encoder

END_ID = 2
MAGIC = b"GSV1"
#: A file is closed once it holds so many ids.
ROLL = 4 << 20
_LENGTHS = (np.arange(256, dtype=np.uint8)[:, None] >> np.arange(0, 8, 2, dtype=np.uint8) & 3) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    four = np.zeros((len(v) + 3) // 4 * 4, np.uint8)
    four[: len(v)] = extra
    control = np.bitwise_or.reduce(four.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8), axis=1).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values, by table lookup of the control bytes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    wide = np.ndarray((len(data) + 1,), "<u4", bytes(data) + b"\0\0\0\0", 0, (1,))
    return wide[ends - lengths] & _MASKS[lengths]


def rank_ids(ids: np.ndarray) -> np.ndarray:
    """The different ids in falling order of their number, of equal ones the smaller first."""
    if len(ids) and int(ids.max()) < 1 << 24:
        counts = np.bincount(ids)
        different = np.flatnonzero(counts)
        n = counts[different]
    else:
        different, n = np.unique(ids, return_counts=True)
    return different[np.lexsort((different, -n))].astype("<u4")


def file_bytes(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """The bytes of one file of (document id, token ids)."""
    ids = np.concatenate([v for _, v in docs]) if docs else np.empty(0, np.uint32)
    ranked = rank_ids(ids)
    rank_of = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32) if len(ranked) and ranked.max() < 1 << 24 else None
    if rank_of is not None:
        rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
        ranks = rank_of[ids]
    else:
        order = np.argsort(ranked)
        ranks = order[np.searchsorted(ranked, ids, sorter=order)]
    control, data = encode_values(ranks)
    head = np.array([len(docs), len(ids), len(data), len(ranked)], "<i8").tobytes()
    keys = np.array([k or 0 for k, _ in docs], "<i8").tobytes()
    there = np.array([k is not None for k, _ in docs], np.uint8).tobytes()
    counts = np.array([len(v) for _, v in docs], "<i8").tobytes()
    return b"".join([MAGIC, head, keys, there, counts, ranked.tobytes(), control, data])


def parse_file(raw: bytes) -> list[tuple[int | None, np.ndarray]]:
    """What ``file_bytes`` was given."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token file")
    n, total, size, different = np.frombuffer(raw, "<i8", 4, 4).tolist()
    at = 36
    keys = np.frombuffer(raw, "<i8", n, at).tolist()
    there = np.frombuffer(raw, np.uint8, n, at + 8 * n).tolist()
    counts = np.frombuffer(raw, "<i8", n, at + 9 * n)
    at += 17 * n
    ranked = np.frombuffer(raw, "<u4", different, at)
    at += 4 * different
    control = (total + 3) // 4
    ids = ranked[decode_values(raw[at : at + control], raw[at + control : at + control + size], total)]
    ends = np.cumsum(counts)
    return [(k if t else None, ids[e - c : e]) for k, t, c, e in zip(keys, there, counts.tolist(), ends.tolist())]


_FILES = pa.schema([("name", pa.string()), *[(c, pa.int64()) for c in ("bucket", "number", "docs", "ids", "bytes")]])


def write_token_files(docs: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, roll: int = ROLL) -> DataFrame:
    """Write all texts in ascending order of id and return the manifest: a table of files with the ids before each, stored beside them.

    Null and empty texts hold the end id (2) alone, long ones are never cut. Rows without an id come first, equal ids go by text hash,
    repeated rows are written as often as they occur; an empty table gives no files.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([END_ID], "<u4").tobytes()

    def write(batches):
        encode = encoder(path)
        held: list[tuple[int | None, np.ndarray]] = []
        size, now, number = 0, None, 0

        def close():
            nonlocal held, size, number
            rows = []
            if held:
                name = f"tokens-{now:06d}-{number:06d}.gsv"
                raw = file_bytes(held)
                with committed(uri, name) as out:
                    out.write(raw)
                rows.append({"name": name, "bucket": now, "number": number, "docs": len(held), "ids": sum(len(v) for _, v in held), "bytes": len(raw)})
            held, size, number = [], 0, number + 1
            return pa.RecordBatch.from_pylist(rows, schema=_FILES)

        for b in batches:
            for bucket, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if bucket != now:
                    yield close()
                    now, number = bucket, 0
                v = np.frombuffer(encode(text.as_py()) + end, "<u4")
                held.append((key, v))
                size += len(v)
                if size >= roll:
                    yield close()
        yield close()

    parts = input_partitions(docs)
    ranges = range_buckets(docs, id_col, parts)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    rows = rows.select(ranges.bucket(F.col("id"), F.col("tie")).cast("long").alias("bucket"), "id", "text", "tie")
    rows = rows.repartitionById(ranges.buckets, F.col("bucket").cast("int")).sortWithinPartitions("bucket", "id", "tie")
    written = rows.select("bucket", "id", "text").mapInArrow(write, "name string, bucket long, number long, docs long, ids long, bytes long")
    files = save_table(written, uri, "files")
    drop_temporary(uri)
    return save_table(with_starts(files), uri, "manifest")


def with_starts(files: DataFrame) -> DataFrame:
    """files with ``start``, the ids before each: those of earlier buckets (one row a bucket is summed in order) and of earlier files of its own."""
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("bucket").agg(F.sum("ids").alias("n")).select("bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("bucket").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("own", F.coalesce(F.sum("ids").over(own), F.lit(0))).join(totals, "bucket").select("name", "docs", "ids", "bytes", (F.col("before") + F.col("own")).alias("start"))


def read_token_files(manifest: DataFrame, uri: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of the files in a manifest; with ``digest`` the CRC-32 of the ids in their place."""

    def read(batches):
        store, top = open_store(uri)
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with store.open_input_stream(f"{top}/{name}", compression=None) as stream:
                    raw = stream.read()
                out = []
                for key, v in parse_file(raw):
                    raw_ids = v.tobytes()
                    out.append((key, start, len(v), zlib.crc32(raw_ids) if digest else raw_ids))
                    start += len(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary())
    names = ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"]
    schema = f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}"
    return spread(manifest.select("name", "start")).mapInArrow(read, schema)


def token_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from files written in the shared folder; odd rows as in ``write_token_files``."""
    uri = scratch_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, uri, id_col, text_col, vocabulary), uri, digest=True)
