"""Workbooks of large tables: tasks render and deflate runs of rows, the driver puts them end to end.

Strings are numbered anew in each chunk of rows, so that no list of all strings is ever held. Where a task starts, and every few
megabytes, the deflated sheet and string table can be entered; the workbook has an index of those points (``gridscan.sources.ooxml.POINTS``).
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..fixtures import CELL_LIMIT, Writer, letters, row_xml, string_xml
from ..sources.ooxml import POINTS

#: Rows whose strings are numbered together, and bytes of XML between two points of the index.
ROWS, SPAN = 4096, 2 << 20
#: Pieces that are copied at once, and bytes of each that are held.
COPIES, COPIED = 4, 4 << 20
_MASK, _POLYNOMIAL = 0xFFFFFFFF, 0xEDB88320
_CONTROLS = "".join(chr(c) for c in range(32) if c not in (9, 10))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32; the highest bit is 1."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def crc_of_both(first: int, second: int, size: int) -> int:
    """CRC-32 of two byte strings end to end; size is that of the second."""
    shift, power, n = 1 << 31, 1 << 23, size  # x to the 0, x to the 8
    while n:
        shift, power, n = _times(shift, power) if n & 1 else shift, _times(power, power), n >> 1
    return _times(shift, first) ^ second


class Deflated:
    """Deflated bytes that can be entered at points: (deflated offset, offset, what ``add`` was told comes before)."""

    def __init__(self, put, span: int) -> None:
        self.put, self.span, self.points = put, span, []
        self.size = self.packed = self.crc = 0
        self.packer = zlib.compressobj(1, zlib.DEFLATED, -15)

    def _out(self, data: bytes) -> None:
        self.packed += len(data)
        self.put(data)

    def add(self, data, before: int) -> None:
        if not self.points or self.size - self.points[-1][1] >= self.span:
            self._out(self.packer.flush(zlib.Z_FULL_FLUSH) if self.points else b"")
            self.points.append((self.packed, self.size, before))
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._out(self.packer.compress(data))

    def end(self, last: bool = False) -> None:
        self._out(self.packer.flush(zlib.Z_FINISH if last else zlib.Z_FULL_FLUSH))


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows in runs of ``ROWS``, however they are cut into batches."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, ROWS - n)
            batch, n = batch.slice(part.num_rows), n + part.num_rows
            held.append(part)
            if n == ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _is_text(kind: pa.DataType) -> bool:
    return pa.types.is_string(kind) or pa.types.is_large_string(kind)


def _texts(table: pa.Table) -> dict[int, pa.Array]:
    """Columns of text, cut at the limit of a cell."""
    out = {}
    for c, column in enumerate(table.columns):
        if _is_text(column.type):
            text = column.cast(pa.string()).combine_chunks()
            text = pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text
            out[c] = pc.utf8_slice_codeunits(text, 0, CELL_LIMIT) if (pc.max(pc.binary_length(text)).as_py() or 0) > CELL_LIMIT else text
    return out


def _numbered(texts: dict[int, pa.Array]) -> pa.Array:
    """The different strings of a chunk, in the order of their numbers."""
    return pc.unique(pa.concat_arrays(list(texts.values()))).drop_null() if texts else pa.array([], pa.string())


def _escaped(strings: pa.Array) -> pa.Array:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        strings = pc.replace_substring(strings, sign, name)
    if pc.any(pc.match_substring(strings, "_x")).as_py():
        strings = pc.replace_substring_regex(strings, "_(x[0-9A-Fa-f]{4}_)", r"_x005F_\1")
    if pc.any(pc.match_substring_regex(strings, f"[{re.escape(_CONTROLS)}]")).as_py():
        for sign in _CONTROLS:
            strings = pc.replace_substring(strings, sign, f"_x{ord(sign):04X}_")
    return strings


def _bytes(strings: pa.Array):
    """All strings of a fresh array end to end."""
    return memoryview(strings.buffers()[2])[: sum(pc.binary_length(strings).to_numpy().tolist())] if len(strings) else b""


def _value(column: pa.ChunkedArray) -> tuple[str, pa.Array]:
    """(attributes of the cells, their values as text) of a column that isn't text."""
    column = column.combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    kind = column.type
    if pa.types.is_boolean(kind):
        return ' t="b"', column.cast(pa.int8()).cast(pa.string())
    if pa.types.is_date(kind):
        return ' s="1"', pc.add(column.cast(pa.date32()).cast(pa.int32()), 25569).cast(pa.string())
    if pa.types.is_timestamp(kind):
        micros = column.cast(pa.timestamp("us", kind.tz)).cast(pa.int64())
        none, micros = np.asarray(micros.is_null()), micros.fill_null(0).to_numpy()
        day, rest = np.divmod(micros, 86_400_000_000)
        return ' s="1"', pa.array(day + 25569 + rest / 86_400_000_000, mask=none).cast(pa.string())
    return "", column.cast(pa.string())


def _rows(table: pa.Table, number: np.ndarray, base: int, named: bool, placed: bool) -> pa.Array:
    """Each row's XML. Rows that aren't named have no place of their own, and cells have theirs if ``placed``."""
    texts = _texts(table)
    strings = _numbered(texts)
    at = pa.array(number).cast(pa.string())
    parts: list = ['<row r="', at, '">'] if named else ["<row>"]
    for c, column in enumerate(table.columns):
        if c in texts:
            more, value = ' t="s"', pc.add(pc.index_in(texts[c], value_set=strings, skip_nulls=True).cast(pa.int64()), base).cast(pa.string())
        else:
            more, value = _value(column)
        cell = [f'<c r="{letters(c)}', at, f'"{more}><v>'] if placed else [f"<c{more}><v>"]
        cell += [value, "</v></c>"]
        parts += [pc.fill_null(pc.binary_join_element_wise(*cell, ""), "")] if value.null_count else cell
    parts.append("</row>")
    merged: list = []
    for x in parts:
        if isinstance(x, str) and merged and isinstance(merged[-1], str):
            merged[-1] += x
        else:
            merged.append(x)
    if all(isinstance(x, str) for x in merged):
        return pa.array(["".join(merged)] * len(number), pa.string())
    return pc.binary_join_element_wise(*merged, "")


def _bare(table: pa.Table, number: np.ndarray, base: int, total: int) -> pa.Array:
    """Rows as ``books.bare_rows`` has them."""
    i = number - 1
    how = np.where((i < total // 3) | (i % 997 == 5), 0, np.where(i % 7 == 3, 1, 2))
    kinds = np.unique(how).tolist()
    if len(kinds) == 1:
        return _rows(table, number, base, how[0] == 0, how[0] < 2)
    return pc.choose(pa.array(how), *(_rows(table, number, base, k == 0, k < 2) for k in range(3)))


@dataclass
class Piece:
    """Deflated bytes in memory or a file. Points count from its own beginning, ``before`` of each from ``first``."""

    data: bytes | str
    size: int
    packed: int
    crc: int
    points: list
    n: int


def _small(parts: list[str], n: int, last: bool = False) -> Piece:
    out: list[bytes] = []
    d = Deflated(out.append, 1 << 62)
    d.add("".join(parts).encode(), 0)
    d.end(last)
    return Piece(b"".join(out), d.size, d.packed, d.crc, d.points, n)


def _run(df: DataFrame, folder: str, what: str, make) -> list[Piece]:
    """Pieces of all partitions in order; ``make(partition, chunks)`` gives (XML, rows or strings in it) after a count of its own rows."""

    def work(batches):
        from pyspark import TaskContext

        k = TaskContext.get().partitionId()
        path, n, rows = os.path.join(folder, f"{what}-{k}-{uuid.uuid4().hex}"), 0, 0
        with open(path, "wb") as f:
            d = Deflated(f.write, SPAN)
            for chunk in chunks(batches):
                data, own = make(k, rows, n, chunk)
                if len(data):
                    d.add(data, n)
                n, rows = n + own, rows + chunk.num_rows
            d.end()
        yield pa.RecordBatch.from_pylist([{"k": k, "path": path, "size": d.size, "packed": d.packed, "crc": d.crc, "points": json.dumps(d.points), "n": n, "rows": rows}])

    found = df.mapInArrow(work, "k long, path string, size long, packed long, crc long, points string, n long, rows long").collect()
    return [(Piece(r.path, r.size, r.packed, r.crc, json.loads(r.points), r.n), r.rows) for r in sorted(found)]


def _copy(p: Piece, out: int, at: int) -> None:
    """A piece's bytes into an open file from a place on; its own file goes."""
    if isinstance(p.data, bytes):
        os.pwrite(out, p.data, at)
        return
    with open(p.data, "rb") as f:
        done = 0
        while block := os.pread(f.fileno(), COPIED, done):
            done += os.pwrite(out, block, at + done)
    if done != p.packed:
        raise RuntimeError(f"{p.data} has {done} bytes, not {p.packed}")
    os.remove(p.data)


def _put(book: Writer, part: str, pieces: list[Piece]) -> dict:
    """A part of the workbook from its pieces; what the index says of it."""
    points, size, packed, crc, before = [], 0, 0, 0, 0
    for p in pieces:
        for c, u, n in p.points:
            if not points or size + u - points[-1][1] >= SPAN // 2:
                points.append((packed + c, size + u, before + n))
        crc = crc_of_both(crc, p.crc, p.size)
        size, packed, before = size + p.size, packed + p.packed, before + p.n
    with book.deflated(part, size, packed, crc) as out:
        out.flush()
        began = out.tell()
        begins = (began + np.cumsum([0, *(p.packed for p in pieces)])).tolist()
        with ThreadPoolExecutor(COPIES) as pool:
            list(pool.map(_copy, pieces, [out.fileno()] * len(pieces), begins))
        out.seek(began + packed)
    return {"size": size, "crc": crc, "points": points}


def write(path: str, sheet: str, df: DataFrame, more: Iterable[list] = (), bare: bool = False) -> str:
    """A workbook of one sheet: the names of df's columns, its rows, then a few more, written under a temporary name.

    df is read twice, by some of its columns first, and must have the same rows in the same partitions both times, as a scan of files has.
    """
    folder = f"{path}.{uuid.uuid4().hex}.parts"
    os.makedirs(folder)
    columns = [c for c, kind in df.dtypes if kind.startswith(("string", "varchar", "char"))]

    def strings_of(k, rows, n, chunk):
        found = _numbered(_texts(chunk))
        if not len(found):
            return b"", 0
        return _bytes(pc.binary_join_element_wise('<si><t xml:space="preserve">', _escaped(found), "</t></si>", "")), len(found)

    counted = _run(df.select(columns or df.columns[:1]), folder, "strings", strings_of)
    texts: dict[str, int] = {}
    book = Writer(f"{path}.{uuid.uuid4().hex}.tmp")
    head = [book.sheet_head(sheet), row_xml(1, df.columns, texts)]
    heading = _small([book.strings_head(), *map(string_xml, texts)], len(texts))
    n_rows = [rows for _, rows in counted]
    first_row = (2 + np.cumsum([0, *n_rows])).tolist()
    base = (len(texts) + np.cumsum([0, *(p.n for p, _ in counted)])).tolist()
    total = first_row[-1] - 1

    taken: dict[int, int] = {}

    def rows_of(k, rows, n, chunk):
        number = np.arange(first_row[k] + rows, first_row[k] + rows + chunk.num_rows)
        at = base[k] + (taken.get(k, 0) if rows else 0)  # behind the strings of the partition's chunks before
        taken[k] = at - base[k] + len(_numbered(_texts(chunk)))
        if rows + chunk.num_rows > n_rows[k] or base[k] + taken[k] > base[k + 1]:
            raise RuntimeError("the table changed while its workbook was written")
        return _bytes(_bare(chunk, number, at, total) if bare else _rows(chunk, number, at, True, True)), chunk.num_rows

    rendered = _run(df, folder, "rows", rows_of)
    if [rows for _, rows in rendered] != n_rows:
        raise RuntimeError("the table changed while its workbook was written")
    late: dict[str, int] = {}
    tail = [row_xml(first_row[-1] + i, r, late, base[-1]) for i, r in enumerate(more)]
    index = {
        book.sheet_part(): _put(book, book.sheet_part(), [_small(head, 1), *(p for p, _ in rendered), _small(tail, len(tail)), _small([book.sheet_end()], 0, True)]),
        book.STRINGS: _put(book, book.STRINGS, [heading, *(p for p, _ in counted), _small([*map(string_xml, late)], len(late)), _small([book.strings_end()], 0, True)]),
    }
    book.zip.writestr(POINTS, json.dumps(index))
    book.close()
    os.replace(book.path, path)
    os.rmdir(folder)
    return path
