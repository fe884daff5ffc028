"""The worksheet scan as a Spark data source.

The driver reads the workbook's small parts and the head of the sheet; it never parses the sheet. Tasks
take byte ranges of the uncompressed XML: each inflates up to its range, owns the rows that begin in
it, and yields Arrow batches as it goes, so memory stays at a block of XML and the string table. Where a
workbook has points to enter its parts at, a task begins at the last one before its range and reads the
strings that it needs. A task keeps no state and can be run again anywhere.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BooleanType, DateType, DoubleType, StringType, StructField, StructType

from .. import errors
from ..operators import options as opts
from ..operators.convert import ARROW, column, days
from ..operators.infer import DAY, ERROR, NUMBER, TEXT, SheetPlan, infer
from . import rows as xml
from .ooxml import Sheet, locate, shared_strings

NAME = "gridscan"
PROBE_ROWS = 100
_OPEN, _CLOSE = b"<sheetData>", b"</sheetData>"
#: Uncompressed bytes of XML that a task takes at least and, unless threads says otherwise, at most.
LEAST_SLICE, MOST_SLICE = 256 << 10, 32 << 20
#: Pieces in a row that aren't even rows before a task no longer tries that.
MISSES = 4
#: Rows like a piece's first that make it worth that.
EVEN_ROWS = 64
#: Rows per batch of missing rows and of sheets that need the XML parser.
BATCH_ROWS = 8192
#: Bytes of a batch that are handed to Spark at once.
BATCH_BYTES = 16 << 20
_SPARK = {opts.VARCHAR: StringType(), opts.DOUBLE: DoubleType(), opts.BOOLEAN: BooleanType(), opts.DATE: DateType()}


@dataclass(frozen=True)
class Scan:
    """A bound scan: everything that a task needs."""

    options: opts.ScanOptions
    sheet: Sheet
    plan: SheetPlan
    ordinary: bool
    #: Numbers of the columns that are read.
    keep: tuple[int, ...]

    def spark_schema(self) -> StructType:
        return StructType([StructField(self.plan.names[c], _SPARK[self.plan.types[c]], True) for c in self.keep])

    def arrow_schema(self) -> pa.Schema:
        return pa.schema([(self.plan.names[c], ARROW[self.plan.types[c]]) for c in self.keep])


def bind(options: opts.ScanOptions) -> Scan:
    """Find the sheet and settle its columns from the head alone."""
    sheet = locate(options)
    try:
        start = xml.head(sheet)
        strings = None
        first = []
        for number, _, cells in islice(xml.rows_after(sheet, options.skip_rows), PROBE_ROWS + 2):
            kinds = {}
            for c, style, code, value in cells:
                kind = xml.kind_of(style, code, sheet.date_styles)
                if kind == TEXT and not first:
                    strings = shared_strings(sheet) if strings is None else strings
                    value = strings[int(value)].as_py()
                kinds[c] = (kind, value)
            first.append((number, kinds))
    except errors.SheetError:
        raise
    except Exception as e:
        raise errors.SheetError(errors.CANNOT_PARSE.format(why=e)) from e
    plan = infer(first, xml.dimension(start)[0], options)
    return Scan(options, sheet, plan, xml.is_ordinary(start), opts.chosen(options.columns, plan.names))


def batches(scan: Scan, lo: int, hi: int):
    """Record batches of the rows that begin in [lo, hi)."""
    strings = shared_strings(scan.sheet)
    done, missed, keep = scan.plan.start, 0, frozenset(scan.keep)
    if scan.ordinary:
        try:
            for before, piece, last in xml.slices(scan.sheet, lo, hi):
                tried = missed < MISSES and len(piece) > EVEN_ROWS * piece.find(b"</row>")
                even = _even(scan, xml.even(piece, keep), max(before, done), strings) if tried else None
                quick = xml.cells(piece) if even is None else None
                missed = missed + 1 if even is None else 0
                if even is not None:
                    yield from _cut(even)
                elif quick is not None:
                    yield from _columns(scan, quick, max(before, done), last, strings)
                elif not xml.all_placed(piece):
                    raise xml.Odd
                elif (found := xml.tokens(piece)) is not None:
                    yield from _columns(scan, _spelled(found), max(before, done), last, strings)
                else:
                    wrapped = xml.parsed(iter([_OPEN, piece, _CLOSE]), True, before)
                    yield from _by_parser(scan, wrapped, max(before, done), strings)
                done = max(done, last)
            return
        except xml.Odd:
            pass  # what follows goes on behind the last row that was handed out
    try:
        start = max(scan.sheet.entry(lo), scan.sheet.entry_of_row(done) if scan.ordinary else None, key=lambda p: p[1] if p else 0)
        before = start[2] if start else 0
        done = max(done, before)
        for at, piece in xml.pieces(scan.sheet, start):
            if at >= hi:
                break
            told = xml.counted(piece, before)
            if told is None:
                rows = [(number, place + at - len(_OPEN), found) for number, place, found in xml.parsed(iter([_OPEN, piece, _CLOSE]), True, before)]
                yield from _by_parser(scan, rows, done, strings, lo, hi)
                done, before = max([done, *(number for number, place, _ in rows if place < hi)]), rows[-1][0]
                continue
            quick, begin, number = told
            first, end = np.searchsorted(begin, (lo - at, hi - at)).tolist()
            done = max(done, int(number[first - 1])) if first else done
            if end > first:
                last = int(number[end - 1])
                if end < len(number):
                    quick = replace(quick, there=quick.there & (quick.row <= last))
                yield from _columns(scan, quick, done, last, strings)
                done = max(done, last)
            before = int(number[-1])
        return
    except xml.Odd:
        pass  # and so does the parser
    start = scan.sheet.entry(lo)
    yield from _by_parser(scan, xml.parsed_from(scan.sheet, start), max(done, start[2] if start else 0), strings, lo, hi)


def _even(scan: Scan, found: tuple | None, before: int, strings: pa.Array) -> pa.RecordBatch | None:
    """Rows that are all alike as a batch, if they follow row ``before`` and each column holds what its type reads without more."""
    if found is None or found[0] != before + 1 or max(found[2]) >= len(scan.plan.types):
        return None
    out = []
    for c in scan.keep:
        kind, (style, code, values) = scan.plan.types[c], found[2].get(c, (b"", b"", None))
        held = xml.kind_of(style, code, scan.sheet.date_styles)
        if values is None:
            out.append(pa.nulls(found[1], ARROW[kind]))
        elif (kind, held) == (opts.VARCHAR, TEXT):
            out.append(strings.take(values))
        elif (kind, held) == (opts.DOUBLE, NUMBER):
            out.append(values)
        elif (kind, held) == (opts.DATE, DAY):
            out.append(pa.array(days(values.to_numpy(), scan.sheet.date1904).astype(np.int32), pa.int32()).cast(pa.date32()))
        else:
            return None
    return pa.RecordBatch.from_arrays(out, schema=scan.arrow_schema())


def _spelled(found: list[tuple]) -> xml.Cells:
    """Tokens as cells; inline texts become values, and types of several letters keep their first, but for ``inlineStr`` and ``str``."""
    letters, numbers, styles, codes, values, inline = zip(*found) if found else [()] * 6
    index = {x: xml.column_number(x.decode()) for x in set(letters)}
    known = {c: _CODES.get(c, c[:1] if len(c) < 2 else b"?") for c in set(codes)}
    texts = [xml.inline_text(i) if i else xml.unescape(v.decode()) if c in _CODES else v.decode() for v, i, c in zip(values, inline, codes)]
    return xml.Cells(
        np.array(numbers, "S").astype(np.int64) if numbers else np.empty(0, np.int64),
        np.fromiter(map(index.__getitem__, letters), np.int64, len(letters)),
        np.array([int(x or 0) for x in styles], np.int64),
        np.frombuffer(b"".join(known[c] or b"\0" for c in codes), np.uint8),
        np.array([bool(v) or c in _CODES for v, c in zip(values, codes)], bool),
        pa.array(texts, pa.string()),
    )


#: One byte for the types that hold texts of their own.
_CODES = {b"str": b"f", b"inlineStr": b"i"}


def _kinds(cells: xml.Cells, dates: frozenset[int]) -> np.ndarray:
    """The kind of every cell from its style and type."""
    table = np.full(256, ERROR, np.int8)
    for c in (b"s", b"b", b"d", b"f", b"i"):
        table[c[0]] = xml.kind_of(b"", {v: k for k, v in _CODES.items()}.get(c, c), dates)
    out = table[cells.code]
    plain = (cells.code == 0) | (cells.code == ord("n"))
    return np.where(plain, np.where(np.isin(cells.style, list(dates)), DAY, NUMBER), out).astype(np.int8)


def _columns(scan: Scan, cells: xml.Cells, before: int, last: int, strings: pa.Array):
    """Rows before + 1 to last from cells, as one batch, after the rows that are missing in front of them."""
    n = last - before
    if n <= 0:
        return
    row, col, kind, text = cells.row - before - 1, cells.col, _kinds(cells, scan.sheet.date_styles), cells.values
    there = cells.there & (row >= 0)
    if not there.all():
        row, col, kind, text = row[there], col[there], kind[there], text.filter(pa.array(there))
    # Rows that are absent before the first one here come as batches of nulls.
    skip = int(row.min()) if len(row) else n
    while skip > BATCH_ROWS:
        yield pa.RecordBatch.from_arrays([pa.nulls(BATCH_ROWS, f.type) for f in scan.arrow_schema()], schema=scan.arrow_schema())
        skip, n, before, row = skip - BATCH_ROWS, n - BATCH_ROWS, before + BATCH_ROWS, row - BATCH_ROWS
    yield from _cut(_batch(scan, n, before, row, col, kind, text, strings))


def _cut(batch: pa.RecordBatch):
    """A batch, in several of about ``BATCH_BYTES`` if it is larger."""
    step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
    yield from (batch.slice(k, step) for k in range(0, batch.num_rows, step))


def _batch(scan: Scan, n: int, before: int, row, col, kind, text: pa.Array, strings: pa.Array) -> pa.RecordBatch:
    plan, o = scan.plan, scan.options
    width = len(plan.types)
    if len(col) and int(col.max()) >= width:
        at = int(np.flatnonzero(col >= width)[0])
        raise errors.SheetError(errors.WIDE_ROW.format(row=int(row[at]) + before + 1, has=int(col[at]) + 1, expected=width))
    order = np.argsort(col, kind="stable")
    edges = np.searchsorted(col[order], np.arange(width + 1))
    out = []
    for c in scan.keep:
        at = order[edges[c] : edges[c + 1]]
        out.append(column(plan.types[c], n, row[at], kind[at], text.take(pa.array(at)), strings, o.coerce_to_string, scan.sheet.date1904, o.inline_strings == "read"))
    return pa.RecordBatch.from_arrays(out, schema=scan.arrow_schema())


def _by_parser(scan: Scan, rows, before: int, strings: pa.Array, lo: int = 0, hi: int | None = None):
    """Batches from rows of the XML parser that begin in [lo, hi) and have numbers above ``before``."""
    held: list[tuple[int, list]] = []

    def flush():
        nonlocal before, held
        last = held[-1][0]
        flat = [(r, *c) for r, cells in held for c in cells]
        held = []
        while last - before > 4 * BATCH_ROWS and (not flat or flat[0][0] - before > BATCH_ROWS):
            yield pa.RecordBatch.from_arrays([pa.nulls(BATCH_ROWS, f.type) for f in scan.arrow_schema()], schema=scan.arrow_schema())
            before += BATCH_ROWS
        row = np.array([f[0] for f in flat], np.int64) - before - 1
        kind = np.array([xml.kind_of(f[2], f[3], scan.sheet.date_styles) for f in flat], np.int8)
        yield _batch(scan, last - before, before, row, np.array([f[1] for f in flat], np.int64), kind, pa.array([f[4] for f in flat], pa.string()), strings)
        before = last

    for number, at, cells in rows:
        if hi is not None and at >= hi:
            break
        if number <= before:
            continue
        if at < lo:
            before = number
            continue
        if held and (len(held) >= BATCH_ROWS or number - held[-1][0] > BATCH_ROWS):
            yield from flush()
        held.append((number, cells))
    if held:
        yield from flush()


def default_threads() -> int:
    """Half the processors, at least one."""
    return max(1, (os.cpu_count() or 1) // 2)


def ranges(scan: Scan) -> list[tuple[int, int]]:
    """Byte ranges of the sheet's XML, one per task."""
    if not scan.ordinary:
        return [(0, scan.sheet.size)]
    start = scan.sheet.entry_of_row(scan.plan.start)
    first = start[1] if start else 0
    size = max(1, scan.sheet.size - first)
    most = size + (scan.sheet.strings_size if scan.sheet.string_points else 0)
    n = scan.options.threads or max(default_threads(), -(-most // MOST_SLICE))
    n = max(1, min(n, -(-size // LEAST_SLICE)))
    edges = [first + size * k // n for k in range(n + 1)]
    if len(scan.sheet.points) > n:  # few enough ranges to begin where the sheet can be entered
        edges[1:-1] = [(scan.sheet.entry(e) or (0, first, 0))[1] for e in edges[1:-1]]
    return [(lo, hi) for lo, hi in zip(edges, edges[1:]) if lo < hi]


@dataclass
class SheetSlice(InputPartition):
    lo: int
    hi: int


class SheetReader(DataSourceReader):
    """Plans and reads a bound scan.

    It takes no pushed filters: Spark 4.1 keeps the reader, and with it the filters, of one query on a DataFrame for the
    next query on it, which would then lose rows.
    """

    def __init__(self, scan: Scan) -> None:
        self.scan = scan

    def partitions(self) -> list[SheetSlice]:
        return [SheetSlice(lo, hi) for lo, hi in ranges(self.scan)]

    def read(self, partition: SheetSlice):
        yield from batches(self.scan, partition.lo, partition.hi)


class SheetSource(DataSource):
    """``spark.read.format("gridscan").option(...).load("book.xlsx")``."""

    _bound: Scan | None = None

    @classmethod
    def name(cls) -> str:
        return NAME

    def _scan(self) -> Scan:
        """The bound scan; it is kept as long as the workbook stays the same."""
        options = opts.parse(dict(self.options))
        if self._bound is None or locate(options) != self._bound.sheet:
            self._bound = bind(options)
        return self._bound

    def schema(self) -> StructType:
        return self._scan().spark_schema()

    def reader(self, schema: StructType) -> SheetReader:
        scan = self._scan()
        if schema != scan.spark_schema():
            scan = _with_schema(scan, schema)
        return SheetReader(scan)


def _with_schema(scan: Scan, schema: StructType) -> Scan:
    """The scan under a schema that the caller gave: its names and types by position, like forced types."""
    names, types, keep = list(scan.plan.names), list(scan.plan.types), scan.keep
    if scan.options.columns is None:
        if len(schema) < scan.plan.width:
            raise errors.SheetError(errors.FEW_FIELDS.format(given=len(schema), width=scan.plan.width))
        names, types, keep = [""] * len(schema), [""] * len(schema), tuple(range(len(schema)))
    elif len(schema) != len(keep):
        raise errors.SheetError(errors.OTHER_FIELDS.format(given=len(schema), chosen=len(keep)))
    for c, f in zip(keep, schema):
        names[c], types[c] = f.name, opts.type_name(f.dataType.simpleString())
    return replace(scan, plan=SheetPlan(tuple(names), tuple(types), scan.plan.start, scan.plan.width), keep=keep)


__all__ = ["Scan", "SheetSource", "batches", "bind", "default_threads", "ranges"]
