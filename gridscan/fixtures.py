"""A small workbook writer, used by tests, queries and the benchmark; it isn't part of the engine's surface."""

from __future__ import annotations

import contextlib
import datetime
import os
import zipfile
from collections.abc import Iterable
from dataclasses import dataclass
from xml.sax.saxutils import escape

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACK = "http://schemas.openxmlformats.org/package/2006"
_EPOCH = datetime.date(1970, 1, 1).toordinal()
CELL_LIMIT = 32_767


@dataclass(frozen=True)
class Raw:
    """A cell given as XML attributes and content."""

    attributes: str
    content: str


@dataclass(frozen=True)
class Serial:
    """A number shown as a date."""

    value: float


@dataclass(frozen=True)
class Bare:
    """A row that doesn't name its place; nor do its cells, but where ``placed`` says so. No cell may be left out in front of another without."""

    cells: list
    placed: bool = False


def letters(column: int) -> str:
    out, n = "", column + 1
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def cell_xml(place: str, value, strings: dict[str, int], base: int = 0) -> str:
    if isinstance(value, str):
        return f'<c r="{place}" t="s"><v>{base + strings.setdefault(value, len(strings))}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{place}"><v>{value!r}</v></c>'
    if isinstance(value, datetime.datetime):
        at = value.toordinal() - _EPOCH + 25569 + (value - datetime.datetime.combine(value, datetime.time())).total_seconds() / 86400
        return f'<c r="{place}" s="1"><v>{at!r}</v></c>'
    if isinstance(value, datetime.date):
        return f'<c r="{place}" s="1"><v>{value.toordinal() - _EPOCH + 25569}</v></c>'
    if isinstance(value, Serial):
        return f'<c r="{place}" s="1"><v>{value.value!r}</v></c>'
    return f'<c r="{place}" {value.attributes}>{value.content}</c>'


def row_xml(number: int, row: list, strings: dict[str, int], base: int = 0) -> str:
    return f'<row r="{number}">' + "".join(cell_xml(f"{letters(c)}{number}", v, strings, base) for c, v in enumerate(row) if v is not None) + "</row>"


def string_xml(text: str) -> str:
    return f'<si><t xml:space="preserve">{escape(text)}</t></si>'


class Writer:
    """Sheets of rows; None leaves a cell out, None for a row leaves the row out, a pair (number, row) places it."""

    STRINGS = "xl/sharedStrings.xml"

    def __init__(self, path: str, date1904: bool = False) -> None:
        self.path = path
        self.zip = zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        self.strings: dict[str, int] = {}
        self.sheets: list[str] = []
        self.date1904 = date1904

    def _cell(self, place: str, value) -> str:
        return cell_xml(place, value, self.strings)

    def sheet_head(self, name: str, dimension: str | None = None) -> str:
        self.sheets.append(name)
        size = f'<dimension ref="{dimension}"/>' if dimension else ""
        return f'{_HEAD}<worksheet xmlns="{_MAIN}">{size}<sheetData>'

    def sheet_part(self) -> str:
        return f"xl/worksheets/sheet{len(self.sheets)}.xml"

    def sheet_end(self) -> str:
        return "</sheetData></worksheet>"

    def strings_head(self) -> str:
        return f'{_HEAD}<sst xmlns="{_MAIN}">'

    def strings_end(self) -> str:
        return "</sst>"

    @contextlib.contextmanager
    def deflated(self, part: str, size: int, packed: int, crc: int):
        """The file, to put the deflated bytes of a part into."""
        info = zipfile.ZipInfo(part)
        info.compress_type, info.file_size, info.compress_size, info.CRC = zipfile.ZIP_DEFLATED, size, packed, crc
        info.header_offset = self.zip.fp.tell()
        self.zip.fp.write(info.FileHeader(zip64=True))
        began = self.zip.fp.tell()
        yield self.zip.fp
        if self.zip.fp.tell() - began != packed:
            raise RuntimeError(f"{part} has {self.zip.fp.tell() - began} deflated bytes, not {packed}")
        self.zip.filelist.append(info)
        self.zip.NameToInfo[part] = info
        self.zip.start_dir, self.zip._didModify = self.zip.fp.tell(), True

    def add(self, name: str, rows: Iterable, dimension: str | None = None) -> None:
        names: list[str] = []
        head = self.sheet_head(name, dimension)
        with self.zip.open(self.sheet_part(), "w", force_zip64=True) as out:
            out.write(head.encode())
            number, held = 0, []
            for row in rows:
                number += 1
                if row is None:
                    continue
                if isinstance(row, Bare):
                    held.append("<row>" + "".join(self._cell(f"{letters(c)}{number}", v).replace("" if row.placed else f' r="{letters(c)}{number}"', "", 1) for c, v in enumerate(row.cells) if v is not None) + "</row>")
                    if len(held) >= 2000:
                        out.write("".join(held).encode())
                        held = []
                    continue
                if isinstance(row, tuple) and len(row) == 2 and isinstance(row[1], (list, tuple)):
                    number, row = row
                while len(names) < len(row):
                    names.append(letters(len(names)))
                cells = "".join(self._cell(f"{names[c]}{number}", v) for c, v in enumerate(row) if v is not None)
                held.append(f'<row r="{number}">{cells}</row>')
                if len(held) >= 2000:
                    out.write("".join(held).encode())
                    held = []
            out.write(("".join(held) + self.sheet_end()).encode())

    def close(self) -> None:
        put = lambda name, text: self.zip.writestr(name, _HEAD + text)
        n = len(self.sheets)
        sheets = "".join(f'<sheet name="{escape(s)}" sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(self.sheets, 1))
        put("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><workbookPr date1904="{int(self.date1904)}"/><sheets>{sheets}</sheets></workbook>')
        parts = [("worksheet", f"worksheets/sheet{i}.xml") for i in range(1, n + 1)] + [("sharedStrings", "sharedStrings.xml"), ("styles", "styles.xml")]
        links = "".join(f'<Relationship Id="rId{i}" Type="{_DOC}/{k}" Target="{t}"/>' for i, (k, t) in enumerate(parts, 1))
        put("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACK}/relationships">{links}</Relationships>')
        put("_rels/.rels", f'<Relationships xmlns="{_PACK}/relationships"><Relationship Id="rId1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        put("xl/styles.xml", f'<styleSheet xmlns="{_MAIN}"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        if self.STRINGS not in self.zip.NameToInfo:
            self.zip.writestr(self.STRINGS, self.strings_head() + "".join(map(string_xml, self.strings)) + self.strings_end())
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        over = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, n + 1))
        put("[Content_Types].xml", f'<Types xmlns="{_PACK}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="json" ContentType="application/json"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{over}</Types>')
        self.zip.close()


def write_book(path: str, sheets: dict[str, Iterable], date1904: bool = False, dimension: str | None = None) -> str:
    """A workbook under a temporary name, then renamed."""
    temporary = f"{path}.{os.getpid()}.tmp"
    w = Writer(temporary, date1904)
    for name, rows in sheets.items():
        w.add(name, rows, dimension)
    w.close()
    os.replace(temporary, path)
    return path


def table_rows(path: str, columns: list[str] | None = None) -> Iterable[list]:
    """A parquet table as a header and rows, in file order; text is clipped to the cell limit."""
    import pyarrow.parquet as pq

    f = pq.ParquetFile(path)
    names = columns or f.schema_arrow.names
    yield names
    for batch in f.iter_batches(columns=names):
        cols = []
        for name in names:
            values = batch.column(name).to_pylist()
            cols.append([v[:CELL_LIMIT] if v is not None else v for v in values] if values and isinstance(next((v for v in values if v is not None), None), str) else values)
        yield from (list(r) for r in zip(*cols))
