"""Rows of a worksheet: a byte-range tokenizer for ordinary sheets and an XML parser for all others."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.parsers import expat

import numpy as np
import pyarrow as pa

from ..operators.infer import DAY, ERROR, FLAG, NUMBER, OTHER_TEXT, TEXT
from .ooxml import Point, Sheet, inflated_from, open_file, plain_text, unescape

BLOCK = 1 << 20
#: What may stand in front of a sheet's rows is small; a sheet with more is read by the XML parser.
HEAD = 16 << 20
#: One cell as writers commonly put it: place, style, type, perhaps a formula, a value.
CELL = re.compile(rb'<c r="([A-Z]+)(\d+)"(?: s="(\d+)")?(?: t="(\w+)")?\s*(?:/>|>(?:<f(?: [^>]*)?(?:/>|>[^<]*</f>))?(?:<v(?: [^>]*)?>([^<]*)</v>|<v/>)?(?:<is>(.*?)</is>)?</c>)', re.S)
_ROW = re.compile(rb"<row[ \t\r\n/>]")
_PLACE = re.compile(rb"<row(?=[ \t\r\n])[^>]*?\sr\s*=\s*[\"'](\d+)[\"'][^>]*>")
_CELL_START = re.compile(rb"<c[ \t\r\n/>]")
_PREFIXED = re.compile(rb"<\w+:(?:row|c|v|is|f)[ \t\r\n/>]")
_END = b"</sheetData>"
_ODD = re.compile(rb"<!\[CDATA\[|<!--|<\w+:(?:row|c|sheetData)\b|<row>|<row (?![^>]*\br=\")|<c>|<c (?![^>]*\br=\")")
_TAG = re.compile(r"<t(?: [^>]*)?>([^<]*)</t>")


def column_number(letters: str) -> int:
    """A is 0."""
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def kind_of(style: bytes, code: bytes, dates: frozenset[int]) -> int:
    """The kind of a cell from its style and type attributes; a type this engine doesn't know is an error cell."""
    if code in (b"", b"n"):
        return DAY if style and int(style) in dates else NUMBER
    return {b"s": TEXT, b"b": FLAG, b"d": DAY, b"str": OTHER_TEXT, b"inlineStr": OTHER_TEXT}.get(code, ERROR)


def inflated(sheet: Sheet, start: Point | None = None) -> Iterator[bytes]:
    """The sheet's XML in blocks, from a point on if one is given."""
    if start:
        yield from inflated_from(sheet.path, sheet.part, start[0], BLOCK)
        return
    with open_file(sheet.path) as f, zipfile.ZipFile(f) as z, z.open(sheet.part) as part:
        while block := part.read(BLOCK):
            yield block


def head(sheet: Sheet) -> bytes:
    """The start of the sheet's XML, with the first rows if there are any."""
    out = b""
    for block in inflated(sheet):
        out += block
        if b"sheetData" in out or len(out) > HEAD:
            break
    return out


def is_ordinary(start: bytes) -> bool:
    """Whether byte ranges can be read on their own: rows and cells name their places and no prefixes, comments or CDATA occur."""
    return b"<sheetData" in start and not _ODD.search(start)


def dimension(start: bytes) -> tuple[int, int]:
    """(columns, rows) of the sheet's declared dimension, zeros if there is none."""
    m = re.search(rb'<(?:\w+:)?dimension [^>]*?ref="(?:\$?[A-Z]+\$?\d+:)?\$?([A-Z]+)\$?(\d+)"', start)
    return (column_number(m[1].decode()) + 1, int(m[2])) if m else (0, 0)


def inline_text(raw: bytes) -> str:
    """Text of an inline string: its runs end to end."""
    return "".join(unescape(t) for t in _TAG.findall(re.sub(r"<rPh.*?</rPh>", "", raw.decode(), flags=re.S)))


class _Handler:
    """Expat events within sheetData to rows of [number, first byte, [(column, style, type, value)]].

    A row without a place follows the one before, or stands where its first cell with a place says.
    """

    def __init__(self, inside: bool, before: int) -> None:
        self.rows: list[list] = []
        self.inside, self.row, self.column, self.cell, self.keep, self.skip, self.free = inside, before, 0, None, False, 0, False
        self.text: list[str] = []
        self.some = False
        self.place = lambda: 0

    def start(self, tag: str, a: dict[str, str]) -> None:
        tag = tag.rpartition(":")[2]
        if not self.inside:
            self.inside = tag == "sheetData"
        elif tag == "row":
            self.free = "r" not in a
            self.row = self.row + 1 if self.free else int(a["r"])
            self.column = 0
            self.rows.append([self.row, self.place(), []])
        elif tag == "c" and self.rows:
            place = re.match(r"([A-Z]+)(\d*)", a.get("r", ""))
            self.column = column_number(place[1]) if place else self.column
            if self.free and place and place[2]:
                self.row = self.rows[-1][0] = max(self.row, int(place[2]))
                self.free = False
            self.cell = (a.get("s", "").encode(), a.get("t", "").encode())
            self.text, self.some = [], False
        elif tag == "rPh":
            self.skip += 1
        elif tag in ("v", "t") and self.cell and not self.skip:
            self.keep, self.some = True, True

    def end(self, tag: str) -> None:
        tag = tag.rpartition(":")[2]
        if tag in ("v", "t"):
            self.keep = False
        elif tag == "rPh":
            self.skip -= 1
        elif tag == "c" and self.cell:
            if self.some and (self.text or self.cell[1] in (b"str", b"inlineStr")):
                self.rows[-1][2].append((self.column, *self.cell, plain_text("".join(self.text)) if self.cell[1] in (b"str", b"inlineStr") else "".join(self.text)))
            self.column += 1
            self.cell = None
        elif tag == "sheetData":
            self.inside = False

    def data(self, text: str) -> None:
        if self.keep:
            self.text.append(text)


def parsed(blocks: Iterator[bytes], inside: bool = False, before: int = 0) -> Iterator[tuple[int, int, list[tuple[int, bytes, bytes, str]]]]:
    """All rows as (number, first byte, cells) by a full XML parser; a cut-off end raises expat.ExpatError after the rows before it.

    ``inside`` tells that the blocks begin within sheetData, behind row number ``before``.
    """
    handler, parser = _Handler(inside, before), expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = handler.start, handler.end, handler.data
    parser.buffer_text = True
    handler.place = lambda: parser.CurrentByteIndex
    for block in blocks:
        parser.Parse(block)
        whole = handler.rows[:-1]
        del handler.rows[:-1]
        yield from map(tuple, whole)
    yield from map(tuple, handler.rows)
    parser.Parse(b"", True)


class Odd(Exception):
    """Something that needs the XML parser: comments, CDATA, prefixes, or a row that doesn't name its place."""


def _strange(piece: bytes) -> bool:
    return (b"!" in piece and b"<!" in piece) or (b":" in piece and (b":row" in piece or b":c" in piece or b":v" in piece) and _PREFIXED.search(piece) is not None)


class _Ahead:
    """The bytes of a sheet up to the end of its rows: those in hand, and where they begin."""

    def __init__(self, sheet: Sheet, start: Point | None = None) -> None:
        self.blocks = inflated(sheet, start)
        self.held, self.at, self.ended = b"", start[1] if start else 0, False

    def more(self) -> bool:
        """Take another block in hand; raises Odd if it needs the parser."""
        block = b"" if self.ended else next(self.blocks, b"")
        if not block:
            return False
        edge = self.held[-64:]
        seam = edge + block[:64]
        at, within = seam.find(_END), block.find(_END)
        if at >= 0 or within >= 0:
            end = (at - len(edge) if at >= 0 else within) + len(_END)
            self.ended, seam, block = True, seam[: len(edge) + end], block[:end]
        if _strange(seam) or _strange(block):
            raise Odd
        self.held += block
        return True

    def drop(self, n: int) -> None:
        self.at, self.held = self.at + n, self.held[n:]

    def first(self, start: int) -> int:
        """Where the first row begins from ``start`` on, or -1."""
        m = _ROW.search(self.held, max(0, start))
        return m.start() if m else -1

    def last(self, end: int) -> int:
        """Where the last row begins before ``end``, or -1."""
        i = min(end, len(self.held)) + 4
        while (i := self.held.rfind(b"<row", 0, i)) >= 0:
            if i < end and self.held[i + 4 : i + 5] in (b" ", b"\t", b"\r", b"\n", b"/", b">"):
                return i
            i += 3
        return -1

    def number(self, i: int) -> int | None:
        """The number of the row that begins at i, None if its tag isn't all in hand; raises Odd if it has none."""
        close = self.held.find(b">", i)
        if close < 0:
            return None
        m = _PLACE.match(self.held, i, close + 1)
        if not m:
            raise Odd
        return int(m[1])


def all_placed(piece: bytes) -> bool:
    """Whether all rows of a piece name their places."""
    return len(_PLACE.findall(piece)) == len(_ROW.findall(piece))


def slices(sheet: Sheet, lo: int, hi: int) -> Iterator[tuple[int, bytes, int]]:
    """(number of the row before, bytes of whole rows, number of the last of them) of the rows that begin in [lo, hi) of the sheet's XML.

    The number is 0 where no row comes before. Rows are handed on in pieces of about a block. Raises Odd where the XML parser is needed,
    before lo too, except for places that are missing within a piece: ``cells`` and ``all_placed`` tell those. What comes before the
    last point in front of lo isn't looked at.
    """
    start = sheet.entry(lo)
    s, before = _Ahead(sheet, start), start[2] if start else 0
    while True:  # the last row that begins before lo
        far = s.at + len(s.held) >= lo + 5
        i = s.last(lo - s.at)
        if i >= 0:
            number = s.number(i)
            if number is None:
                if not s.more():
                    return
                continue
            before = number
            s.drop(i + 5)
        elif not far:
            s.drop(max(0, len(s.held) - 8))
        if far or not s.more():
            break
    while (i := s.first(lo - s.at)) < 0:  # the first that begins after
        s.drop(max(0, len(s.held) - 8))
        if not s.more():
            return
    if s.at + i >= hi:
        return
    s.drop(i)
    while True:
        beyond = s.first(hi - s.at)
        ended = beyond >= 0 or s.ended
        cut = beyond if beyond >= 0 else s.held.rfind(_END) if ended else s.last(len(s.held))
        if cut > 0:
            last = s.number(s.last(cut))
            yield before, s.held[:cut], last
            before = last
            s.drop(cut)
        if ended:
            return
        if not s.more():
            raise ValueError("the sheet is cut off")


def pieces(sheet: Sheet, start: Point | None) -> Iterator[tuple[int, bytes]]:
    """(first byte, whole rows) behind a point or from the beginning on, in pieces of about a block. Raises Odd at comments, CDATA and prefixes."""
    s = _Ahead(sheet, start)
    while (i := s.first(0)) < 0:
        s.drop(max(0, len(s.held) - 8))
        if not s.more():
            return
    s.drop(i)
    while True:
        cut = s.held.rfind(_END) if s.ended else s.last(len(s.held))
        if cut > 0:
            yield s.at, s.held[:cut]
            s.drop(cut)
        if s.ended:
            return
        if not s.more():
            raise ValueError("the sheet is cut off")


def parsed_from(sheet: Sheet, start: Point | None) -> Iterator[tuple[int, int, list[tuple[int, bytes, bytes, str]]]]:
    """All rows behind a point by the parser, or the whole sheet's."""
    if not start:
        yield from parsed(inflated(sheet))
        return
    opening = b"<sheetData>"

    def content():
        yield opening
        edge = b""
        for block in inflated(sheet, start):
            end = (edge + block).find(_END)
            if end >= 0:
                yield block[: end + len(_END) - len(edge)]
                return
            yield block
            edge = (edge + block)[-len(_END) + 1 :]

    yield from ((number, at + start[1] - len(opening), cells) for number, at, cells in parsed(content(), True, start[2]))


def _from(s: _Ahead) -> Iterator[bytes]:
    """What is in hand from its first row on and all rows that follow, as the content of one element."""
    i = s.first(0)
    yield b"<sheetData>"
    yield s.held[i:] if i >= 0 else _END
    edge = s.held[-len(_END) + 1 :]
    while i >= 0 and not s.ended and (block := next(s.blocks, b"")):
        end = (edge + block).find(_END)
        yield block if end < 0 else block[: end + len(_END) - len(edge)]
        s.ended, edge = end >= 0, (edge + block)[-len(_END) + 1 :]


def rows_after(sheet: Sheet, skip: int) -> Iterator[tuple[int, int, list[tuple[int, bytes, bytes, str]]]]:
    """Rows of numbers above ``skip`` by the parser; those before are looked through, block by block, and not held."""
    s = _Ahead(sheet, sheet.entry_of_row(skip))
    try:
        while skip and s.more():
            i = s.last(len(s.held))
            if i < 0:
                s.drop(max(0, len(s.held) - 8))
            elif (number := s.number(i)) is not None:
                if number > skip:
                    break
                s.drop(i)
    except Odd:
        s = None
    blocks = _from(s) if s and skip else inflated(sheet)
    yield from (row for row in parsed(blocks, bool(s and skip)) if row[0] > skip)


@dataclass(frozen=True)
class Cells:
    """Cells of a piece, one entry each: row number, column, style (0 if none), first byte of the type (0 if none), whether there is a value, value."""

    row: np.ndarray
    col: np.ndarray
    style: np.ndarray
    code: np.ndarray
    there: np.ndarray
    values: pa.Array


_LT, _GT, _QUOTE, _SPACE, _SLASH = b'<>" /'
#: Longest numbers that are read in place: rows and styles.
_DIGITS = 12


def _number_at(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the number whose digits begin at each place, where they end)."""
    value, at, on = np.zeros(len(at), np.int64), at.copy(), np.ones(len(at), bool)
    for _ in range(_DIGITS):
        digit = data[at] - 48  # unsigned: all else is 10 or more
        on &= digit < 10
        if not on.any():
            break
        value = np.where(on, value * 10 + digit, value)
        at += on
    return value, at


def _is(data: np.ndarray, at: np.ndarray, text: bytes) -> np.ndarray:
    out = np.ones(len(at), bool)
    for k, c in enumerate(text):
        out &= data[at + k] == c
    return out


def cells(piece: bytes) -> Cells | None:
    """All cells of whole rows in the spelling that writers use, told from the places of tags alone; None if anything is spelled otherwise.

    A row is ``<row r="1" ...>``, a cell ``<c r="A1" s="2" t="s"><v>3</v></c>`` without s, t or all that is within it; types are single letters.
    """
    told = _told(piece)
    return told and told[0]


def counted(piece: bytes, before: int) -> tuple[Cells, np.ndarray, np.ndarray] | None:
    """(cells, first byte of each row, number of each) of whole rows behind row number ``before``; rows ``<row>`` and cells may leave out their places.

    None where anything else is spelled otherwise than for ``cells``, or where places contradict each other or the order of rows.
    """
    return _told(piece, before)


def _told(piece: bytes, before: int | None = None) -> tuple[Cells, np.ndarray, np.ndarray] | None:
    data = np.frombuffer(piece + b"\0" * 64, np.uint8)
    tag = np.flatnonzero(data[: len(piece)] == _LT)
    kind = data[tag + 1]
    rows, found = np.flatnonzero(kind == 114), np.flatnonzero(kind == 99)  # r, c
    begin = tag[rows]
    named = _is(data, begin, b'<row r="')
    if not len(rows) or not (named.all() if before is None else (named | _is(data, begin, b"<row>")).all()):
        return None
    number, end = _number_at(data, begin + 8)
    closed = np.count_nonzero((kind == _SLASH) & (data[tag + 2] == 114))
    if not (data[end] == _QUOTE)[named].all():
        return None
    at = tag[found]
    placed = _is(data, at, b'<c r="')
    if not placed.all() and (before is None or not _is(data, at, b"<c").all()):
        return None
    own = np.searchsorted(rows, found) - 1
    if len(own) and own[0] < 0:
        return None
    one, two, three = (data[at + k].astype(np.int64) - 64 for k in (6, 7, 8))
    more, most = (two > 0) & (two < 27), (two > 0) & (two < 27) & (three > 0) & (three < 27)
    col = np.where(most, (one * 26 + two) * 26 + three, np.where(more, one * 26 + two, one)) - 1
    told, end = _number_at(data, at + 7 + more + most)
    if (((one < 1) | (one > 26) | (data[end] != _QUOTE)) & placed).any():
        return None
    if before is not None:
        number = _counted_on(number, named, told, placed, own, before)
        if number is None:
            return None
    if ((told != number[own]) & placed).any():
        return None
    if not placed.all():  # such a cell stands behind the one before, or first in its row
        index = np.arange(len(at))
        first = np.append(True, own[1:] != own[:-1])[: len(at)]
        col[first & ~placed] = 0
        fixed = np.maximum.accumulate(np.where(first | placed, index, 0))
        col = col[fixed] + index - fixed
    at = np.where(placed, end + 1, at + 2)
    if not len(found):
        none = Cells(*[np.empty(0, np.int64)] * 2, *[np.empty(0, np.uint8)] * 2, np.empty(0, bool), pa.array([], pa.string()))
        return (none, begin, number) if len(tag) == len(rows) + closed else None
    styled = (data[at] == _SPACE) & (data[at + 1] == 115)
    style = np.zeros(len(at), np.int64)
    if styled.any():
        where = np.flatnonzero(styled)
        if not _is(data, at[where], b' s="').all():
            return None
        style[where], end = _number_at(data, at[where] + 4)
        if not (data[end] == _QUOTE).all():
            return None
        at[where] = end + 1
    typed = (data[at] == _SPACE) & (data[at + 1] == 116)
    code = np.zeros(len(at), np.uint8)
    if typed.any():
        where = np.flatnonzero(typed)
        if not (_is(data, at[where], b' t="') & (data[at[where] + 5] == _QUOTE)).all():
            return None
        code[where] = data[at[where] + 4]
        at[where] += 6
    empty = (data[at] == _SLASH) & (data[at + 1] == _GT)
    full = np.flatnonzero(~empty)
    if len(tag) != len(rows) + closed + len(found) + 3 * len(full) or not (data[at[full]] == _GT).all():
        return None
    # The three tags behind a cell that isn't empty must be those of its value and its own end.
    inner = found[full]
    if len(inner) and inner[-1] + 3 >= len(tag):
        return None
    value, after, last = tag[inner + 1], tag[inner + 2], tag[inner + 3]
    if not ((value == at[full] + 1) & _is(data, value, b"<v>") & _is(data, after, b"</v>") & (last == after + 4) & _is(data, last, b"</c>")).all():
        return None
    size = np.zeros(len(found), np.int64)
    size[full] = after - value - 3
    ends = np.cumsum(size)
    text = np.zeros(len(found), np.int64)
    text[full] = value + 3
    source = np.repeat(text - (ends - size), size) + np.arange(int(ends[-1]))
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    values = pa.StringArray.from_buffers(len(found), pa.py_buffer(offsets), pa.py_buffer(data[source]))
    return Cells(number[own], col, style, code, size > 0, values), begin, number


def _counted_on(number: np.ndarray, named: np.ndarray, told: np.ndarray, placed: np.ndarray, own: np.ndarray, before: int) -> np.ndarray | None:
    """Numbers of rows: their own, or their first place in a cell, or one more than the row before; None if they don't ascend."""
    at = np.flatnonzero(placed)
    row, first = np.unique(own[at], return_index=True)
    known = np.where(named, number, 0)
    known[row] = np.where(named[row], number[row], told[at[first]])
    index = np.arange(1, len(number) + 1)
    out = np.maximum.accumulate(np.maximum(np.where(known > 0, known - index, before), before)) + index
    return out if (out == known)[named].all() else None


_EVEN_ROW = re.compile(rb'<row r="(\d+)">')
_EVEN_CELL = re.compile(rb'(<c r="([A-Z]+))(\d+)("(?: s="(\d+)")?(?: t="(\w)")?>)<v>[^<]*</v></c>')
#: Bytes of numbers. One with an exponent has a letter, which columns have too.
_NUMERIC = b"0123456789+-."


def even(piece: bytes, keep: frozenset[int]) -> tuple[int, int, dict[int, tuple[bytes, bytes, pa.Array | None]]] | None:
    """(first number, rows, (style, type, values if in ``keep``) of each column) of rows that all have the cells of the first one and follow each other, or None.

    Values are doubles, numbers of strings integers. All that isn't a value is held against what it must be: first without the bytes of numbers, then the lengths of all
    tags and the places in them, so that no such byte is elsewhere.
    """
    top = piece[: piece.find(b"</row>")]
    row = _EVEN_ROW.match(top)
    cells = list(_EVEN_CELL.finditer(top, row.end())) if row else []
    columns = [column_number(m[2].decode()) for m in cells]
    if not cells or row.end() + sum(len(m[0]) for m in cells) != len(top) or columns != sorted(set(columns)):
        return None
    frame, frames = (top + b"</row>").translate(None, _NUMERIC), piece.translate(None, _NUMERIC)
    n = len(frames) // len(frame)
    if frames != frame * n:
        return None
    data = np.frombuffer(piece, np.uint8)
    tag = np.flatnonzero(data == _LT).astype(np.int32)
    step = np.diff(tag, append=np.int32(len(piece)))
    at, step = (np.ascontiguousarray(x.reshape(n, -1).T) for x in (tag, step))  # a line for each tag of a row, and its length with what follows it
    number = np.arange(int(row[1]), int(row[1]) + n)
    digits = np.searchsorted(10 ** np.arange(1, 19), number, side="right") + 1
    lead, tail = (np.array([[len(m[k])] for m in cells]) for k in (1, 4))
    place = np.vstack([at[:1] + 8, at[1:-1:4] + lead])
    if not (
        (step[0] - digits == 10).all()
        and (step[1:-1:4] - digits == lead + tail).all()
        and (step[2:-1:4] > 3).all()
        and (data[at[2:-1:4] + 2] == _GT).all()
        and (step[3:-1:4] == 4).all()
        and (step[4:-1:4] == 4).all()
        and (step[-1] == 6).all()
    ):
        return None
    place += digits - 1
    for k in range(int(digits[-1])):  # from the last digit of each place on
        some = int(np.searchsorted(digits, k, side="right"))
        if not (data[place[:, some:]] == number[some:] // 10**k % 10 + 48).all():
            return None
        place -= 1
    out = {}
    for k, (c, m) in enumerate(zip(columns, cells)):
        begin = at[4 * k + 2]
        if m[5] and not _is(data, begin - len(m[4]), m[4]).all():
            return None
        out[c] = (m[5] or b"", m[6] or b"", None)
        if c in keep:
            size = step[4 * k + 2] - 3
            ends = np.cumsum(size)
            text = data[np.repeat(begin + 3 - (ends - size), size) + np.arange(int(ends[-1]))]
            values = pa.StringArray.from_buffers(n, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(text))
            try:
                out[c] = (*out[c][:2], values.cast(pa.int64() if m[6] == b"s" else pa.float64()))
            except pa.ArrowInvalid:
                return None
    return int(row[1]), n, out


def tokens(piece: bytes) -> list[tuple[bytes, bytes, bytes, bytes, bytes, bytes]] | None:
    """(column letters, row, style, type, value, inline string) of every cell, or None if some cell is written otherwise."""
    found = CELL.findall(piece)
    return found if len(found) == len(_CELL_START.findall(piece)) else None
