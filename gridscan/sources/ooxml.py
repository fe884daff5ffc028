"""Workbooks: files, sheets, styles and shared strings."""

from __future__ import annotations

import glob
import json
import os
import re
import struct
import zipfile
import zlib
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from posixpath import dirname, join, normpath
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .. import errors
from ..operators.options import ScanOptions

#: Built-in number formats that show dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
_SURROGATE = re.compile("[\ud800-\udfff]")
_ESCAPE = re.compile(r"_x([0-9A-Fa-f]{4})_")
#: An optional part of the workbook that tells where large parts can be entered: {part: {"size", "crc", "points"}}.
POINTS = "gridscan/points.json"
#: (deflated offset, offset, rows or strings before it).
Point = tuple[int, int, int]
_QUOTED = re.compile(r'"[^"]*"|\[(?![hms]+\])[^\]]*\]|\\.|_.|\*.', re.I)


def resolve(path: str) -> str:
    """The one file that a path or pattern names; URIs go through Arrow's file systems."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        found = sorted(glob.glob(path)) if glob.has_magic(path) and not os.path.exists(path) else [path] * os.path.isfile(path)
    else:
        found = _remote(path)
    if not found:
        raise errors.SheetError(errors.NO_FILE.format(path=path))
    if len(found) > 1:
        raise errors.SheetError(errors.MANY_FILES.format(count=len(found), path=path))
    return found[0]


def _remote(path: str) -> list[str]:
    from fnmatch import fnmatchcase

    from pyarrow import fs

    scheme = path.partition("://")[0]
    folder, _, name = path.rpartition("/")
    store, top = fs.FileSystem.from_uri(folder)
    names = store.get_file_info(fs.FileSelector(top, allow_not_found=True))
    return [f"{folder}/{x.base_name}" for x in sorted(names, key=lambda x: x.path) if x.type == fs.FileType.File and fnmatchcase(x.base_name, name) and scheme]


def open_file(path: str):
    """A seekable binary file."""
    if "://" not in path:
        return open(path, "rb")
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_file(at)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


@dataclass(frozen=True)
class Sheet:
    """What a scan task needs to know of a workbook."""

    path: str
    part: str
    size: int
    crc: int
    strings_part: str
    date_styles: frozenset[int]
    date1904: bool
    #: Where the sheet and the string table can be entered, from the beginning on; empty if nowhere else.
    points: tuple[Point, ...] = ()
    string_points: tuple[Point, ...] = ()
    strings_size: int = 0

    def entry(self, offset: int) -> Point | None:
        """The last point at or before a byte of the sheet's XML."""
        k = bisect_right(self.points, offset, key=lambda p: p[1])
        return self.points[k - 1] if k > 1 else None

    def entry_of_row(self, number: int) -> Point | None:
        """The last point that no row above a number comes before."""
        k = bisect_right(self.points, number, key=lambda p: p[2])
        return self.points[k - 1] if k > 1 else None


def locate(options: ScanOptions) -> Sheet:
    """Find the sheet and read the small parts of the workbook."""
    path = resolve(options.path)
    try:
        with open_file(path) as f, zipfile.ZipFile(f) as z:
            return _locate(z, path, options)
    except errors.SheetError:
        raise
    except Exception as e:
        raise errors.SheetError(errors.CANNOT_OPEN.format(path=path, why=e)) from e


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, tuple[str, str]]:
    name = join(dirname(part), "_rels", part.rpartition("/")[2] + ".rels")
    if name not in z.namelist():
        return {}
    out = {}
    for e in ElementTree.fromstring(z.read(name)):
        to = e.get("Target", "")
        out[e.get("Id", "")] = (e.get("Type", "").rpartition("/")[2], to.lstrip("/") if to.startswith("/") else normpath(join(dirname(part), to)))
    return out


def _locate(z: zipfile.ZipFile, path: str, options: ScanOptions) -> Sheet:
    names = set(z.namelist())
    book = next((to for kind, to in _relations(z, "").values() if kind == "officeDocument"), "xl/workbook.xml")
    root = ElementTree.fromstring(z.read(book))
    relations = _relations(z, book)
    sheets, date1904 = [], False
    for e in root.iter():
        if _local(e.tag) == "sheet":
            to = next((v for k, v in e.attrib.items() if _local(k) == "id"), "")
            kind, part = relations.get(to, ("", ""))
            if kind in ("worksheet", ""):
                sheets.append((e.get("name", ""), part))
        elif _local(e.tag) == "workbookPr":
            date1904 = e.get("date1904", "0").lower() in ("1", "true")
    if options.sheet_name:
        part = next((p for n, p in sheets if n == options.sheet_name), None)
        if part is None:
            raise errors.SheetError(errors.NO_SHEET_NAME.format(name=options.sheet_name))
    elif options.sheet_index > len(sheets):
        raise errors.SheetError(errors.NO_SHEET_INDEX.format(index=options.sheet_index, count=len(sheets)))
    else:
        part = sheets[options.sheet_index - 1][1]
    kinds = {kind: to for kind, to in relations.values()}
    strings, styles = kinds.get("sharedStrings", "xl/sharedStrings.xml"), kinds.get("styles", "xl/styles.xml")
    dates = _date_styles(z.read(styles)) if styles in names else frozenset()
    info = z.getinfo(part)
    strings = strings if strings in names else ""
    points = json.loads(z.read(POINTS)) if POINTS in names else {}
    return Sheet(path, part, info.file_size, info.CRC, strings, dates, date1904, _points(z, points, part), _points(z, points, strings), z.getinfo(strings).file_size if strings else 0)


def _points(z: zipfile.ZipFile, found: dict, part: str) -> tuple[Point, ...]:
    """The points of a part, unless another program has changed it."""
    if part not in found or (found[part]["crc"], found[part]["size"]) != (z.getinfo(part).CRC, z.getinfo(part).file_size):
        return ()
    return tuple(map(tuple, found[part]["points"]))


def inflated_from(path: str, part: str, offset: int, block: int) -> Iterator[bytes]:
    """A part from a point on, in blocks."""
    with open_file(path) as f:
        with zipfile.ZipFile(f) as z:
            info = z.getinfo(part)
        f.seek(info.header_offset)
        name, extra = struct.unpack("<26xHH", f.read(30))
        f.seek(info.header_offset + 30 + name + extra + offset)
        left, d = info.compress_size - offset, zlib.decompressobj(-15)
        while left > 0 and not d.eof:
            raw = f.read(min(left, 1 << 18))
            if not raw:
                raise ValueError(f"{part} is cut off")
            left -= len(raw)
            while raw:
                if out := d.decompress(raw, block):
                    yield out
                raw = d.unconsumed_tail
        if out := d.flush():
            yield out


def shows_dates(code: str) -> bool:
    """Whether a number format holds date or time signs outside quotes, colours and escapes; elapsed times count."""
    plain = _QUOTED.sub("", code.split(";")[0])
    return plain.strip().lower() != "general" and bool(re.search(r"[dmyhs]", plain, re.I))


def _date_styles(raw: bytes) -> frozenset[int]:
    root = ElementTree.fromstring(raw)
    custom = {int(e.get("numFmtId", -1)): e.get("formatCode", "") for e in root.iter() if _local(e.tag) == "numFmt"}
    formats = next((e for e in root if _local(e.tag) == "cellXfs"), ())
    ids = [int(x.get("numFmtId", 0)) for x in formats]
    return frozenset(i for i, n in enumerate(ids) if (shows_dates(custom[n]) if n in custom else n in DATE_FORMATS))


def _whole(text: str) -> str:
    """Text whose surrogates are joined to characters where they pair and replaced by U+FFFD where they don't."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if _SURROGATE.search(text) else text


def plain_text(text: str) -> str:
    """Text with _xHHHH_ escapes resolved; two that form a surrogate pair are one character."""
    return _whole(_ESCAPE.sub(lambda m: chr(int(m[1], 16)), text)) if "_x" in text else text


def unescape(text: str) -> str:
    """Text of an XML fragment without tags."""
    if "&" in text:
        text = _whole(re.sub(r"&(#x[0-9A-Fa-f]+|#\d+|amp|lt|gt|quot|apos);", _entity, text))
    return plain_text(text.replace("\r\n", "\n").replace("\r", "\n") if "\r" in text else text)


#: The entities that XML defines.
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _entity(m: re.Match) -> str:
    name = m[1]
    if name[0] != "#":
        return _NAMED[name]
    code = int(name[2:], 16) if name[1] == "x" else int(name[1:])
    return chr(code) if code < 0x110000 else "\ufffd"


_SIMPLE = re.compile(rb"<si><t(?: [^>]*)?>([^<]*)</t></si>")
_strings: OrderedDict[tuple, pa.Array | Strings] = OrderedDict()


class Strings:
    """A string table that is read in parts, as strings are taken; the last ones are kept."""

    #: Bytes of kept parts, besides the last one.
    KEPT = 32 << 20

    def __init__(self, sheet: Sheet) -> None:
        self.sheet, self.held = sheet, OrderedDict()
        self.firsts = np.array([p[2] for p in sheet.string_points])

    def _part(self, k: int) -> pa.Array:
        if k not in self.held:
            points, size = self.sheet.string_points, self.sheet.strings_size
            left = (points[k + 1][1] if k + 1 < len(points) else size) - points[k][1]
            blocks = []
            for block in inflated_from(self.sheet.path, self.sheet.strings_part, points[k][0], 1 << 20):
                blocks.append(block[:left])
                left -= len(blocks[-1])
                if not left:
                    break
            self.held[k] = _read_strings(b"".join(blocks))
            while len(self.held) > 1 and sum(x.nbytes for x in self.held.values()) > self.KEPT:
                self.held.popitem(last=False)
        self.held.move_to_end(k)
        return self.held[k]

    def __getitem__(self, i: int) -> pa.Scalar:
        return self.take(pa.array([i]))[0]

    def take(self, at: pa.Array) -> pa.Array:
        at = at.to_numpy(zero_copy_only=False)
        own = np.searchsorted(self.firsts, at, side="right") - 1
        order = np.argsort(own, kind="stable")
        parts, edges = np.unique(own[order], return_index=True)
        some = [self._part(k).take(pa.array(at[w] - self.firsts[k])) for k, w in zip(parts.tolist(), np.split(order, edges[1:]))]
        out = pa.concat_arrays(some) if some else pa.array([], pa.string())
        if (order[1:] > order[:-1]).all():
            return out
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return out.take(pa.array(back))


def shared_strings(sheet: Sheet) -> pa.Array | Strings:
    """The workbook's string table; a worker keeps the last two it has read. One that can be entered isn't read as a whole."""
    if not sheet.strings_part:
        return pa.array([], pa.string())
    with open_file(sheet.path) as f, zipfile.ZipFile(f) as z:
        info = z.getinfo(sheet.strings_part)
        key = (sheet.path, sheet.strings_part, info.CRC, info.file_size)
        if key not in _strings:
            _strings[key] = Strings(sheet) if len(sheet.string_points) > 1 else _read_strings(z.read(info))
            while len(_strings) > 2:
                _strings.popitem(last=False)
    return _strings[key]


def _unescaped(texts: pa.Array) -> pa.Array:
    """``unescape`` of each text; those with named entities alone are done together."""
    odd = pc.or_(pc.or_(pc.match_substring(texts, "_x"), pc.match_substring(texts, "&#")), pc.match_substring(texts, "\r"))
    plain = texts
    for name, sign in sorted(_NAMED.items(), key=lambda x: x[0] == "amp"):
        plain = pc.replace_substring(plain, f"&{name};", sign)
    if not pc.any(odd).as_py():
        return plain
    return pc.replace_with_mask(plain, odd, pa.array([unescape(x) for x in texts.filter(odd).to_pylist()], pa.string()))


def _read_strings(raw: bytes) -> pa.Array:
    simple = _SIMPLE.findall(raw)
    if len(simple) == len(re.findall(rb"<(?:\w+:)?si[ />]", raw)) and b"<!" not in raw:
        if b"&" not in raw and b"_x" not in raw and b"\r" not in raw:
            return pa.array(simple, pa.binary()).cast(pa.string())
        return _unescaped(pa.array(simple, pa.binary()).cast(pa.string()))
    out: list[str] = []
    for item in ElementTree.fromstring(raw):
        if _local(item.tag) != "si":
            continue
        text = []
        for e in item:
            if _local(e.tag) == "t":
                text.append(e.text or "")
            elif _local(e.tag) == "r":
                text += [t.text or "" for t in e if _local(t.tag) == "t"]
        out.append(plain_text("".join(text)))
    return pa.array(out, pa.string())
