"""Header and type inference from the first two rows of a sheet."""

from __future__ import annotations

from dataclasses import dataclass

from .. import errors
from .options import BOOLEAN, DATE, DOUBLE, VARCHAR, ScanOptions

#: Kinds of cells. TEXT is a shared string, OTHER_TEXT an inline or formula string.
TEXT, NUMBER, FLAG, DAY, OTHER_TEXT, ERROR = range(6)
_COLUMN = {TEXT: (VARCHAR, "String"), NUMBER: (DOUBLE, "Numeric"), FLAG: (BOOLEAN, "Boolean"), DAY: (DATE, "Date")}


@dataclass(frozen=True)
class SheetPlan:
    """Columns of a scan; rows after ``start`` (1-based, exclusive) are data. ``width`` is that of the sheet."""

    names: tuple[str, ...]
    types: tuple[str, ...]
    start: int
    width: int


def compatible(column: str, kind: int, coerce: bool) -> bool:
    """Whether a cell of a kind is kept in a column of a type; others read as null."""
    if column == VARCHAR:
        return kind == TEXT or (coerce and kind in (NUMBER, FLAG, DAY))
    return _COLUMN.get(kind, ("",))[0] == column


def _kinds(cells: dict[int, tuple[int, object]], inline: bool) -> dict[int, int]:
    out = {}
    for column, (kind, _) in cells.items():
        if kind == OTHER_TEXT:
            if not inline:
                raise errors.SheetError(errors.INLINE_STRING.format(column=column))
            kind = TEXT
        if kind == ERROR:
            raise errors.SheetError(errors.ERROR_CELL.format(column=column))
        out[column] = kind
    return out


def _unique(names: list[str]) -> list[str]:
    """Names that differ without regard to case, by suffixes _1, _2."""
    seen: set[str] = set()
    out = []
    for name in names:
        new, k = name, 0
        while new.lower() in seen:
            k += 1
            new = f"{name}_{k}"
        # the suffix counts the names before it that are alike
        seen.add(new.lower())
        out.append(new)
    return out


def infer(rows: list[tuple[int, dict[int, tuple[int, object]]]], dimension_width: int, options: ScanOptions) -> SheetPlan:
    """The plan from the first rows after skip_rows: (row number, {column: (kind, text value of strings)}).

    The first two decide; further ones only give a type to columns that are empty there.
    """
    if not rows:
        raise errors.SheetError(errors.EMPTY_SHEET)
    if len(rows) < 2:
        raise errors.SheetError(errors.TOO_FEW_ROWS)
    inline = options.inline_strings == "read"
    (first_row, first_cells), (_, second_cells) = rows[:2]
    width = max([dimension_width, *(c + 1 for c in first_cells), *(c + 1 for c in second_cells)])
    if not width:
        raise errors.SheetError(errors.EMPTY_SHEET)
    first, second = _kinds(first_cells, inline), _kinds(second_cells, inline)
    first_strings = bool(first) and all(k == TEXT for k in first.values())
    second_strings = bool(second) and all(k == TEXT for k in second.values())
    if options.has_header and not first_strings:
        raise errors.SheetError(errors.HEADER_NOT_STRINGS)
    header = options.has_header or (first_strings and not second_strings)
    deciding = dict(second if header else first)
    for _, cells in rows[1 if not header else 2 :]:
        for column, (kind, _) in cells.items():
            kind = TEXT if kind == OTHER_TEXT and inline else kind
            if kind in _COLUMN and column < width:
                deciding.setdefault(column, kind)
    kinds = [deciding.get(c, TEXT) for c in range(width)]
    types = [_COLUMN[k][0] for k in kinds]
    names = [f"{_COLUMN[k][1]}{c}" for c, k in enumerate(kinds)]
    if header:
        names = [str(first_cells[c][1]) if c in first_cells else names[c] for c in range(width)]
    if options.types is not None:
        if len(options.types) < width:
            raise errors.SheetError(errors.FEW_TYPES.format(given=len(options.types), width=width))
        for c in range(width):
            declared = options.types[c]
            if declared != types[c] and not options.force_types and not (declared == VARCHAR and options.coerce_to_string):
                raise errors.SheetError(errors.TYPE_MISMATCH.format(declared=declared, column=c, inferred=types[c]))
        types = list(options.types)
        names += [f"Column {c}" for c in range(width, len(types))]
    return SheetPlan(tuple(_unique(names)), tuple(types), first_row if header else first_row - 1, width)
