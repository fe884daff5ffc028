"""Errors of the worksheet scan. Each rule has a message of its own, which callers may match."""

from __future__ import annotations


class SheetError(ValueError):
    """Wrong options, a file that can't be read as asked, or a row that doesn't fit."""


NO_FILE = "no file matches the path: {path}"
MANY_FILES = "one workbook can be read at a time, but {count} files match: {path}"
NAME_AND_INDEX = "sheet_name and sheet_index exclude each other"
CANNOT_OPEN = "cannot open workbook {path}: {why}"
NO_SHEET_NAME = "workbook has no sheet named {name!r}"
NO_SHEET_INDEX = "workbook has no sheet number {index}; it has {count}"
BAD_OPTION = "option {name} must be {what}, not {value!r}"
UNKNOWN_OPTION = "unknown option: {name}"
UNKNOWN_TYPE = "unsupported type {name!r} in types; VARCHAR, DOUBLE, BOOLEAN and DATE are supported"
CANNOT_PARSE = "failed to parse sheet: {why}"
EMPTY_SHEET = "sheet is empty"
TOO_FEW_ROWS = "sheet needs at least two rows after skip_rows to tell its header and types"
HEADER_NOT_STRINGS = "has_header is set, but the first row holds cells that aren't strings"
INLINE_STRING = "inline and formula strings are not supported (column {column}); set inline_strings=read to read them"
ERROR_CELL = "cell of unknown type in column {column} of the rows that determine types"
FEW_TYPES = "types has {given} entries, but the sheet has {width} columns"
TYPE_MISMATCH = "declared type {declared} of column {column} does not fit its inferred type {inferred}"
WIDE_ROW = "row {row} has more columns than the first rows: it has {has}, expected {expected}"
FEW_FIELDS = "the given schema has {given} fields, but the sheet has {width} columns"
OTHER_FIELDS = "the given schema has {given} fields, but columns names {chosen}"
NO_COLUMN = "no column is named {name!r}; there are: {names}"
