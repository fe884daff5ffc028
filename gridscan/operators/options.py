"""Options of the scan, checked alike for the data source and the table function."""

from __future__ import annotations

import json
from dataclasses import dataclass

from .. import errors

VARCHAR, DOUBLE, BOOLEAN, DATE = "VARCHAR", "DOUBLE", "BOOLEAN", "DATE"
#: The type names that stand for each of the four types, in any case.
ALIASES = {
    VARCHAR: ("VARCHAR", "TEXT", "STRING", "CHAR", "BPCHAR", "NVARCHAR"),
    DOUBLE: ("DOUBLE", "FLOAT8"),
    BOOLEAN: ("BOOLEAN", "BOOL", "LOGICAL"),
    DATE: ("DATE",),
}
_TYPES = {alias: name for name, group in ALIASES.items() for alias in group}


@dataclass(frozen=True)
class ScanOptions:
    """One scan. ``sheet_name`` wins where it is set; ``threads`` 0 lets the scan choose."""

    path: str
    sheet_name: str = ""
    sheet_index: int = 1
    threads: int = 0
    skip_rows: int = 0
    has_header: bool = False
    types: tuple[str, ...] | None = None
    force_types: bool = False
    coerce_to_string: bool = False
    inline_strings: str = "error"
    columns: tuple[str, ...] | None = None


def type_name(raw: str) -> str:
    """One of the four types; lengths as in VARCHAR(10) are ignored."""
    name, _, rest = str(raw).strip().upper().partition("(")
    found = _TYPES.get(name.strip())
    if found is None or (rest and found != VARCHAR):
        raise errors.SheetError(errors.UNKNOWN_TYPE.format(name=raw))
    return found


def _integer(name: str, value, least: int) -> int:
    try:
        if isinstance(value, (bool, float)):
            raise ValueError
        number = int(value)
    except (TypeError, ValueError):
        number = least - 1
    if number < least:
        raise errors.SheetError(errors.BAD_OPTION.format(name=name, what=f"an integer of at least {least}", value=value))
    return number


def _boolean(name: str, value) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise errors.SheetError(errors.BAD_OPTION.format(name=name, what="true or false", value=value))
    return text == "true"


def chosen(columns: tuple[str, ...] | None, names: tuple[str, ...]) -> tuple[int, ...]:
    """Numbers of the named columns, in any case; all if none are named."""
    if columns is None:
        return tuple(range(len(names)))
    at = {n.lower(): c for c, n in enumerate(names)}
    for n in columns:
        if n.lower() not in at:
            raise errors.SheetError(errors.NO_COLUMN.format(name=n, names=", ".join(names)))
    return tuple(dict.fromkeys(at[n.lower()] for n in columns))


def _names(value) -> tuple[str, ...]:
    """Names from an array, a JSON list or a list parted by commas."""
    if isinstance(value, str):
        try:
            value = json.loads(value) if value.strip().startswith("[") else value.split(",")
        except ValueError:
            raise errors.SheetError(errors.BAD_OPTION.format(name="columns", what="a list of names", value=value)) from None
    found = tuple(str(x).strip() for x in value)
    if not found or not all(found):
        raise errors.SheetError(errors.BAD_OPTION.format(name="columns", what="a list of names", value=value))
    return found


def _types(value) -> tuple[str, ...]:
    if isinstance(value, str):
        text = value.strip()
        if text.startswith("["):
            try:
                value = json.loads(text)
            except ValueError:
                value = [x for x in text.strip("[]").split(",") if x.strip()]
        else:
            value = [x for x in text.split(",") if x.strip()]
    return tuple(type_name(x) for x in value)


def parse(raw: dict) -> ScanOptions:
    """Options from names in any case; values may be strings. Null counts as not given."""
    given = {k.lower(): v for k, v in raw.items() if v is not None}
    if "paths" in given:
        paths = json.loads(given.pop("paths")) if isinstance(given["paths"], str) else given.pop("paths")
        if len(paths) > 1:
            raise errors.SheetError(errors.MANY_FILES.format(count=len(paths), path=paths))
        given.setdefault("path", *paths)
    path = given.pop("path", "")
    if not path:
        raise errors.SheetError(errors.NO_FILE.format(path=path))
    if given.get("sheet_name") and "sheet_index" in given:
        raise errors.SheetError(errors.NAME_AND_INDEX)
    out: dict = {}
    for name, value in given.items():
        if name == "sheet_name":
            out[name] = str(value)
        elif name in ("sheet_index", "threads", "skip_rows"):
            out[name] = _integer(name, value, 0 if name == "skip_rows" else 1)
        elif name in ("has_header", "force_types", "coerce_to_string"):
            out[name] = _boolean(name, value)
        elif name == "types":
            out[name] = _types(value)
        elif name == "columns":
            out[name] = _names(value)
        elif name == "inline_strings":
            if value not in ("error", "read"):
                raise errors.SheetError(errors.BAD_OPTION.format(name=name, what="error or read", value=value))
            out[name] = value
        else:
            raise errors.SheetError(errors.UNKNOWN_OPTION.format(name=name))
    return ScanOptions(str(path), **out)
