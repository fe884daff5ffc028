"""Cells to Arrow columns: which cells a column keeps, and how values and coerced texts are made."""

from __future__ import annotations

import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .infer import DAY, FLAG, NUMBER, OTHER_TEXT, TEXT, compatible
from .options import BOOLEAN, DATE, DOUBLE, VARCHAR

ARROW = {VARCHAR: pa.string(), DOUBLE: pa.float64(), BOOLEAN: pa.bool_(), DATE: pa.date32()}
_EPOCH = datetime.date(1970, 1, 1).toordinal()


def days(serials: np.ndarray, date1904: bool) -> np.ndarray:
    """Days since 1970 of date serials; a time of day is cut off towards 1970.

    In the 1900 system serials below 60 read a day early, as the 29th of February 1900 counts in it.
    """
    return np.trunc(serials - (24107 if date1904 else 25569)).astype(np.int64)


def _numbers(values: pa.Array) -> np.ndarray:
    try:
        return pc.cast(values, pa.float64()).to_numpy(zero_copy_only=False)
    except pa.ArrowInvalid:
        return np.array([float(v) for v in values.to_pylist()], float)


def _dates(values: pa.Array, date1904: bool) -> np.ndarray:
    """Days of serials, or of ISO dates where a cell holds one."""
    try:
        return days(_numbers(values), date1904)
    except ValueError:
        out = []
        for v in values.to_pylist():
            try:
                out.append(int(days(np.array(float(v)), date1904)))
            except ValueError:
                out.append(datetime.date.fromisoformat(v[:10]).toordinal() - _EPOCH)
        return np.array(out, np.int64)


def _day_text(n: int) -> str:
    at = n + _EPOCH
    return datetime.date.fromordinal(at).isoformat() if 1 <= at <= datetime.date.max.toordinal() else str(np.datetime64(n, "D"))


def flags(values: pa.Array) -> np.ndarray:
    return pc.is_in(values, pa.array(["1", "true", "TRUE"])).to_numpy(zero_copy_only=False)


def column(kind_wanted: str, n: int, rows: np.ndarray, kinds: np.ndarray, values: pa.Array, strings: pa.Array, coerce: bool, date1904: bool, inline: bool) -> pa.Array:
    """One column of n rows from its cells; cells that don't fit and missing ones are null.

    ``values`` holds each cell's text: for shared strings the number in ``strings``. Of two cells in one place the later counts.
    """
    out_type = ARROW[kind_wanted]
    if inline:
        fits = [k for k in (TEXT, NUMBER, FLAG, DAY) if compatible(kind_wanted, k, coerce)] + [OTHER_TEXT] * (kind_wanted == VARCHAR)
    else:
        fits = [k for k in (TEXT, NUMBER, FLAG, DAY) if compatible(kind_wanted, k, coerce)]
    keep = np.isin(kinds, fits)
    if not keep.any():
        return pa.nulls(n, out_type)
    if not keep.all():
        rows, kinds, values = rows[keep], kinds[keep], values.filter(pa.array(keep))
    if kind_wanted == VARCHAR:
        got = _texts(kinds, values, strings, date1904)
    elif kind_wanted == DOUBLE:
        got = pa.array(_numbers(values))
    elif kind_wanted == BOOLEAN:
        got = pa.array(flags(values))
    else:
        got = pa.array(_dates(values, date1904).astype(np.int32), pa.int32()).cast(pa.date32())
    if len(rows) == n and (rows == np.arange(n)).all():
        return got
    at = np.full(n, -1, np.int64)
    at[rows] = np.arange(len(rows))
    return got.take(pa.array(np.where(at < 0, 0, at), mask=at < 0))


def _texts(kinds: np.ndarray, values: pa.Array, strings: pa.Array, date1904: bool) -> pa.Array:
    if (kinds == TEXT).all():
        return strings.take(pc.cast(values, pa.int64()))
    out = np.empty(len(kinds), object)
    for kind in np.unique(kinds).tolist():
        at = np.flatnonzero(kinds == kind)
        some = values.take(pa.array(at))
        if kind == TEXT:
            out[at] = strings.take(pc.cast(some, pa.int64())).to_pylist()
        elif kind == NUMBER:
            out[at] = ["%f" % x for x in _numbers(some).tolist()]
        elif kind == FLAG:
            out[at] = np.where(flags(some), "TRUE", "FALSE")
        elif kind == DAY:
            out[at] = [_day_text(x) for x in _dates(some, date1904).tolist()]
        else:
            out[at] = some.to_pylist()
    return pa.array(out.tolist(), pa.string())
