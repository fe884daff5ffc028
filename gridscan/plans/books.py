"""Workbooks that the queries scan, written from the driver's tables once and kept by content."""

from __future__ import annotations

import datetime
import hashlib
import inspect
import os
import tempfile
from collections.abc import Callable, Iterable
from itertools import chain

from pyspark.sql import SparkSession

from .. import fixtures
from ..fixtures import CELL_LIMIT, Bare, Raw, Serial, table_rows, write_book
from . import large

Rows = Iterable[list]


def _folder(spark: SparkSession) -> str:
    """Below the folder that executors share, which must be mounted here; a session in one process may use a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or ""
    mounted = shared.startswith(("file:", "/"))
    if not mounted and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("workbooks of the queries need a spark.checkpoint.dir that is mounted on all nodes")
    top = "/" + shared.removeprefix("file:").lstrip("/") if mounted else tempfile.gettempdir()
    out = os.path.join(top, "gridscan-books")
    os.makedirs(out, exist_ok=True)
    return out


#: Parquet bytes of a table from which on tasks render its workbook.
LARGE = 2 << 20


def _is_large(sf_dir: str, name: str) -> bool:
    """Whether a table is large, or can't be seen from here."""
    path = f"{sf_dir}/{name}.parquet".removeprefix("file://")
    if os.path.isdir(path):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files) >= LARGE
    return not os.path.isfile(path) or os.path.getsize(path) >= LARGE


def _local_table(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """(a readable parquet file or folder, what tells its version)."""
    path = f"{sf_dir}/{name}.parquet".removeprefix("file://")
    if os.path.exists(path):
        return path, str(os.stat(path).st_mtime_ns)
    return "", ""


def rows_of(spark: SparkSession, sf_dir: str, name: str) -> Rows:
    """Header and rows of a table; text is clipped to the cell limit, however the table is stored."""
    path, _ = _local_table(spark, sf_dir, name)
    if path and os.path.isfile(path):
        yield from table_rows(path)
        return
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    yield df.columns
    yield from ([v[:CELL_LIMIT] if isinstance(v, str) else v for v in r] for r in df.toLocalIterator())


def book(spark: SparkSession, sf_dir: str, variant: str, tables: list[str], make: Callable[..., dict[str, Rows]], dimension: str | None = None) -> str:
    """The path of the workbook of a variant; ``make`` gets each table's rows and gives the sheets; where it has a ``large``, large tables are rendered by tasks instead. Its source and the writer's are part of the name."""
    version = [variant, inspect.getsource(fixtures), inspect.getsource(large), inspect.getsource(make), sf_dir, *(_local_table(spark, sf_dir, t)[1] for t in tables)]
    path = os.path.join(_folder(spark), f"{variant}-{hashlib.sha256('|'.join(version).encode()).hexdigest()[:16]}.xlsx")
    if not os.path.exists(path) and hasattr(make, "large") and _is_large(sf_dir, tables[0]):
        first, *more = tables
        rest = chain.from_iterable(rows_of(spark, sf_dir, t) for t in more)
        large.write(path, make.large.get("sheet", first), spark.read.parquet(f"{sf_dir}/{first}.parquet"), rest, make.large.get("bare", False))
    elif not os.path.exists(path):
        write_book(path, make(*(rows_of(spark, sf_dir, t) for t in tables)), dimension=dimension)
    return path


def table_book(spark: SparkSession, sf_dir: str, table: str) -> str:
    def make(rows: Rows) -> dict[str, Rows]:
        return {table: rows}

    make.large = {}
    return book(spark, sf_dir, table, [table], make)


def two_sheets(nation: Rows, region: Rows) -> dict[str, Rows]:
    return {"Nations": nation, "Regions": region}


def preamble(nation: Rows) -> dict[str, Rows]:
    return {"s": [["report"], ["made for tests", 1], [None, "x"], *nation]}


def deep_preamble(lineitem: Rows, nation: Rows) -> dict[str, Rows]:
    """All line items to be skipped, then the nations."""
    return {"s": chain(lineitem, nation)}


deep_preamble.large = {"sheet": "s"}


def bare_rows(orders: Rows) -> dict[str, Rows]:
    """The first third of the rows names its places; of the others some do, some have places in their cells alone, and most have none."""
    rows = list(orders)
    return {"s": [r if i < len(rows) // 3 or i % 997 == 5 else Bare(r, i % 7 == 3) for i, r in enumerate(rows)]}


bare_rows.large = {"sheet": "s", "bare": True}


def headerless(nation: Rows) -> dict[str, Rows]:
    return {"s": list(nation)[1:]}


def strings_only(part: Rows) -> dict[str, Rows]:
    return {"s": [[r[1], r[2]] for r in part]}


def flags(labels: Rows) -> dict[str, Rows]:
    head, *rows = labels
    return {"s": [head, *([r[0], r[1] == 1, r[2] == 1] for r in rows)]}


def mixed(customer: Rows) -> dict[str, Rows]:
    head, *rows = customer
    return {"s": [[*head[:2], head[3]], *([r[0], r[1], "n/a" if r[0] % 7 == 3 else r[3]] for r in rows)]}


def sparse(customer: Rows) -> dict[str, Rows]:
    head, *rows = customer
    return {"s": [head, *([r[0], *(None if r[0] % 5 == 0 and r[0] > 5 else v for v in r[1:])] for r in rows)]}


#: Rows that scan_row_gaps leaves out behind the nations, and the one that follows them.
GAP = 5000


def gaps(nation: Rows) -> dict[str, Rows]:
    rows = list(nation)
    return {"s": [*rows, (len(rows) + 1 + GAP, [-1, "after the gap", -2])]}


#: Date serials around 1970, where times of day are cut off towards it.
SERIALS = (43831, 43831.75, 25568.5, 25569, 25567.25, 1.0, 60.0, 25569.99)


def old_dates() -> dict[str, Rows]:
    return {"s": [["k", "d"], *([i, Serial(v)] for i, v in enumerate(SERIALS))]}


def inline(nation: Rows) -> dict[str, Rows]:
    head, *rows = nation
    return {"s": [head, *([r[0], Raw('t="inlineStr"', f"<is><t>{r[1]}</t></is>"), r[2]] for r in rows)]}


def day_of(serial: float) -> str:
    return (datetime.date(1970, 1, 1) + datetime.timedelta(days=int(serial - 25569))).isoformat()
