"""Workbooks that tasks render, and reading them from their points on."""

import datetime
import json
import random
import zipfile
import zlib

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridscan.operators import options as opts
from gridscan.plans import books, large
from gridscan.plans.oracles import ORACLE_SQL
from gridscan.plans.queries import QUERIES
from gridscan.sources import ooxml
from gridscan.sources import rows as xml
from gridscan.sources import sheet as sheets
from gridscan.sources.sheet import batches, bind

N = 30_000
ODD = ("a & b < c > d", "_x0041_", "two\r\nlines\rthree", "&#13; &amp;lt;", " \x01\x1f\t ", "", "\U0001f600", "_x_x000D_")


def flat(scan, lo, hi):
    return [r for b in batches(scan, lo, hi) for r in zip(*(c.to_pylist() for c in b.columns))]


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    folder = tmp_path_factory.mktemp("large")
    none = lambda values, k: [None if i % k == 1 else v for i, v in enumerate(values)]
    at = datetime.datetime(1999, 12, 31, 18)
    out = pa.table({
        "k": range(N),
        "text": none([f"{ODD[i % 8]}{i if i % 3 else ''}" + "x" * (i % 90) for i in range(N)], 11),
        "price": none([i / 7 for i in range(N)], 13),
        "flag": none([i % 2 == 0 for i in range(N)], 17),
        "day": none([at.date() + datetime.timedelta(i % 5000) for i in range(N)], 19),
        "time": none([at + datetime.timedelta(hours=i % 5000) for i in range(N)], 23),
    })
    pq.write_table(out, folder / "t.parquet", row_group_size=9000)
    return folder


@pytest.fixture(scope="module")
def book(spark, table):
    df = spark.read.parquet(str(table / "t.parquet"))
    return large.write(str(table / "t.xlsx"), "s", df.union(df.limit(7)), [["behind", "late", None, None, None, None], [N, "late"]])


@pytest.fixture(scope="module")
def want(table):
    rows = [tuple(v.date() if isinstance(v, datetime.datetime) else float(v) if type(v) is int else v for v in r.values()) for r in pq.read_table(table / "t.parquet").to_pylist()]
    return [*rows, *rows[:7], (None, "late", None, None, None, None), (float(N), "late", None, None, None, None)]


def test_large_book_reads_back(spark, book, want):
    assert zipfile.ZipFile(book).testzip() is None
    df = spark.read.format("gridscan")
    from gridscan import register

    register(spark)
    got = [tuple(r) for r in df.option("threads", 5).load(book).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_pieces_are_copied_at_once(spark, table, monkeypatch):
    """Each to its own place, whichever is done first; one that is cut off is told."""
    import threading

    copy, both = large._copy, threading.Barrier(2, timeout=20)

    def late(p, out, at):
        if not isinstance(p.data, bytes):
            both.wait()  # two pieces are on their way
        copy(p, out, at)

    monkeypatch.setattr(large, "_copy", late)
    monkeypatch.setattr(large, "COPIED", 1000)
    path = large.write(str(table / "copied.xlsx"), "s", spark.range(20_000).selectExpr("id AS k", "concat('t', id) AS s").repartition(2, "k").persist())
    assert zipfile.ZipFile(path).testzip() is None
    scan = bind(opts.parse({"path": path}))
    assert sorted(flat(scan, 0, scan.sheet.size)) == [(float(i), f"t{i}") for i in range(20_000)]
    (table / "cut").write_bytes(b"123")
    with open(table / "to", "w+b") as out, pytest.raises(RuntimeError, match="has 3 bytes, not 4"):
        copy(large.Piece(str(table / "cut"), 9, 4, 0, [], 1), out.fileno(), 5)


def test_large_book_is_cut_anywhere(book, want):
    scan = bind(opts.parse({"path": book}))
    assert len(scan.sheet.points) > 2 and len(scan.sheet.string_points) > 1
    r = random.Random(1)
    edges = sorted({0, scan.sheet.size, *(p[1] + d for p in scan.sheet.points for d in (-1, 0, 1) if p[1]), *(r.randrange(scan.sheet.size) for _ in range(5))})
    got = [x for lo, hi in zip(edges, edges[1:]) for x in flat(scan, lo, hi)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    whole = flat(scan, 0, scan.sheet.size)
    assert got == whole


def test_bare_rows_are_cut_anywhere(spark, table):
    df = spark.range(40_000).selectExpr("id AS k", "concat('t', id % 5) AS s", "id * 2 AS d").coalesce(3)
    path = large.write(str(table / "bare.xlsx"), "s", df, bare=True)
    scan = bind(opts.parse({"path": path}))
    edges = [0, *(p[1] for p in scan.sheet.points[1:]), scan.sheet.size // 2 + 77, scan.sheet.size]
    got = [x for lo, hi in zip(sorted(edges), sorted(edges)[1:]) for x in flat(scan, lo, hi)]
    assert len(scan.sheet.points) > 1 and sorted(got) == [(float(i), f"t{i % 5}", i * 2.0) for i in range(40_000)]
    found = set(zipfile.ZipFile(path).read(scan.sheet.part).split(b"<row")[2].split(b">")[:1])
    assert found == {b' r="2"'}


def test_bare_rows_need_no_parser(spark, table, monkeypatch):
    """In one task or many, the sheet's first block aside, which is bound by the parser."""
    df = spark.range(40_000).selectExpr("id AS k", "concat('t', id % 5) AS s", "id * 2 AS d").coalesce(3)
    scan = bind(opts.parse({"path": large.write(str(table / "bare2.xlsx"), "s", df, bare=True)}))
    monkeypatch.setattr(xml, "parsed", None)
    for edges in ([0, scan.sheet.size], [0, scan.sheet.size // 2 + 99, scan.sheet.size]):
        assert [x for lo, hi in zip(edges, edges[1:]) for x in flat(scan, lo, hi)] == [(float(i), f"t{i % 5}", i * 2.0) for i in range(40_000)]


@pytest.mark.parametrize("seed", range(40))
def test_counted_rows_are_those_of_the_parser(seed):
    r, n, out, told = random.Random(seed), 7, [], 0
    for _ in range(r.randrange(1, 30)):
        named, n = r.random() < 0.4, n + 1
        if r.random() < 0.3 and (named or r.random() < 0.5):
            n, at_once = n + r.randrange(5), True
        else:
            at_once = False
        c, cells = -1, []
        for k in range(r.randrange(6)):
            placed = r.random() < 0.5 or at_once and not named and not k
            c = c + r.randrange(1, 60) if placed else c + 1
            kind, v = r.choice([("", "<v>1.5</v>"), (' t="s"', "<v>3</v>"), (' s="1"', "<v>9</v>"), (' s="1" t="b"', "<v>1</v>"), ("", None)])
            place = f' r="{large.letters(c)}{n}"' if placed else ""
            cells.append(f"<c{place}{kind}>{v}</c>" if v else f"<c{place}{kind}/>")
        if at_once and not named and not cells:
            named = True
        out.append((f'<row r="{n}">' if named else "<row>") + "".join(cells) + "</row>")
    piece = "".join(out).encode()
    found, begin, number = xml.counted(piece, 7)
    want = list(xml.parsed(iter([b"<sheetData>", piece, b"</sheetData>"]), True, 7))
    assert list(zip(number.tolist(), (begin + len("<sheetData>")).tolist())) == [x[:2] for x in want]
    flat_want = [(row, c, int(style or 0), kind[:1] or b"\0", v) for row, _, cells in want for c, style, kind, v in cells]
    there = found.there
    assert list(zip(found.row[there].tolist(), found.col[there].tolist(), found.style[there].tolist(), (bytes([c]) for c in found.code[there].tolist()), found.values.filter(pa.array(there)).to_pylist())) == flat_want


@pytest.mark.parametrize("piece", ['<row r="9"></row><row r="9"></row>', '<row><c r="B5"><v>1</v></c></row>', '<row><c r="B9"><v>1</v></c><c r="C8"/></row>', '<row spans="1:2"><c><v>1</v></c></row>', "<row/>", '<row><c s="1" r="A9"><v>1</v></c></row>', '<row><c r="A"><v>1</v></c></row>'])
def test_what_is_not_counted_is_left_to_the_parser(piece):
    assert xml.counted(piece.encode(), 7) is None


def _even_rows(n, change=lambda i, row: row):
    return "".join(change(i, f'<row r="{i}"><c r="A{i}"><v>{i}.25</v></c><c r="C{i}" s="1"><v>{i}</v></c><c r="AB{i}" t="s"><v>{i - 5}</v></c></row>') for i in range(5, 5 + n)).encode()


def test_even_rows_are_told_without_cells():
    first, n, found = xml.even(_even_rows(7), frozenset({0, 27}))
    assert (first, n, {c: (s, t, v and v.to_pylist()) for c, (s, t, v) in found.items()}) == (
        5, 7, {0: (b"", b"", [i + 0.25 for i in range(5, 12)]), 2: (b"1", b"", None), 27: (b"", b"s", list(range(7)))},
    )


@pytest.mark.parametrize("change", [
    lambda row: row.replace("<v>8.25</v>", "<v>8/25</v>"), lambda row: row.replace("<v>8.25</v>", "<v>v8</v>"), lambda row: row.replace("<v>8.25</v>", "<v>8>2</v>"),
    lambda row: row.replace("<v>8.25</v>", "<v></v>"), lambda row: row.replace("<v>8.25</v>", "<v/>"), lambda row: row.replace("<v>8.25</v>", "<f>1</f><v>8.25</v>"), lambda row: row.replace("C8", "D8"),
    lambda row: row.replace("8", "9"), lambda row: row + "<row/>", lambda row: row + " ", lambda row: row.replace(' s="1"', ""), lambda row: row.replace('t="s"', 't="b"'), lambda row: row.replace('<row r="8">', '<row r="8" spans="1:3">'),
    lambda row: "", lambda row: row.replace('<c r="C8" s="1"><v>8</v></c>', ""), lambda row: row.replace("<v>8.25</v>", "<v>8.25\n</v>"),
])
def test_uneven_rows_are_left_to_cells(change):
    assert xml.even(_even_rows(7, lambda i, row: change(row) if i == 8 else row), frozenset({0, 2, 27})) is None


def test_even_rows_pass_tens():
    """Places of more digits in the same piece, and columns that are named like exponents."""
    piece = "".join(f'<row r="{i}"><c r="E{i}" s="1"><v>{i / 8}</v></c><c r="XFD{i}"><v>-{i}</v></c></row>' for i in range(7, 12_345)).encode()
    first, n, found = xml.even(piece, frozenset({4, 16_383}))
    assert (first, n, sorted(found)) == (7, 12_338, [4, 16_383])
    assert found[4][2].to_pylist() == [i / 8 for i in range(7, 12_345)] and found[16_383][2].to_pylist() == [float(-i) for i in range(7, 12_345)]
    assert xml.even(piece.replace(b'"E9999"', b'"E9998"'), frozenset({4})) is None


@pytest.mark.parametrize("change", [
    lambda row: row.replace("<v>8.25</v>", "<v>nan</v>"), lambda row: row.replace('<c r="A8"><v>8', '<c r="A"><v>88'), lambda row: row.replace('s="1"', 's="2"'), lambda row: row.replace("<v>8.25", "<8v>.25"),
    lambda row: row.replace('"A8"', '"8A"'), lambda row: row.replace('s="1"><v>8', 's=""><v>18'), lambda row: row.replace("</row>", "</r1ow>"), lambda row: row.replace("<v>8.25", "<v>8.2-5"),
])
def test_bytes_of_numbers_elsewhere_are_left_to_cells(change):
    assert xml.even(_even_rows(7, lambda i, row: change(row) if i == 8 else row), frozenset({0, 2, 27})) is None


def test_even_rows_of_a_scan(spark, table, monkeypatch):
    """Whole and even sheets need no list of cells, and read the same as by one."""
    df = spark.range(20_000).selectExpr("id AS k", "concat('t', id % 5) AS s", "id / 7 AS d", "date_add(DATE '1999-01-01', CAST(id % 900 AS INT)) AS day").coalesce(1)
    path = large.write(str(table / "even.xlsx"), "s", df)
    scan, part = bind(opts.parse({"path": path})), bind(opts.parse({"path": path, "columns": "day,k"}))
    edges = [0, scan.sheet.size // 3, scan.sheet.size]
    monkeypatch.setattr(sheets, "MISSES", 0)
    want = [[x for lo, hi in zip(edges, edges[1:]) for x in flat(s, lo, hi)] for s in (scan, part)]
    monkeypatch.setattr(sheets, "MISSES", 4)
    seen, cells = [], xml.cells
    monkeypatch.setattr(xml, "cells", lambda piece: (seen.append(len(piece)), cells(piece))[1])
    assert [[x for lo, hi in zip(edges, edges[1:]) for x in flat(s, lo, hi)] for s in (scan, part)] == want
    assert sum(seen) < scan.sheet.size * 0.9  # the header's pieces alone, of two scans


def test_tasks_read_their_own_strings(book, monkeypatch):
    """A task at the end of the sheet inflates neither the sheet before it nor all strings."""
    ooxml._strings.clear()
    scan = bind(opts.parse({"path": book}))
    ooxml._strings.clear()
    read, seen = [], []
    parts, blocks = ooxml._read_strings, xml.inflated
    monkeypatch.setattr(ooxml, "_read_strings", lambda raw: (read.append(len(raw)), parts(raw))[1])
    monkeypatch.setattr(xml, "inflated", lambda *a: (seen.append(len(b)) or b for b in blocks(*a)))
    lo = scan.sheet.points[-1][1]
    assert flat(scan, lo, scan.sheet.size)
    assert sum(seen) <= scan.sheet.size - lo and sum(read) < scan.sheet.strings_size


def test_skipped_rows_are_not_inflated(book, monkeypatch):
    seen, blocks = [], xml.inflated
    scan = bind(opts.parse({"path": book}))
    monkeypatch.setattr(xml, "inflated", lambda *a: (seen.append(len(b)) or b for b in blocks(*a)))
    before = scan.sheet.points[-1][2]
    deep = bind(opts.parse({"path": book, "skip_rows": before + 3, "types": "DOUBLE,VARCHAR,DOUBLE,BOOLEAN,DATE,DATE", "force_types": "true"}))
    assert sum(seen) < 2 * xml.BLOCK + scan.sheet.size - scan.sheet.points[-1][1] and sheets.ranges(deep)[0][0] == scan.sheet.points[-1][1]
    assert [r for lo, hi in sheets.ranges(deep) for r in flat(deep, lo, hi)] == flat(scan, 0, scan.sheet.size)[before + 2 :]


def test_points_of_another_sheet_are_not_used(book, tmp_path):
    path = str(tmp_path / "changed.xlsx")
    with zipfile.ZipFile(book) as old, zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            new.writestr(name, old.read(name).replace(b"late", b"soon"))
    scan = bind(opts.parse({"path": path}))
    assert not scan.sheet.string_points and flat(scan, 0, scan.sheet.size)[-1][1] == "soon"


def test_crc_of_parts():
    r = random.Random(2)
    for n in (0, 1, 7, 300_001):
        a, b = r.randbytes(99), r.randbytes(n)
        assert large.crc_of_both(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_rows_of_eight_digits_are_told_by_numpy():
    assert xml.cells(b'<row r="12345678"><c r="A12345678"><v>1</v></c></row>').row.tolist() == [12_345_678]


@pytest.mark.parametrize("name", ["scan_lineitem", "scan_skip_rows_deep", "scan_mixed_row_places_1", "scan_mixed_row_places_8", "scan_documents", "scan_pages", "count_star", "distinct_agg", "filter_project"])
def test_queries_over_large_books(spark, monkeypatch, name):
    """Rendered by tasks at any size."""
    monkeypatch.setattr(books, "LARGE", 0)
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(books, "_folder", lambda s, f=books._folder: f(s) + "/large")
    import os

    os.makedirs(books._folder(spark), exist_ok=True)
    made, write = [], large.write
    monkeypatch.setattr(large, "write", lambda path, *a: made.append(path) or write(path, *a))
    df = QUERIES[name](spark, sf)
    db = duckdb.connect()
    for t in ("nation", "orders", "lineitem", "documents", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = [tuple(r) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, db.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE_SQL[name]}) q").fetchall()))
    for path in made:
        assert json.loads(zipfile.ZipFile(path).read(ooxml.POINTS))


@pytest.mark.parametrize(("name", "read"), [("distinct_agg", {"l_returnflag", "l_suppkey", "l_shipdate"}), ("q1_pricing_summary", {"l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"})])
def test_aggregates_read_their_columns_only(spark, monkeypatch, name, read):
    from gridscan.plans import queries

    seen, table = [], queries.table
    monkeypatch.setattr(queries, "table", lambda *a, **o: (seen.append(df := table(*a, **o)), df)[1])
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert [set(df.columns) for df in seen] == [read]
