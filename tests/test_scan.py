"""The scan's rules on small workbooks: header and type inference, options, nulls, errors, byte ranges."""

import datetime
import random
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridscan import errors
from gridscan.fixtures import Bare, Raw, Serial, Writer, write_book
from gridscan.operators import options as opts
from gridscan.sources import ooxml
from gridscan.sources import sheet as sheets
from gridscan.sources.sheet import batches, bind

ERR = Raw('t="e"', "<v>#N/A</v>")
INLINE = Raw('t="inlineStr"', "<is><t>in</t></is>")
DAY = datetime.date(2020, 1, 1)


def read(path, **options):
    """(names, types, rows) by all byte ranges in order."""
    scan = bind(opts.parse({"path": str(path), **options}))
    rows = [r for lo, hi in sheets.ranges(scan) for b in batches(scan, lo, hi) for r in zip(*(c.to_pylist() for c in b.columns))]
    return list(scan.plan.names), list(scan.plan.types), rows


@pytest.fixture
def make(tmp_path):
    count = iter(range(1000))

    def build(*rows, **more):
        return write_book(str(tmp_path / f"{next(count)}.xlsx"), {"s": rows}, **more)

    return build


X01 = (["a", "b", "c"], ["x", 1, "y"], ["z", 2.5, "w"])


def fails(message, path, **options):
    with pytest.raises(errors.SheetError) as e:
        read(path, **options)
    start = message.split("{")[0]
    assert start in str(e.value), e.value


def test_golden_sample(make):
    names, types, rows = read(make(["Name", "Age", "City"], ["Alice", 30, "New York"], ["Bob", 25, "London"]))
    assert (names, types) == (["Name", "Age", "City"], ["VARCHAR", "DOUBLE", "VARCHAR"])
    assert rows == [("Alice", 30.0, "New York"), ("Bob", 25.0, "London")]


def test_generic_names_without_header(make):
    names, types, rows = read(make([1, "s", True, DAY], [2, "t", False, DAY]))
    assert names == ["Numeric0", "String1", "Boolean2", "Date3"] and types == ["DOUBLE", "VARCHAR", "BOOLEAN", "DATE"]
    assert rows == [(1.0, "s", True, DAY), (2.0, "t", False, DAY)]


def test_all_strings_have_a_header_only_when_asked(make):
    path = make(["a", "b"], ["c", "d"], ["e", "f"])
    assert read(path)[0] == ["String0", "String1"] and len(read(path)[2]) == 3
    assert read(path, has_header="true") == (["a", "b"], ["VARCHAR", "VARCHAR"], [("c", "d"), ("e", "f")])


def test_header_rules(make):
    fails(errors.HEADER_NOT_STRINGS, make(["a", 1], ["b", 2]), has_header=True)
    assert read(make(["a", "b"], [1, 2]), has_header="false") == (["a", "b"], ["DOUBLE", "DOUBLE"], [(1.0, 2.0)])


def test_skip_rows(make):
    path = make(["junk"], ["junk", 1, 2, 3, 4], [9], *X01)
    assert read(path, skip_rows=3) == read(make(*X01))


def test_sheets(tmp_path):
    path = write_book(str(tmp_path / "b.xlsx"), {"One": [[1], [2]], "Sales": list(X01)})
    want = read(write_book(str(tmp_path / "c.xlsx"), {"s": list(X01)}))
    for options in ({"sheet_name": "Sales"}, {"sheet_index": 2}, {"sheet_name": "", "sheet_index": 2}, {"SHEET_NAME": "Sales"}):
        assert read(path, **options) == want
    assert read(path)[0] == ["Numeric0"]
    fails(errors.NAME_AND_INDEX, path, sheet_name="Sales", sheet_index=1)
    fails(errors.BAD_OPTION, path, sheet_index=0)
    fails(errors.NO_SHEET_INDEX, path, sheet_index=9)
    fails(errors.NO_SHEET_NAME, path, sheet_name="Nope")


def test_cells_that_do_not_fit_are_null(make):
    assert read(make(["a", "b"], [1, 2], ["s", 3], [True, 4], [DAY, 5], [ERR, 6]))[2] == [(1, 2), (None, 3), (None, 4), (None, 5), (None, 6)]


def test_coercion(make):
    path = make(["a", "b"], ["s", 1], [30, 2], [0.0000005, 3], [True, 4], [False, 5], [DAY, 6], [ERR, 7])
    assert [r[0] for r in read(path, coerce_to_string="true")[2]] == ["s", "30.000000", "0.000000", "TRUE", "FALSE", "2020-01-01", None]
    assert [r[1] for r in read(path, coerce_to_string="true")[2]] == [1, 2, 3, 4, 5, 6, 7]
    assert [r[0] for r in read(path)[2]] == ["s"] + [None] * 6
    path = make([1, DAY, True, "s"], [-2.5, DAY, False, "t"])
    assert read(path, types='["VARCHAR","VARCHAR","VARCHAR","VARCHAR"]', coerce_to_string=True)[2] == [("1.000000", "2020-01-01", "TRUE", "s"), ("-2.500000", "2020-01-01", "FALSE", "t")]


def test_declared_types(make):
    path = make([1, 2], [3, 4])
    fails(errors.TYPE_MISMATCH, path, types="VARCHAR,DOUBLE")
    assert read(path, types="VARCHAR,DOUBLE", force_types="true") == (["Numeric0", "Numeric1"], ["VARCHAR", "DOUBLE"], [(None, 2), (None, 4)])
    assert read(path, force_types="true") == read(path)
    for few in ("DOUBLE", "[]"):
        fails(errors.FEW_TYPES, path, types=few)
    assert read(make([1], [2]), types="DOUBLE,VARCHAR") == (["Numeric0", "Column 1"], ["DOUBLE", "VARCHAR"], [(1, None), (2, None)])
    assert read(make([1], [2], [3, "x"]), types="DOUBLE,VARCHAR")[2] == [(1, None), (2, None), (3, "x")]
    for bad in ("INTEGER", "FLOAT", "TIMESTAMP", "DECIMAL", "REAL", "DATETIME"):
        fails(errors.UNKNOWN_TYPE, make([1], [2]), types=bad)
    for good in ("float8", "Double"):
        assert read(make([1], [2]), types=good)[1] == ["DOUBLE"]
    assert opts.type_name("varchar(10)") == opts.type_name(" text ") == opts.type_name("bpchar") == "VARCHAR"
    assert opts.type_name("bool") == opts.type_name("Logical") == "BOOLEAN"


def test_sparse_cells_and_rows(make):
    path = make(["a", "b", "c"], [1, "s", True], [2, None, False], [None, None, None], None, [3, "t", True])
    assert read(path)[2] == [(1, "s", True), (2, None, False), (None,) * 3, (None,) * 3, (3, "t", True)]
    _, _, rows = read(make([1], [2], (30_000, [3])))
    assert rows == [(1,), (2,)] + [(None,)] * 29_997 + [(3,)]


def test_wide_rows(make):
    path = make([1, 2], [3, 4], [5, 6, 7], dimension="A1:B3")
    fails(errors.WIDE_ROW, path)
    assert read(make([1, 2], [3, 4], [5, 6, 7], dimension="A1:C3"))[2] == [(1, 2, None), (3, 4, None), (5, 6, 7)]


def test_dates(make):
    path = make(["d"], [Serial(43831)], [Serial(43831.75)], [Serial(25568.5)], [Serial(25569)])
    assert [r[0].isoformat() for r in read(path)[2]] == ["2020-01-01", "2020-01-01", "1970-01-01", "1970-01-01"]
    path = make(["d"], [Serial(43831 - 1462)], date1904=True)
    assert read(path)[2] == [(DAY,)]


@pytest.mark.parametrize(
    "code,is_date",
    [("yyyy-mm-dd", True), ("General", False), ("0.00", False), ('0 "days"', False), ("[Red]0.0", False), ("[h]:mm", True), ("hh:mm:ss", True), ("\\d0", False), ('#,##0;[Red]-"y"0', False), ("_d0", False)],
)
def test_number_formats(code, is_date):
    assert ooxml.shows_dates(code) is is_date


def test_error_and_inline_cells(make):
    fails(errors.ERROR_CELL, make([ERR, 1], [2, 3]))
    fails(errors.ERROR_CELL, make(["a", "b"], [ERR, 1]))
    fails(errors.INLINE_STRING, make([INLINE, 1], ["s", 2]))
    path = make(["s", 1], ["t", 2], [INLINE, 3], [Raw('t="str"', "<f>A1</f><v>a&amp;b</v>"), 4])
    assert [r[0] for r in read(path)[2]] == ["s", "t", None, None]
    assert [r[0] for r in read(path, inline_strings="read")[2]] == ["s", "t", "in", "a&b"]
    path = make([INLINE, "b"], [1, Raw('t="inlineStr"', "<is><r><t>two </t></r><r><t>runs</t></r></is>")])
    assert read(path, inline_strings="read") == (["in", "b"], ["DOUBLE", "VARCHAR"], [(1, "two runs")])
    assert read(make([1], [2], [Raw("", "<f>A1+A2</f><v>3</v>")]))[2] == [(1,), (2,), (3,)]


def test_too_few_rows(make):
    fails(errors.EMPTY_SHEET, make())
    fails(errors.TOO_FEW_ROWS, make([1]))
    fails(errors.EMPTY_SHEET, make([1], [2]), skip_rows=2)
    fails(errors.EMPTY_SHEET, make([None], [None]))


def test_empty_probed_cells(make):
    names, types, rows = read(make([1, None, "s"], [2, 3, "t"]))
    assert names == ["Numeric0", "Numeric1", "String2"] and types == ["DOUBLE", "DOUBLE", "VARCHAR"] and rows[0] == (1, None, "s")
    names, types, _ = read(make(["a", None, "c"], [1, None, "t"], [2, True, "u"]))
    assert names == ["a", "Boolean1", "c"] and types[1] == "BOOLEAN"


def test_names_differ_without_case(make):
    assert read(make(["a", "A", "a"], [1, 2, 3]))[0] == ["a", "A_1", "a_2"]


def test_texts(make):
    odd = ["&", "<b>", "line\nbreak", "\U0001f600", "  space ", "]]>", "'\""]
    assert [r[0] for r in read(make(*([t, 1] for t in odd)))[2]] == odd


def edit(path, part, change):
    """The workbook with one part rewritten."""
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts[part] = change(parts[part])
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for n, raw in parts.items():
            z.writestr(n, raw)
    return path


def test_rich_text_phonetics_and_escapes(make):
    path = make(["one", 1], ["two", 2], ["three", 3])
    items = b"<si><r><t>ri</t></r><r><t xml:space=\"preserve\">ch </t></r><rPh sb=\"0\" eb=\"1\"><t>no</t></rPh></si><si><t>_x0041_b</t></si><si><t/></si></sst>"
    edit(path, "xl/sharedStrings.xml", lambda raw: raw[: raw.index(b"<si>")] + items)
    assert [r[0] for r in read(path)[2]] == ["rich ", "Ab", ""]


def test_other_spellings_read_the_same(make):
    rows = [["a", "b"], *([f"t{i % 7}", i] for i in range(500))]
    want = read(make(*rows))
    part = "xl/worksheets/sheet1.xml"
    import re

    def prefixed(raw):
        raw = re.sub(rb"<(/?)(worksheet|sheetData|row|c|v)\b", rb"<\1x:\2", raw)
        return raw.replace(b'xmlns="', b'xmlns:x="', 1)

    changes = [
        lambda raw: re.sub(rb' r="[A-Z]*\d+"', b"", raw),
        prefixed,
        lambda raw: raw.replace(b"<sheetData>", b"<!-- <row r='1'> --><sheetData>"),
        lambda raw: re.sub(rb'<c r="(\w+)" t="s">', rb'<c t="s" r="\1">', raw),
        lambda raw: raw.replace(b"<row r=", b'<row spans="1:2" r=').replace(b"</row>", b"</row>\n  "),
        lambda raw: raw.replace(b"</sheetData>", b"</sheetData><rowBreaks count='1'/><pageMargins left='1'/>"),
        lambda raw: raw.replace(b'<row r="40">', b'<row r="40"><!-- late comment -->'),
    ]
    for change in changes:
        for threads in (1, 5, 16):
            assert read(edit(make(*rows), part, change), threads=threads) == want


def test_paths(tmp_path, make):
    path = make(*X01)
    want = read(path)
    assert read(f"file://{path}") == want
    assert read(str(tmp_path / "[0-9].xlsx")) == want
    fails(errors.NO_FILE, tmp_path / "none.xlsx")
    fails(errors.NO_FILE, tmp_path / "*.none")
    make(*X01)
    fails(errors.MANY_FILES, tmp_path / "*.xlsx")
    fails(errors.UNKNOWN_OPTION, path, typo=1)
    (tmp_path / "bad.xlsx").write_bytes(b"not a zip")
    fails(errors.CANNOT_OPEN, tmp_path / "bad.xlsx")
    fails(errors.CANNOT_PARSE, edit(make(*X01), "xl/worksheets/sheet1.xml", lambda raw: raw.replace(b"</row>", b"</rox>", 1)))
    for name, bad in (("threads", 0), ("threads", -1), ("skip_rows", -1), ("skip_rows", "x"), ("has_header", "maybe"), ("inline_strings", "drop")):
        fails(errors.BAD_OPTION, path, **{name: bad})


def sample_rows():
    r = random.Random(4)
    rows = [["k", "text", "flag", "day"], [0, "first", True, DAY]]
    for i in range(1, 40):
        rows.append(None if i % 9 == 0 else [c if r.random() < 0.8 else None for c in (i / 3, f"t{i % 5}", i % 2 == 0, DAY)])
    return rows + [(70, [1, "last", True, DAY])]


def test_any_cut_gives_the_same_rows(make, monkeypatch):
    path = make(*sample_rows())
    scan = bind(opts.parse({"path": path}))
    flat = lambda lo, hi: [r for b in batches(scan, lo, hi) for r in zip(*(c.to_pylist() for c in b.columns))]
    size = scan.sheet.size
    want = flat(0, size)
    assert len(want) == 69
    for block in (1 << 20, 700, 64):
        monkeypatch.setattr(sheets.xml, "BLOCK", block)
        assert flat(0, size) == want
        step = 1 if block > 700 else 37
        for cut in range(0, size + 1, step):
            assert flat(0, cut) + flat(cut, size) == want, cut
    edges = list(range(0, size, 41)) + [size]
    assert [r for a, b in zip(edges, edges[1:]) for r in flat(a, b)] == want


@pytest.mark.parametrize("placed", [False, True])
def test_rows_that_stop_naming_their_places(make, placed):
    """Places stop in the middle of the sheet, on all rows or on some: no row is lost, whatever the ranges."""
    rows = [["k", "t"], *([i, f"t{i % 9}"] for i in range(30_000))]
    want = read(make(*rows))
    some = [r if i < 15_000 or i % 13 == 0 else Bare(r, placed) for i, r in enumerate(rows)]
    for bare in (some, [r if i < 15_000 else Bare(r, placed) for i, r in enumerate(rows)], [r if i < 200 else Bare(r, placed or i % 2 == 0) for i, r in enumerate(rows)]):
        path = make(*bare)
        for threads in (1, 4):
            assert read(path, threads=threads) == want
    gap = make(*rows[:500], (900, [1, "after"]), Bare([2, "next"], placed))
    assert read(gap)[2][-402:] == [(498, "t3"), *[(None, None)] * 399, (1, "after"), (2, "next")]


def bare(raw, r, rows, cells):
    """The sheet's XML without the places of some rows and cells."""
    import re

    raw = re.sub(rb'<row r="\d+"', lambda m: b"<row" if r.random() < rows else m[0], raw)
    return re.sub(rb'<c r="\w+"', lambda m: b"<c" if r.random() < cells else m[0], raw)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.0, 0.02, 0.5, 1.0]), st.sampled_from([0.0, 0.02, 0.5, 1.0]), st.integers(1, 9))
def test_places_left_out_at_random_change_nothing(tmp_path_factory, seed, rows, cells, threads):
    r = random.Random(seed)
    path = str(tmp_path_factory.mktemp("p") / "b.xlsx")
    write_book(path, {"s": [["a", "b", "c"], *([i, f"t{i % 5}", i % 2 == 0] for i in range(r.randrange(2, 400)))]})
    want = read(path)
    edit(path, "xl/worksheets/sheet1.xml", lambda raw: bare(raw, r, rows, cells))
    old = sheets.LEAST_SLICE, sheets.xml.BLOCK
    sheets.LEAST_SLICE, sheets.xml.BLOCK = 64, r.choice([97, 1000, 1 << 20])
    try:
        assert read(path, threads=threads) == want
    finally:
        sheets.LEAST_SLICE, sheets.xml.BLOCK = old


def test_any_cut_of_a_sheet_with_late_oddities(make, monkeypatch):
    """Comments, CDATA, prefixes and missing places late in the sheet send each range to the parser by itself."""
    rows = [["k", "t"], *([i, f"t{i}"] for i in range(60))]
    part = "xl/worksheets/sheet1.xml"
    monkeypatch.setattr(sheets.xml, "HEAD", 10)
    changes = [
        lambda raw: raw.replace(b'<row r="40">', b"<!-- <row r='3'><c/></row> --><row r='40'>"),
        lambda raw: raw.replace(b'<row r="40">', b'<row r="40"><!-- </sheetData> <row r="2"> -->'),
        lambda raw: raw.replace(b'<row r="40">', b"<row>").replace(b'<row r="52">', b"<row spans='1:2'>"),
        lambda raw: raw.replace(b'<row r="40"', b"<row\n  r = '40'"),
        lambda raw: raw.replace(b"<v>30</v>", b"<v><![CDATA[30]]></v>"),
        lambda raw: raw.replace(b"</sheetData>", b"</sheetData><controls><xdr:row>7</xdr:row><row r='2'/></controls>"),
    ]
    for change in changes:
        path = edit(make(*rows), part, change)
        want = read(make(*rows))[2]
        scan = bind(opts.parse({"path": path}))
        flat = lambda lo, hi: [r for b in batches(scan, lo, hi) for r in zip(*(c.to_pylist() for c in b.columns))]  # noqa: B023,E731
        for block in (1 << 20, 150):
            monkeypatch.setattr(sheets.xml, "BLOCK", block)
            for step in (53, 400):
                edges = [*range(0, scan.sheet.size, step), scan.sheet.size]
                assert [r for a, b in zip(edges, edges[1:]) for r in flat(a, b)] == want


def test_quick_cells_equal_tokens(make, monkeypatch):
    """The three readers of cells agree on a sheet of every kind of cell, and the quick one takes the spelling of common writers."""
    r = random.Random(8)
    kinds = [lambda i: i, lambda i: i / 7, lambda i: f"t{i % 11}", lambda i: i % 2 == 0, lambda i: DAY, lambda i: None, lambda i: ERR, lambda i: Raw('s="12"', "<v>1e5</v>"), lambda i: Raw('s="0"', "<v></v>"), lambda i: Raw('t="n"', "<v>7</v>")]
    rows = [["h"] * 30, *([r.choice(kinds)(i) for _ in range(30)] for i in range(400))]
    rows[1] = [k % 3 for k in range(30)]
    wide = [[1] * 800, [2] * 800, [3] * 800]
    for path in (make(*rows), make(*wide), edit(make(*rows), "xl/worksheets/sheet1.xml", lambda raw: raw.replace(b"><v></v></c>", b"/>").replace(b"<row ", b"\n <row ").replace(b'"><c', b'" spans="1:30" ht="15"><c'))):
        want = read(path)
        used = []
        quick = sheets.xml.cells
        monkeypatch.setattr(sheets.xml, "cells", lambda piece: used.append(quick(piece)) or used[-1])
        assert read(path) == want and any(u is not None for u in used)
        monkeypatch.setattr(sheets.xml, "cells", lambda piece: None)
        assert read(path) == want
        monkeypatch.setattr(sheets.xml, "tokens", lambda piece: None)
        assert read(path) == want
        monkeypatch.undo()


def test_quick_cells_refuse_other_spellings():
    good = b'<row r="5"><c r="A5" s="2" t="s"><v>1</v></c><c r="BC5"/></row><row r="6"/>'
    got = sheets.xml.cells(good)
    assert (got.row.tolist(), got.col.tolist(), got.style.tolist(), got.code.tolist(), got.there.tolist(), got.values.to_pylist()) == ([5, 5], [0, 54], [2, 0], [ord("s"), 0], [True, False], ["1", ""])
    for old, new in (
        (b'<row r="5"', b"<row"), (b'<row r="6"', b'<row s="1" r="6"'), (b'<c r="A5"', b"<c"), (b'r="A5"', b'r="A7"'), (b's="2" t="s"', b't="s" s="2"'), (b't="s"', b't="str"'), (b"<v>1", b"<f>2</f><v>1"),
        (b"<v>1</v>", b"<v>1</v><v>2</v>"), (b"<v>1</v>", b"<is>1</is>"), (b"<v>", b"<v >"), (b"</c>", b"</c >"), (b'r="BC5"', b"r='BC5'"), (b'r="A5"', b'r="5"'), (b"</row>", b"<x/></row>"), (b'<c r="BC5"/>', b'<c r="BC5" cm="1"/>'),
    ):
        assert old in good and sheets.xml.cells(good.replace(old, new, 1)) is None, new


def test_parser_and_tokenizer_agree(make):
    import dataclasses

    scan = bind(opts.parse({"path": make(*sample_rows())}))
    both = [[r for b in batches(s, 0, s.sheet.size) for r in zip(*(c.to_pylist() for c in b.columns))] for s in (scan, dataclasses.replace(scan, ordinary=False))]
    assert both[0] == both[1]


CELLS = st.one_of(st.none(), st.integers(-10**9, 10**9), st.floats(allow_nan=False, allow_infinity=False), st.booleans(), st.text(st.characters(exclude_categories=["Cs", "Cc"], exclude_characters="\ufffe\uffff"), max_size=8))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(CELLS, min_size=3, max_size=3), max_size=30), st.integers(1, 16))
def test_threads_never_change_rows(tmp_path_factory, rows, threads):
    path = str(tmp_path_factory.mktemp("h") / "b.xlsx")
    write_book(path, {"s": [["a", "b", "c"], [1, "x", True], *rows]})
    one = read(path, threads=1)
    old = sheets.LEAST_SLICE
    sheets.LEAST_SLICE = 64
    try:
        assert read(path, threads=threads) == one
    finally:
        sheets.LEAST_SLICE = old
    want = [tuple(v if v is not None and type(v) in t else None for v, t in zip(r, ((int, float), (str,), (bool,)))) for r in rows]
    texts = [tuple(ooxml.plain_text(v) if isinstance(v, str) else v for v in r) for r in want]
    present = one[2][1:]
    assert present == texts


def test_spark_source_and_function_agree(spark, make, monkeypatch):
    import gridscan

    path = make(["k", "text", "flag", "day"], *([i, f"t{i % 5}", i % 2 == 0, DAY] for i in range(10_000)))
    gridscan.register(spark)
    gridscan.register(spark)
    want = sorted(read(path)[2])
    for threads in (1, 2, 8, 16):
        df = spark.read.format("gridscan").option("threads", threads).load(path)
        assert df.dtypes == [("k", "double"), ("text", "string"), ("flag", "boolean"), ("day", "date")]
        assert sorted(map(tuple, df.collect())) == want
    sql = spark.sql(f"SELECT * FROM read_sheet('{path}', THREADS => 2, has_header => true, types => array('DOUBLE', 'text', 'bool', 'date'))")
    assert sorted(map(tuple, sql.collect())) == want
    assert sql.schema == df.schema
    assert df.rdd.getNumPartitions() > 1


def test_one_frame_under_many_filters(spark, make):
    """No query on a frame leaves a filter behind for the next; NaN and null cells included."""
    import gridscan

    r = random.Random(9)
    nan = Raw('s="0"', "<v>NaN</v>")
    rows = [[r.choice([None, i / 3, -0.0, 0, nan]), r.choice([None, f"t{i % 9}", "x%y", ""]), r.choice([None, True, False])] for i in range(900)]
    path = make(["k", "text", "flag"], [1, "x", True], *rows)
    gridscan.register(spark)
    whole = spark.read.format("gridscan").option("threads", 3).load(path)
    known = spark.createDataFrame(whole.collect(), whole.schema)
    for condition in ("k = 0", "coalesce(k, 9) = 9", "k > 50", "k is null", "k = double('NaN')", "k in (1, 0, 100)", "text like 't%'", "k = 1 or text = 't3'", "flag", "not flag and k >= 0"):
        assert sorted(map(str, whole.where(condition).collect())) == sorted(map(str, known.where(condition).collect())), condition
    assert whole.count() == 901


def test_chosen_columns(spark, make):
    import gridscan

    path = make(["a", "b,c", "d"], *([i, f"t{i}", i % 2 == 0] for i in range(20)))
    names, types, rows = read(path, columns='["D", "b,c", "d"]')
    assert rows == [(i % 2 == 0, f"t{i}") for i in range(20)]
    assert read(path, columns="a")[2] == [(float(i),) for i in range(20)]
    for bad in ("nope", "", "[1", "[]", "a,,d"):
        with pytest.raises(errors.SheetError):
            read(path, columns=bad)
    fails(errors.WIDE_ROW, make([1, 2], [3, 4], [5, 6, 7], dimension="A1:B3"), columns="Numeric0")
    gridscan.register(spark)
    df = spark.read.format("gridscan").option("columns", "d,a").load(path)
    assert df.dtypes == [("d", "boolean"), ("a", "double")] and df.where("a > 17").collect() == [(True, 18.0), (False, 19.0)]
    given = spark.read.format("gridscan").schema("x string, y double").option("columns", '["b,c", "a"]').load(path)
    assert given.orderBy("y").first() == ("t0", 0.0)
    sql = spark.sql(f"SELECT * FROM read_sheet('{path}', columns => array('a', 'd')) WHERE a < 2")
    assert sorted(sql.collect()) == [(0.0, True), (1.0, False)]
    with pytest.raises(Exception, match="columns names 1"):
        spark.read.format("gridscan").schema("x string, y double").option("columns", "a").load(path).collect()


def test_a_workbook_that_changes_is_bound_anew(spark, make):
    import shutil

    import gridscan

    path, other = make(*X01), make(["a", "b", "c"], *([f"x{i}", i, "y"] for i in range(500)))
    gridscan.register(spark)
    df = spark.read.format("gridscan").load(path)
    shutil.copyfile(other, path)
    assert df.count() == 500


def test_spark_errors_carry_their_message(spark, make):
    import gridscan

    gridscan.register(spark)
    path = make(*X01)
    for options, message in (({"typo": "1"}, "unknown option"), ({"sheet_index": "9"}, "no sheet number 9"), ({"threads": "0"}, "option threads")):
        reader = spark.read.format("gridscan")
        for k, v in options.items():
            reader = reader.option(k, v)
        with pytest.raises(Exception, match=message):
            reader.load(path).collect()
    with pytest.raises(Exception, match="no file matches"):
        spark.sql("SELECT * FROM read_sheet('/none.xlsx')")
    with pytest.raises(Exception, match="more columns"):
        spark.read.format("gridscan").load(make([1, 2], [3, 4], [5, 6, 7], dimension="A1:B3")).collect()
    with pytest.raises(Exception, match="one workbook"):
        spark.read.format("gridscan").load([path, path])
    with pytest.raises(Exception, match="given schema"):
        spark.read.format("gridscan").schema("a string").load(path).collect()


def test_writer_is_plain(tmp_path):
    w = Writer(str(tmp_path / "a.xlsx"))
    w.add("s", [[1]])
    w.close()
    assert zipfile.ZipFile(tmp_path / "a.xlsx").testzip() is None


def test_long_skips_are_streamed(make, monkeypatch):
    """Skipped rows are never held: what is in hand stays at a few blocks, and the parser sees little more than the rows behind the skip."""
    monkeypatch.setattr(sheets.xml, "BLOCK", 4096)
    path = make(*([i, "x" * 5, i / 7] for i in range(20_000)), *X01)
    held = []
    more = sheets.xml._Ahead.more
    monkeypatch.setattr(sheets.xml._Ahead, "more", lambda s: (held.append(len(s.held)), more(s))[1])
    fed = []
    parsed = sheets.xml.parsed
    monkeypatch.setattr(sheets.xml, "parsed", lambda blocks, *a: parsed((fed.append(len(b)) or b for b in blocks), *a))
    scan = bind(opts.parse({"path": path, "skip_rows": 20_000}))
    assert scan.plan.names == ("a", "b", "c") and max(held) < 4 * 4096 and sum(fed) < 5 * 4096
    assert read(path, skip_rows=20_000)[2] == read(make(*X01))[2]
    for skip in (1, 19_999, 20_001):
        assert len(read(path, skip_rows=skip, types="VARCHAR,VARCHAR,VARCHAR", force_types=True)[2]) in (20_003 - skip, 20_002 - skip)


def test_escaped_surrogates(make):
    odd = {"_xD83D__xDE00_": "\U0001f600", "a_xD800_b": "a\ufffdb", "_xDE00__xD83D_": "\ufffd\ufffd", "_x0041__xD83D_": "A\ufffd"}
    assert [r[0] for r in read(make(*([t, 1] for t in odd)))[2]] == list(odd.values())
    path = make(["s", 1], *([Raw('t="str"', f"<v>{t}</v>"), 2] for t in odd))
    assert [r[0] for r in read(path, inline_strings="read")[2]] == ["s", *odd.values()]
    assert ooxml.unescape("&#xD83D;&#xDE00;&#x110000;&#xDC00;") == "\U0001f600\ufffd\ufffd"


def test_types_are_told_behind_a_long_skip(make, monkeypatch):
    """The rows to skip are longer than the head of the sheet that is held."""
    r = random.Random(3)
    skipped = [[r.random() for _ in range(6)] for _ in range(3000)]
    path = make(*skipped, *X01, ["v", 3, None])
    want = read(path, skip_rows="3000")
    monkeypatch.setattr(sheets.xml, "BLOCK", 1024)
    assert read(path, skip_rows="3000")[:2] == want[:2] == (["a", "b", "c"], read(make(*X01))[1])
    assert read(path, skip_rows="3000")[2] == want[2]
