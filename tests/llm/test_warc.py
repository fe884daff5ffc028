import gzip
import hashlib

import pytest

from gridscan.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, kind int"


def brute(pages):
    first = {}
    for k, _, html, *_ in pages:
        b = (html or "").encode()
        if len(b) >= 100 and k is not None:
            first[b] = min(k, first.get(b, k))
    out = []
    for k, _, html, *_ in pages:
        b = (html or "").encode()
        again = len(b) >= 100 and k is not None and k > first[b]
        out.append((k, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=str)


def pages():
    copy, small = "<p>" + "copy é " * 40, "<p>short"
    out = [(i * 3, f"http://h/{i}", copy if i % 3 == 0 else small if i % 7 == 0 else f"<p>{i}" + "x" * (i * 5), "d", 1) for i in range(200)]
    out += [(None, None, copy, "", 0), (None, "u", None, "", 0), (7, "bad\r\nurl é", None, "", 0), (8, "", "", "", 0), (9, "x", "y" * 100, "", 0), (10, "x", "y" * 100, "", 0)]
    out += [(12, "http://again", copy, "", 0), (15, "same id", copy, "", 0), (15, "same id, other", "z" * 300_000, "", 0)]
    return out


def listed(manifest):
    return sorted((tuple(r) for r in manifest.collect()), key=lambda r: (r[1], r[2]))


def test_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(pages(), SCHEMA).repartition(6)
    manifest = warc.write_warc(frame, f"file://{tmp_path}/a", roll=3000)
    back = warc.read_warc(manifest, f"file://{tmp_path}/a")
    assert sorted((tuple(r)[:5] for r in back.collect()), key=str) == brute(pages())
    files = listed(manifest)
    assert len(files) > 3 and sum(f[3] for f in files) == len(pages())
    assert listed(warc.write_warc(frame.repartition(3), f"file://{tmp_path}/b", roll=3000)) == files
    for name, _, _, _, size in files:
        a, b = ((tmp_path / x / name).read_bytes() for x in "ab")
        assert a == b and len(a) == size
        assert gzip.decompress(a).startswith(b"WARC/1.1\r\n")
    assert not (tmp_path / "a" / "_temporary_files").exists()


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    frame = spark.createDataFrame(pages(), SCHEMA)
    uri = f"file://{tmp_path}/a"
    manifest = warc.write_warc(frame, uri)
    (tmp_path / "a" / "part-999999-000000.warc.gz").write_bytes(b"left over from a run that broke off")
    assert warc.read_warc(manifest, uri).count() == len(pages())


def test_pages_without_ids_and_one_id_are_dealt_to_many_files(spark, tmp_path):
    """Nine tenths of the rows without an id, or with one: no task writes them all, and they read back alike."""
    for k, key in enumerate((None, 5)):
        rows = [(key if i % 10 else i, f"u{i}", f"<p>{i % 97}" + "x" * 200, "", 0) for i in range(600)]
        uri = f"file://{tmp_path}/{k}"
        manifest = warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(4), uri)
        got = sorted((tuple(r)[:5] for r in warc.read_warc(manifest, uri).collect()), key=str)
        assert got == brute(rows) and max(f[3] for f in listed(manifest)) <= 0.6 * len(rows) and len(listed(manifest)) >= 4


def test_empty(spark, tmp_path):
    uri = f"file://{tmp_path}/a"
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), uri)
    assert manifest.count() == 0 and warc.read_warc(manifest, uri).count() == 0


def test_damage_is_noticed():
    raw = warc.record(1, "u", b"payload")
    warc.parse(raw)
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload", b"pay1oad"))
    with pytest.raises(ValueError):
        list(warc.members([gzip.compress(raw)[:-9]]))
    both = gzip.compress(raw) + gzip.compress(raw + b"x")
    for step in (1, 7, 1 << 20):
        assert list(warc.members(both[k : k + step] for k in range(0, len(both), step))) == [raw, raw + b"x"]
