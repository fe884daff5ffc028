import random
import zlib

import numpy as np
import pytest
import xxhash

from gridscan.llm import queries, token_files

from .conftest import SCHEMA, SF
from .test_packing import plain


def check(rows, docs):
    encode, start = plain(), 0
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for k, t in sorted(docs, key=lambda d: d[0]):
        ids = np.array([*encode(t), 2], "<u4")
        r = got[k]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_query(spark, small_docs):
    check(queries.QUERIES["op7_token_files"](spark, SF).collect(), small_docs)


def test_odd_texts(odd_frame, odd_docs, empty_frame):
    check(token_files.token_round_trip(odd_frame).collect(), [d[:2] for d in odd_docs])
    assert token_files.token_round_trip(empty_frame).count() == 0


def test_null_and_repeated_ids(spark, odd_docs):
    docs = [(None if k % 8 == 0 else d[0] // 40, *d[1:]) for k, d in enumerate(odd_docs)]
    rows = sorted(token_files.token_round_trip(spark.createDataFrame(docs, SCHEMA)).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert sorted(map(str, ids)) == sorted(str(d[0]) for d in docs)
    there = [i for i in ids if i is not None]
    assert ids == [None] * (len(ids) - len(there)) + sorted(there)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()


def test_files_are_rolled_listed_and_the_same_again(spark, odd_frame, tmp_path):
    a, b = (sorted(map(tuple, token_files.write_token_files(odd_frame, f"file://{tmp_path}/{x}", roll=500).collect())) for x in "ab")
    assert a == b and len(a) > 10
    assert [f[-1] for f in a] == np.cumsum([0, *(f[2] for f in a)])[:-1].tolist()
    for name, *_ in a:
        assert (tmp_path / "a" / name).read_bytes() == (tmp_path / "b" / name).read_bytes()


def test_documents_without_ids_and_one_id_are_dealt_to_many_files(spark, tmp_path):
    for k, key in enumerate((None, 5)):
        rows = [(key if i % 10 else i, f"text number {i} " * 3, "", "", 0, 0, "") for i in range(600)]
        uri = f"file://{tmp_path}/{k}"
        manifest = token_files.write_token_files(spark.createDataFrame(rows, SCHEMA).repartition(4), uri)
        assert max(f.docs for f in manifest.collect()) <= 0.6 * len(rows)
        got = sorted(token_files.read_token_files(manifest, uri).collect(), key=lambda r: r.start)
        encode = plain()
        h = lambda t: xxhash.xxh64_intdigest(t.encode(), 42)
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, h(r[1]) - (h(r[1]) >> 63 << 64)))
        assert [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got] == [(r[0], [*encode(r[1]), 2]) for r in order]


def test_ids_read_back(spark, odd_frame, odd_docs, tmp_path):
    uri = f"file://{tmp_path}/t"
    rows = token_files.read_token_files(token_files.write_token_files(odd_frame, uri), uri).collect()
    encode, texts = plain(), {d[0]: d[1] for d in odd_docs}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {k: [*encode(t), 2] for k, t in texts.items()}


@pytest.mark.parametrize("top", [1, 200, 256, 70_000, 1 << 25, (1 << 32) - 1])
def test_codec(top):
    r = random.Random(top)
    for n in (0, 1, 3, 4, 5, 1000):
        v = np.array([r.randrange(top + 1) for _ in range(n)], np.uint32)
        control, data = token_files.encode_values(v)
        assert len(control) == (n + 3) // 4
        assert token_files.decode_values(control, data, n).tolist() == v.tolist()
    docs = [(None, np.array([1], np.uint32)), (5, np.empty(0, np.uint32)), (-7, np.array([top, 0, 300], np.uint32))]
    assert [(k, v.tolist()) for k, v in token_files.parse_file(token_files.file_bytes(docs))] == [(k, v.tolist()) for k, v in docs]
    assert token_files.parse_file(token_files.file_bytes([])) == []


def test_common_ids_get_the_smallest_ranks():
    ids = np.array([9, 9, 9, 4, 4, 70_000, 5, 5], np.uint32)
    assert token_files.rank_ids(ids).tolist() == [9, 4, 5, 70_000]
