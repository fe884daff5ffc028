import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from gridscan.llm import mixing, simhash

from .test_mixing import brute_copies, targets, words
from .test_packing import plain
from .test_quality_rules import brute, verdict
from .test_simhash import exact_kept
from .test_suffix_dedup import local


def test_stages_in_order(spark, odd_frame, tmp_path):
    docs = odd_frame
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()} if k else {}
        given = docs
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if k < 4:
            assert docs.columns == names
        if k == 0:
            assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in given.collect() if verdict(brute(r.text)))
        elif k == 1:
            left = {r.doc_id for r in rows}
            assert left == {r.doc_id for r in simhash.simhash_dedup(given).collect()}
            for i, r in before.items():
                if any(j < i and r.text == q.text for j, q in before.items()):
                    assert i not in left
        elif k == 2:
            want = local([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in rows} == set(before)
            for r in rows:
                n, gone, _, _ = want[r.doc_id]
                assert n - gone - 8 <= len(r.text.encode()) <= n - gone and r.n_chars == len(r.text)
        elif k == 3:
            plan = {r.id: r.copies for r in mixing.mix_plan(given).collect() if r.copies}
            assert Counter(r.doc_id for r in rows) == plan
        else:
            assert sum(r.length for r in rows if r.start == 0) > 0
            assert {r.doc_id for r in rows} == set(before)


def test_run_rows_of_every_stage_by_plain_references(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "scratch_dir", lambda s, what: f"{tmp_path}/p")
    assert corpus_pipeline.ORACLE_SQL is None
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    ruled, near, cut, mixed = (spark.read.parquet(f"{tmp_path}/p/{k}").collect() for k in range(4))
    want = sorted(r for r in docs if verdict(brute(r.text)))
    assert sorted(ruled) == want
    left = set(exact_kept([(r.doc_id, r.text) for r in want]))
    want = [r for r in want if r.doc_id in left]
    assert sorted(near) == want
    passages = local([(r.doc_id, r.text) for r in want])
    assert sorted(r.doc_id for r in cut) == sorted(left)
    sizes, largest = Counter(), Counter()
    for r in cut:
        n, gone, _, _ = passages[r.doc_id]
        assert n - gone - 8 <= len(r.text.encode()) <= n - gone and r.n_chars == len(r.text)
        sizes[r.source] += words(r.text)
        largest[r.source] = max(largest[r.source], words(r.text))
    copies, goal, taken = Counter(r.doc_id for r in mixed), targets(sizes), Counter()
    by_id = {r.doc_id: r for r in cut}
    assert all(r == by_id[r.doc_id] for r in mixed)
    plan = brute_copies([(r.doc_id, r.text, None, r.source) for r in cut])
    assert copies == {i: c for i, _, _, c in plan if c}
    for _, s, size, c in plan:
        taken[s] += c * size
    assert all(abs(taken[s] - goal[s]) <= largest[s] for s in sizes)
    encode, heads, tokens = plain(), Counter(), Counter()
    ids = {k: [*encode(by_id[k].text), 1] for k in copies}
    for p in out:
        part = np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert len(part) == p.length > 0 and p.ids_crc32 == zlib.crc32(part.tobytes())
        heads[p.doc_id] += p.start == 0
        tokens[p.doc_id] += p.length
    assert heads == copies and tokens == {k: n * len(ids[k]) for k, n in copies.items()}
