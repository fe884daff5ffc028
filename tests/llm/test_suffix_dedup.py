import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from gridscan.llm import queries, suffix_dedup
from gridscan.llm.deep_shallow import BlindTrie, sort_suffixes

from .conftest import SCHEMA, SF


def brute(docs):
    """{position in docs: (n_bytes, n_removed, n_spans, digest)} of documents whose ids differ."""
    order = sorted(range(len(docs)), key=lambda k: docs[k][0])
    return dict(zip(order, in_order([docs[k] for k in order])))


def in_order(docs):
    """(n_bytes, n_removed, n_spans, digest) of each document, by looking every window up among all before it."""
    seen, out = set(), []
    for k in range(len(docs)):
        t = (docs[k][1] or "").encode()
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - 99):
            w = t[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            seen.add(w)
        gone = gone[:-1] if len(t) else gone[:0]
        spans = int(((gone[1:] & ~gone[:-1]).sum() if len(t) else 0) + (gone[0] if len(t) else 0))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows(df):
    return sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in df.collect()), key=str)


def want(docs):
    return sorted(((docs[k][0], *v) for k, v in brute(docs).items()), key=str)


def test_odd_texts_match_brute_force(odd_frame, odd_docs):
    assert rows(suffix_dedup.repeat_report(odd_frame)) == want(odd_docs)


def test_query_matches_brute_force(spark, small_docs):
    assert rows(queries.QUERIES["op1_suffix_dedup"](spark, SF)) == want(small_docs)


def test_hot_grams_and_cut_documents_give_the_same(odd_docs, monkeypatch):
    """The split of hot grams, found in one task or over all, their groups and the cutting of long documents, without Spark."""
    expected = {odd_docs[k][0]: v for k, v in brute(odd_docs).items()}
    for hot, chunk, local_hot, group, flush in ((2000, 1 << 20, 64, 100, 1 << 20), (1, 1 << 20, 64, 3, 200), (2000, 700, 64, 100, 50), (1, 700, 2, 2, 500), (2000, 1 << 20, 1, 2, 100), (2000, 1 << 20, 3, 100, 100)):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        monkeypatch.setattr(suffix_dedup, "FLUSH", flush)
        monkeypatch.setattr(suffix_dedup, "SORT_BYTES", chunk)
        suffix_dedup._powers.clear()
        assert local(odd_docs, local_hot=local_hot, group=group) == expected, (hot, chunk, local_hot, group, flush)
    suffix_dedup._powers.clear()


def local(docs, grams=3, buckets=7, local_hot=64, group=100, seen=None):
    """The five steps in one process; ``seen`` gets the bytes that the fullest bucket and all buckets of each step read."""
    import pyarrow as pa

    keys = pa.array([d[0] for d in docs], pa.int64())
    texts = pa.array([(d[1] or "").encode() for d in docs], pa.binary())
    table = pa.table({"k": keys, "t": texts, "o": pa.array([d[0] % buckets for d in docs], pa.int64())})

    def flow(rows, step):
        rows = [(b, k, p) for t in rows for b, k, p in zip(*(t.column(i).to_pylist() for i in range(3)))]
        rows.sort(key=lambda x: x[0])
        if seen is not None:
            sizes = Counter()
            for b, _, p in rows:
                sizes[b] += len(p)
            seen.append((max(sizes.values(), default=0), sum(sizes.values())))
        return pa.Table.from_batches(list(step([suffix_dedup._batch(rows)])) or [suffix_dedup._batch([])])

    only = lambda t, kind: t.filter(pa.compute.equal(t.column("kind"), kind))
    first = flow(suffix_dedup._scan(grams, buckets, local_hot)(table.to_batches()), suffix_dedup._first_pass(buckets))
    contexts = []
    for b in range(buckets):
        own, asked = (t.filter(pa.compute.equal(t.column(c), b)) for t, c in ((table, "o"), (first, "b")))
        if own.num_rows:
            contexts.append(suffix_dedup._cut_contexts(grams, buckets, ("k", "t", "o"), group)(own, asked))
    groups, width, tables = -(-buckets // group), suffix_dedup.FINE, [first]
    while groups > 1:
        found = flow(contexts, suffix_dedup._sort_contexts(grams, buckets, group, True, width))
        tables.append(only(found, suffix_dedup.SPANS))
        contexts, groups, width = [only(found, suffix_dedup.HOT_CONTEXTS)], -(-groups // group), 0
    tables.append(flow(contexts, suffix_dedup._sort_contexts(grams, buckets)))
    spans = suffix_dedup._spans_by_doc(table, pa.concat_tables(tables), "k")
    out = {}
    for d, s in zip(docs, spans):
        t = (d[1] or "").encode()
        out[d[0]] = (len(t), int((s[:, 1] - s[:, 0]).sum()), len(s), hashlib.sha256(suffix_dedup.kept_bytes(t, s)).hexdigest())
    return out


def test_one_phrase_in_every_document_is_dealt_to_many_buckets(monkeypatch):
    """A phrase of 400 bytes in each of 3,000 documents: no bucket of any step reads more than a few times its share."""
    r = random.Random(7)
    phrase = "".join(r.choice("abcdefgh ") for _ in range(400))
    around = lambda: "".join(r.choice("xy") for _ in range(160))
    docs = [(i, around() + phrase + around()) for i in range(3000)]
    monkeypatch.setattr(suffix_dedup, "HOT", 50)
    monkeypatch.setattr(suffix_dedup, "FLUSH", 1000)
    seen = []
    got = local(docs, grams=61, buckets=61, local_hot=8, group=8, seen=seen)
    assert got == {docs[k][0]: v for k, v in brute(docs).items()}
    assert len(seen) == 3 and all(most < 0.06 * total for most, total in seen), seen


def test_sorting_finds_what_hashes_confuse(monkeypatch, odd_docs):
    """With hashes of four values for whole contexts and windows, results stay: bytes decide."""
    import xxhash

    true_windows = suffix_dedup._window_hashes
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda b, seed=0: len(bytes(b)) % 4)
    monkeypatch.setattr(suffix_dedup, "_window_hashes", lambda data, width: true_windows(data, width) if width == suffix_dedup.GRAM else true_windows(data, width) % np.uint64(4))
    docs = [d for d in odd_docs if len(d[1] or "") < 4000]
    for hot in (2000, 3):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        assert local(docs) == {docs[k][0]: v for k, v in brute(docs).items()}


def test_random_texts_over_a_small_alphabet():
    r = random.Random(1)
    for seed in range(6):
        docs = []
        pool = ["".join(r.choice("ab ") for _ in range(r.randrange(40, 260))) for _ in range(6)]
        for i in range(40):
            docs.append((i * 3 + seed, "".join(r.choice(pool) for _ in range(r.randrange(0, 6))) + "".join(r.choice("ab") for _ in range(r.randrange(30)))))
        assert local(docs) == {docs[k][0]: v for k, v in brute(docs).items()}


@pytest.mark.parametrize("alphabet", ["ab", "a", "abcdefgh"])
def test_sort_suffixes(alphabet):
    r = random.Random(3)
    text = "".join(r.choice(alphabet) for _ in range(3000)) * 2
    text = text.encode()
    starts = np.array(r.sample(range(len(text) - 100), 2500))
    order, same = sort_suffixes(text, starts, 100)
    got = [text[s : s + 100] for s in order.tolist()]
    assert sorted(order.tolist()) == sorted(starts.tolist())
    assert got == sorted(got)
    assert same.tolist() == [False] + [a == b for a, b in zip(got, got[1:])]


def test_blind_trie_gives_shared_lengths():
    text = b"abcabdabcabcabx" + b"\0" * 10
    trie = BlindTrie(text, 6)
    for s in range(9):
        trie.insert(s)
    order, shared = trie.walk()
    got = [text[s : s + 6] for s in order]
    assert got == sorted(got)
    for k in range(1, len(got)):
        n = next((i for i in range(6) if got[k][i] != got[k - 1][i]), 6)
        assert shared[k] == n


def test_null_and_repeated_ids(spark, odd_docs):
    """Rows without ids come first, and rows of one id go by the hash of their text."""
    docs = [(None if k % 10 == 0 else d[0] // 30, *d[1:]) for k, d in enumerate(odd_docs)]

    def place(d):
        h = xxhash.xxh64_intdigest((d[1] or "").encode(), 42) if d[1] is not None else 42
        return d[0] is not None, d[0] or 0, h - (h >> 63 << 64)

    ordered = sorted(docs, key=place)
    expected = sorted(((docs_row[0], *v) for docs_row, v in zip(ordered, in_order(ordered))), key=str)
    assert rows(suffix_dedup.repeat_report(spark.createDataFrame(docs, SCHEMA))) == expected


def test_remove_repeats_keeps_rows_and_columns(odd_frame, empty_frame, odd_docs):
    out = suffix_dedup.remove_repeats(odd_frame)
    assert out.schema.names == odd_frame.schema.names and out.count() == len(odd_docs)
    assert suffix_dedup.remove_repeats(empty_frame).count() == 0
    assert suffix_dedup.repeat_report(empty_frame).count() == 0
