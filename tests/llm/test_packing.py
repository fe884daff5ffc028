import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from gridscan.llm import packing
from gridscan.llm.tokenize import default_vocabulary, encoder

from .conftest import SF


def plain():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def check(rows, docs):
    encode = plain()
    want = {k: [*encode(t), 1] for k, t in docs}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    for k, ps in pieces.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            ids = np.array(want[k][at : at + p.length], "<u4")
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[k]) and p.ids_crc32 == zlib.crc32(ids.tobytes())
            at += p.length
        assert at == len(want[k])
    padding = 0
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / (sum(map(len, want.values())) + padding)


def test_documents(spark, small_docs):
    assert check(packing.pack(spark.read.parquet(f"{SF}/documents.parquet")).collect(), small_docs) < 0.001


def test_odd_texts(odd_frame, odd_docs, empty_frame):
    assert check(packing.pack(odd_frame).collect(), [d[:2] for d in odd_docs]) < 0.001
    assert packing.pack(empty_frame).count() == 0


def packed_sizes(sizes, window=2048):
    """(share of ids beside whole windows that were moved at the end, padding) of documents of these sizes."""
    packer = packing.Packer(0, window)
    for k, n in enumerate(sizes):
        packer.add(k, np.full(n, k, "<u4").tobytes())
    at_end = {id(p) for ws in packer.open.values() for w in ws for p in w}
    packer.finish()
    filled = defaultdict(int)
    for _, _, n, _, _, seq, offset in packer.rows:
        assert offset == filled[seq]
        filled[seq] += n
    assert sum(filled.values()) == sum(sizes) and all(0 < n <= window for n in filled.values()) and not packer.open
    assert packer.moved <= packer.placed and len(at_end) <= len(sizes)
    padding = sum(window - n for n in filled.values() if n & (n - 1))
    return packer.moved / max(1, packer.placed), padding


def test_most_pieces_stay_where_the_level_array_put_them():
    r = np.random.default_rng(4)
    for n, most in ((200, 0.55), (1000, 0.35), (10_000, 0.1), (40_000, 0.05)):
        moved, padding = packed_sizes(np.maximum(1, r.lognormal(6, 0.9, n).astype(int)).tolist())
        print(n, moved)
        assert moved < most and padding == 0


def test_few_and_odd_sizes():
    for sizes in ([], [1], [2048], [2047], [2049], [1] * 5000, [1500, 1500, 1500], [4096, 3, 2045], [1025] * 7, [2047, 1, 2047, 2, 2046]):
        assert packed_sizes(sizes)[1] == 0


def test_choice_is_the_least_sum_of_squares():
    r = random.Random(8)
    window = 64
    chooser, counts = packing.SumOfSquares(window), [0] * (window + 1)
    for _ in range(3000):
        size = r.randrange(1, window)

        def after(level):
            now = counts.copy()
            if level:
                now[level] -= 1
            if level + size < window:
                now[level + size] += 1
            return sum(c * c for c in now)

        options = [0] + [x for x in range(1, window - size + 1) if counts[x]]
        level = chooser.choose(size)
        assert level in options and after(level) == min(map(after, options))
        if level:
            counts[level] -= 1
        if level + size < window:
            counts[level + size] += 1
        assert counts == chooser.counts.tolist()


def test_encoder_equals_the_library(small_docs, odd_docs):
    encode, want = encoder(default_vocabulary()), plain()
    r = random.Random(3)
    odd = ["".join(r.choice([" ", "\n", "\t", "a", "é", ".", "'s", "12", " ", "\0", "<|endoftext|>"]) for _ in range(r.randrange(30))) for _ in range(3000)]
    for t in [t for _, t in small_docs] + [d[1] for d in odd_docs] + odd:
        assert np.frombuffer(encode(t), "<u4").tolist() == want(t)
