import random

import numpy as np
import xxhash

from gridscan.llm import queries, simhash

from .conftest import SCHEMA, SF


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs, radius=2):
    """[(id, fingerprint)] -> smallest id reachable, by position."""
    up = list(range(len(pairs)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(pairs))]


def check(df, docs):
    pairs = [(d[0], brute_fingerprint(d[1])) for d in docs]
    want = sorted(((p[0], f"{p[1]:016x}", c) for p, c in zip(pairs, brute_components(pairs))), key=str)
    assert sorted(((x.doc_id, x.fingerprint, x.component_id) for x in df.collect()), key=str) == want


def test_query(spark, small_docs):
    check(queries.QUERIES["op9_simhash"](spark, SF), small_docs)


def test_odd_texts(odd_frame, odd_docs, empty_frame):
    check(simhash.simhash_groups(odd_frame), odd_docs)
    assert simhash.simhash_groups(empty_frame).count() == 0


def test_null_and_repeated_ids(spark, odd_docs):
    docs = [(None if k % 7 == 0 else d[0] // 50, *d[1:]) for k, d in enumerate(odd_docs)]
    check(simhash.simhash_groups(spark.createDataFrame(docs, SCHEMA)), docs)


def clusters(r, n):
    out = set()
    while len(out) < n:
        v = r.getrandbits(64)
        for _ in range(r.randrange(1, 12)):
            out.add(v)
            for _ in range(r.randrange(1, 4)):
                v ^= 1 << r.randrange(64)
    return list(out)[:n]


def test_links_connect_what_the_radius_connects(spark, monkeypatch):
    r = random.Random(2)
    values = clusters(r, 600)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4).collect()
    for e in edges:
        assert ((e.u ^ e.v) & (2**64 - 1)).bit_count() <= 2
    pairs = list(zip(range(len(values)), values))
    roots = {x.node: x.root for x in simhash.components(spark.createDataFrame([(e.u, e.v) for e in edges], "u long, v long")).collect()}
    mine = [roots.get(v, v) for v in signed]
    theirs = brute_components(pairs)
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_large_shards_are_parted_without_loss(monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(simhash, "SHARD_LIMIT", 40)
    values = clusters(r, 500)
    base = r.getrandbits(64)
    values = list(dict.fromkeys(values + [base ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(200)]))
    links = simhash.shard_links(np.array(values, np.uint64))
    at = {v: i for i, v in enumerate(values)}
    up = list(range(len(values)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        up[root(at[a])] = root(at[b])
    mine = [root(i) for i in range(len(values))]
    theirs = brute_components(list(enumerate(values)))
    assert len(set(zip(mine, theirs))) == len(set(mine)) == len(set(theirs))


def test_long_chains_settle(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 200))


def test_bk_tree_finds_all_within(monkeypatch):
    r = random.Random(6)
    values = clusters(r, 300)
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
        tree.add(v)
    assert tree.values == values
    for q in values[:50] + [r.getrandbits(64) for _ in range(10)]:
        for radius in (0, 2, 9):
            assert sorted(tree.within(q, radius)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= radius]


def likeness(a, b):
    sets = []
    for t in (a, b):
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    a, b = sets
    return len(a & b) / len(a | b) if a | b else 1.0


def variant(r, words, share):
    return " ".join(f"new{r.randrange(10**6)}" if r.random() < share else w for w in words)


def test_near_copies_are_found_and_others_left(spark):
    r = random.Random(11)
    texts, origin = [], []
    for k in range(60):
        words = [f"w{r.randrange(3000)}" for _ in range(r.randrange(60, 500))]
        texts.append(" ".join(words))
        origin.append(None)
        for share in (0.004, 0.01, 0.02, 0.3):
            texts.append(variant(r, words, share))
            origin.append(len(texts) - 1 - (0.004, 0.01, 0.02, 0.3).index(share) - 1)
    docs = [(i, t, "en", "s", 0, 0, "") for i, t in enumerate(texts)]
    kept = {x.doc_id for x in simhash.simhash_dedup(spark.createDataFrame(docs, SCHEMA)).collect()}
    near = [i for i, o in enumerate(origin) if o is not None and likeness(texts[i], texts[o]) >= 0.8]
    far = [i for i, o in enumerate(origin) if o is None or likeness(texts[i], texts[o]) < 0.4]
    assert len(near) > 100 and len(far) > 100
    assert sum(i not in kept for i in near) >= 0.97 * len(near)
    assert all(i in kept for i in far)


def test_fingerprints_differ_as_likeness_tells():
    r = random.Random(12)
    words = [f"w{r.randrange(10**5)}" for _ in range(4000)]
    base = int.from_bytes(simhash.like_fingerprint(simhash.shingle_set(" ".join(words).encode())), "little")
    bits = []
    for share in (0.0, 0.02, 0.05, 1.0):
        text = variant(r, words, share)
        other = int.from_bytes(simhash.like_fingerprint(simhash.shingle_set(text.encode())), "little")
        bits.append((base ^ other).bit_count())
    assert bits[0] == 0 and bits[0] < bits[1] < bits[2] < bits[3] and 100 < bits[3] < 156


def test_bits_are_counted_alike():
    r = np.random.default_rng(17)
    for n, words in ((0, 4), (1, 1), (2, 16), (32, 3), (33, 16), (100, 2), (1000, 16), (4097, 1)):
        rows = r.integers(0, 1 << 63, (n, words), dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, (n, words), dtype=np.uint64)
        want = [[int(sum(int(x) >> b & 1 for x in rows[:, k])) for b in range(64)] for k in range(words)]
        assert simhash.bit_counts(rows).tolist() == [c for w in want for c in w]


def test_long_fingerprints_are_majorities():
    r = np.random.default_rng(18)
    for n in (0, 1, 2, 5, 40, 700):
        hashes = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        want = b""
        for k in range(16):
            g = [int(x) for x in simhash._mixed(hashes * simhash._ODD[k + 1] + np.uint64(k))]
            want += sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in g) > len(g)).to_bytes(8, "little")
        assert simhash.like_fingerprint(hashes, 16) == want


def test_documents_well_below_the_likeness_stay(spark):
    r = random.Random(13)
    docs, pairs = [], []
    for k in range(120):
        words = [f"w{r.randrange(10**5)}" for _ in range(r.randrange(150, 600))]
        text, other = " ".join(words), variant(r, words, r.choice((0.01, 0.02, 0.05, 0.06, 0.075, 0.1)))
        docs += [(2 * k, text, "en", "s", 0, 0, ""), (2 * k + 1, other, "en", "s", 0, 0, "")]
        pairs.append(likeness(text, other))
    kept = {x.doc_id for x in simhash.simhash_dedup(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert all(2 * k in kept for k in range(120))
    far, near = [k for k, x in enumerate(pairs) if x < 0.6], [k for k, x in enumerate(pairs) if x >= 0.82]
    assert len(far) > 40 and len(near) > 10
    assert all(2 * k + 1 in kept for k in far) and sum(2 * k + 1 not in kept for k in near) >= 0.95 * len(near)


def test_long_fingerprints_tell_likeness_within_their_error():
    r = random.Random(14)
    words = [f"w{r.randrange(10**5)}" for _ in range(2000)]
    base = simhash.shingle_set(" ".join(words).encode())
    for share in (0.0, 0.01, 0.03, 0.07, 0.15):
        other = simhash.shingle_set(variant(r, words, share).encode())
        prints = [int.from_bytes(simhash.like_fingerprint(x, simhash.LIKE_WORDS), "little") for x in (base, other)]
        n = 64 * simhash.LIKE_WORDS
        p = np.arccos(min(1, len(np.intersect1d(base, other)) / (len(base) * len(other)) ** 0.5)) / np.pi
        assert abs((prints[0] ^ prints[1]).bit_count() - n * p) <= 4 * (n * p * (1 - p)) ** 0.5 + 1


def test_dedup_keeps_one_of_each_group(odd_frame, odd_docs):
    out = simhash.simhash_dedup(odd_frame)
    assert out.columns == odd_frame.columns
    kept = {x.doc_id for x in out.collect()}
    order = sorted(odd_docs)
    for i, d in enumerate(order):
        like = [likeness(d[1], e[1]) for e in order[:i]]
        if any(x >= 0.95 for x in like):
            assert d[0] not in kept
        if all(x < 0.3 for x in like) and all(likeness(d[1], e[1]) < 0.3 for e in order[i + 1 :]):
            assert d[0] in kept


def test_dedup_keeps_one_row_without_ids_and_of_repeated_rows(spark, odd_docs, empty_frame):
    docs = [(None if k % 7 == 0 else d[0] // 50, *d[1:]) for k, d in enumerate(odd_docs)]
    once = simhash.simhash_dedup(spark.createDataFrame(docs, SCHEMA)).collect()
    twice = simhash.simhash_dedup(spark.createDataFrame(docs * 2, SCHEMA)).collect()
    assert sorted(map(str, once)) == sorted(map(str, twice)) and len(once) < len(docs)
    assert simhash.simhash_dedup(empty_frame).count() == 0
    alone = [(None, "one text without an id", "", "", 0, 0, "")] * 3
    assert simhash.simhash_dedup(spark.createDataFrame(alone, SCHEMA)).count() == 1


def exact_kept(docs):
    """Least ids of the components that exact likeness of 0.8 or more connects."""
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if likeness(docs[i][1], docs[j][1]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return sorted(docs[k][0] for k in {root(i) for i in range(len(docs))})


def families(r, count):
    """Texts with changed words, whose likeness to each other lies about 0.8."""
    docs = []
    for _ in range(count):
        words = [f"w{r.randrange(10**5)}" for _ in range(r.choice((9, 60, 300, 500)))]
        docs.append(" ".join(words))
        for _ in range(6):
            copy = list(words)
            for _ in range(max(1, round(len(words) * r.choice((0.005, 0.01, 0.02, 0.03))))):
                copy[r.randrange(len(copy))] = f"new{r.randrange(10**6)}"
            docs.append(" ".join(copy + words[: r.randrange(2)]))
    return [(i, t, "en", "s", 0, 0, "") for i, t in enumerate(docs)]


def test_only_and_all_exact_near_copies_go(spark, monkeypatch):
    docs = families(random.Random(15), 30)
    want = exact_kept(docs)
    near = [likeness(docs[i][1], docs[i + 1][1]) for i in range(0, len(docs), 7)]
    assert any(0.65 <= x < 0.8 for x in near) and 60 < len(want) < len(docs) - 30
    frame = spark.createDataFrame(docs, SCHEMA)
    assert sorted(x.doc_id for x in simhash.simhash_dedup(frame).collect()) == want
    monkeypatch.setattr(simhash, "GROUP_LIMIT", 2)
    assert sorted(x.doc_id for x in simhash.simhash_dedup(frame).collect()) == want


def test_sets_beyond_memory_and_equal_fingerprints(monkeypatch):
    monkeypatch.setattr(simhash, "HELD_BYTES", 4000)
    r = np.random.default_rng(16)
    whole = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (0, 5, 100, 400, 400)]
    sets = simhash._Sets()
    for x in whole:
        sets.add(x)
    assert sets.file is not None and all(np.array_equal(sets[i], x) for i, x in enumerate(whole))
    sets.close()
    assert simhash.alike(whole[0], whole[0]) and not simhash.alike(whole[0], whole[1])
    assert simhash.alike(whole[2], whole[2][:80]) and not simhash.alike(whole[2], whole[2][:79])
    assert simhash.verified_forest([7, 7, 7], [whole[2], whole[3], whole[2][5:]]) == [(2, 0)]
