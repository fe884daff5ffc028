"""SimHash near-dedup with BK-trees.

A document's fingerprint holds, for each of 64 bits, the majority over the XXH64 hashes of its 3-word
shingles. Distinct fingerprints are dealt to shards: 64 bits fall into four blocks, and two
fingerprints at distance 2 or less agree in at least two of them, so each of the six pairs of blocks
gives one shard key. Every shard builds a BK-tree (children keyed by the integer Hamming distance to
their parent), and a search follows only edges within the radius. A shard's tree goes to the task that
holds the shard's queries: a broadcast of all trees would grow with the corpus.

Links stay a forest in each shard (one link per new member), so a group of copies never yields all its
pairs. Components come from alternating large and small stars, checkpointed each round.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, drop_checkpoint, helper_prefix, input_partitions

BITS = 64
BLOCK = 16
RADIUS = 2
WIDTH = 3
#: Shards above this size are parted by further blocks before their trees are built.
SHARD_LIMIT = 2048
_STEP = 1 << 15


def fingerprint_bytes(text: bytes | None, width: int = WIDTH) -> int:
    """SimHash of one text as an unsigned integer; a text without words gives 0."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    n = len(words) - width + 1
    if not words:
        return 0
    if n < 1:
        n, runs = 1, iter([b" ".join(words)])
    else:
        runs = map(b" ".join, zip(*(words[k : k + n] for k in range(width))))
    hashes = np.fromiter(map(xxh64_intdigest, runs, repeat(42)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, _STEP):
        part = hashes[at : at + _STEP]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(batches):
    for b in batches:
        got = np.fromiter((fingerprint_bytes(t.as_py()) for t in b.column(2)), np.uint64, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got.view(np.int64))], ["id", "text_key", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, fp): the SimHash of every text, as a signed long, and a hash that tells rows of one id apart."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), _text_key(text_col).alias("text_key"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(_fingerprint_batches, "id long, text_key long, fp long")


def _text_key(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


class BKTree:
    """A BK-tree over integers under Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        """Insert a value that the tree does not hold yet; a value that it holds changes nothing."""
        new = len(self.values)
        at = 0
        while new:
            d = (self.values[at] ^ value).bit_count()
            if not d:
                return
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = new
                break
            at = down
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Positions (in order of insertion) of all values within the radius, as they are found."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                yield at
            todo += [k for e, k in self.children[at].items() if d - radius <= e <= d + radius]


def _forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect exactly what the radius connects among these distinct values.

    A search ends once it has met every component there is so far, so a dense group of near copies
    isn't searched in full by each of its members.
    """
    tree, up, out, parts = BKTree(), list(range(len(values))), [], 0

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, v in enumerate(values):
        met = 0
        for j in tree.within(v, radius):
            a, b = root(i), root(j)
            if a != b:
                up[a] = b
                out.append((v, values[j]))
                met += 1
                if met == parts:
                    break
        parts += 1 - met
        tree.add(v)
    return out


def shard_links(values: np.ndarray, radius: int = RADIUS, depth: int = 0) -> list[tuple[int, int]]:
    """As ``_forest``; a large shard is first parted by blocks of the bits that vary in it, of which any close pair shares one."""
    if len(values) <= SHARD_LIMIT or depth >= 3:
        return _forest(values.tolist(), radius)
    vary = np.bitwise_or.reduce(values ^ values[0])
    bits = [b for b in range(BITS) if int(vary) >> b & 1]
    out: list[tuple[int, int]] = []
    for k in range(radius + 1):
        mask = np.uint64(sum(1 << b for b in bits[k :: radius + 1]))
        order = np.argsort(values & mask, kind="stable")
        keys = (values & mask)[order]
        for part in np.split(order, np.flatnonzero(keys[1:] != keys[:-1]) + 1):
            if len(part) > 1:
                out += shard_links(values[part], radius, depth + 1)
    return out


def _linked(batches):
    """Shards arrive whole and in order of their keys; one is held at a time."""
    keys = np.empty(0, np.int64)
    fps = np.empty(0, np.uint64)
    for b in _and_end(batches):
        last = b is None
        if not last:
            keys = np.concatenate([keys, b.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = np.concatenate([[0], cuts, [len(keys)]])
        done = len(keys) if last else edges[-2]
        whole = edges[:-1] if last else edges[:-2]
        sizes = np.diff(edges)[: len(whole)]
        links: list[tuple[int, int]] = []
        for at, n in zip(whole[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            links += shard_links(fps[at : at + n])
        keys, fps = keys[done:], fps[done:]
        if links:
            got = np.array(links, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], ["u", "v"])


def _and_end(batches):
    yield from batches
    yield None


def fingerprint_links(distinct: DataFrame, partitions: int) -> DataFrame:
    """(u, v): links among the distinct fingerprints in column fp, enough to connect all that lie within the radius."""
    blocks = [F.shiftrightunsigned("fp", BLOCK * k).bitwiseAND(0xFFFF) for k in range(BITS // BLOCK)]
    tables = [
        F.lit(t << 2 * BLOCK).cast("long") + F.shiftleft(blocks[i], BLOCK) + blocks[j]
        for t, (i, j) in enumerate(combinations(range(len(blocks)), 2))
    ]
    keyed = distinct.select(F.explode(F.array(*tables)).alias("key"), "fp")
    return keyed.repartition(partitions, "key").sortWithinPartitions("key", "fp").mapInArrow(_linked, "u long, v long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by alternating large and small stars.

    Every round is a partial aggregate and a join, both of which spread a hot node's links; every
    round's edges are checkpointed, and those of the round before deleted.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = cut_lineage(edges)
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        last, edges = edges, cut_lineage(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        drop_checkpoint(last)
        now = edges.agg(F.count("*"), F.sum(F.col("u").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)")), F.countDistinct("u")).first()
        if now == before and now[0] == now[3]:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


#: Near-dedup of documents: candidates have 1024-bit fingerprints of their sets of 5-word shingles within 240 bits, and are linked
#: if the sets' Jaccard likeness is LIKE_PART / LIKE_WHOLE or more. At 0.8 large sets differ in 155 bits on average (deviation 11.5),
#: the sets that fare worst (four shingles against five) in 192 (deviation 12.5).
LIKE_WIDTH, LIKE_WORDS, LIKE_RADIUS = 5, 16, 240
LIKE_PART, LIKE_WHOLE = 4, 5
#: Shards of near-dedup: ten keys, each of two least hashes. Texts of likeness 0.8 share one with probability 0.99996.
KEYS, KEY_HASHES = 10, 2
#: Groups of candidates above this size are parted by their shards' keys before their links are checked.
GROUP_LIMIT = 4096
#: Bytes of shingle sets that a task holds in memory; more of one group go to a temporary file.
HELD_BYTES = 64 << 20
#: Odd multiples of the golden ratio's 64-bit fraction: one per word of a shingle, one per word of a fingerprint.
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1 for k in range(LIKE_WORDS + 1)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def shingle_set(text: bytes | None, width: int = LIKE_WIDTH) -> np.ndarray:
    """Sorted hashes of the different runs of ``width`` words, lower-cased; a shorter text is one run, a blank one none."""
    from xxhash import xxh3_64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += h[k : k + n] * _ODD[k]
    return np.unique(_mixed(total))


#: Rows that are counted bit by bit rather than added up three by three.
_FEW = 32


def bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many of the rows, (n, words) unsigned 64-bit, have each of the 64 * words bits set.

    Three rows at a time are added as bits (a sum and a carry of twice its weight), so that few rows of every weight are left to count.
    """
    n, width = rows.shape
    out = np.zeros(64 * width, np.int64)
    weight = 1
    while len(rows):
        carries = []
        while len(rows) > _FEW:
            m = len(rows) // 3
            a, b, c = rows[:m], rows[m : 2 * m], rows[2 * m : 3 * m]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            rows = np.concatenate([odd ^ c, rows[3 * m :]])
        bits = np.unpackbits(np.ascontiguousarray(rows).view(np.uint8), axis=1, bitorder="little")
        out += weight * bits.sum(0, dtype=np.int64)
        rows, weight = np.concatenate(carries) if carries else rows[:0], 2 * weight
    return out


def like_fingerprint(hashes: np.ndarray, words: int = 4) -> bytes:
    """The majority of each of 64 bits a word over all hashes; zeros for none. At most LIKE_WORDS words."""
    ones = np.zeros(BITS * words, np.int64)
    step = _STEP >> 3  # what stays in a processor's cache
    for at in range(0, len(hashes), step):
        ones += bit_counts(_mixed(hashes[at : at + step, None] * _ODD[1 : words + 1] + np.arange(words, dtype=np.uint64)))
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def shard_keys(hashes: np.ndarray) -> list[int]:
    """KEYS signed 64-bit keys from the least hashes of KEYS * KEY_HASHES equal ranges; an empty range takes the next one's."""
    from xxhash import xxh3_64_intdigest

    if not len(hashes):
        return list(range(KEYS))
    bins = KEYS * KEY_HASHES
    edges = np.searchsorted(hashes, np.arange(bins, dtype=np.uint64) * np.uint64((1 << 64) // bins))
    full = edges < np.append(edges[1:], len(hashes))
    least = [int(hashes[e]) if f else None for e, f in zip(edges.tolist(), full.tolist())]
    after = next(x for x in least if x is not None)
    for k in range(bins - 1, -1, -1):
        if least[k] is None:
            least[k] = after ^ (k + 1)
        else:
            after = least[k]
    out = []
    for k in range(KEYS):
        raw = b"".join(x.to_bytes(8, "little") for x in least[k * KEY_HASHES : (k + 1) * KEY_HASHES])
        out.append(int(np.uint64(xxh3_64_intdigest(raw, k)).astype(np.int64)))
    return out


def _like_batches(batches):
    from xxhash import xxh3_64_intdigest

    for b in batches:
        nodes, prints, keys = [], [], []
        for t in b.column(2):
            h = shingle_set(t.as_py())
            nodes.append(xxh3_64_intdigest(h.tobytes()))
            prints.append(like_fingerprint(h, LIKE_WORDS))
            keys.append(shard_keys(h))
        fps = pa.array(np.array(nodes, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps, pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "text_key", "fp", "like", "keys"])


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _like_links(batches):
    """Links that connect the candidates of each shard. Shards arrive whole and in order of their keys; one is held at a time."""
    now, held = None, {}

    def links():
        if len(held) < 2:
            return []
        return [(held[a], held[b]) for a, b in _forest(list(held), LIKE_RADIUS)]

    for b in batches:
        out = []
        for key, node, like in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if key != now:
                out += links()
                now, held = key, {}
            first = held.setdefault(int.from_bytes(like, "little"), node)
            if first != node:
                out.append((first, node))
        if out:
            yield _link_batch(out)
    if last := links():
        yield _link_batch(last)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted shingle sets have a Jaccard likeness of LIKE_PART / LIKE_WHOLE or more, exactly; empty sets are alike."""
    if len(a) > len(b):
        a, b = b, a
    if LIKE_WHOLE * len(a) < LIKE_PART * len(b):
        return False
    if not len(a):
        return True
    both = np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)
    return bool(LIKE_WHOLE * both >= LIKE_PART * (len(a) + len(b) - both))


class _Sets:
    """Shingle sets by position; those beyond HELD_BYTES lie in a temporary file."""

    def __init__(self) -> None:
        self.held: list[np.ndarray | tuple[int, int]] = []
        self.size = 0
        self.file = None

    def add(self, hashes: np.ndarray) -> None:
        if self.size + hashes.nbytes <= HELD_BYTES:
            self.size += hashes.nbytes
            self.held.append(hashes)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.held.append((self.file.seek(0, 2), len(hashes)))
        self.file.write(hashes.tobytes())

    def __getitem__(self, i: int) -> np.ndarray:
        x = self.held[i]
        if isinstance(x, np.ndarray):
            return x
        self.file.seek(x[0])
        return np.frombuffer(self.file.read(8 * x[1]), np.uint64)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def verified_forest(values: list[int], sets, radius: int = LIKE_RADIUS) -> list[tuple[int, int]]:
    """Pairs of positions that connect exactly what likeness connects among the candidates within the radius.

    As in ``_forest`` a search ends once it has met every component there is so far, but components are
    joined by pairs alone whose shingle sets are alike.
    """
    tree, up, out, parts = BKTree(), list(range(len(values))), [], 0
    places: dict[int, list[int]] = {}

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, v in enumerate(values):
        met, mine = 0, sets[i]
        for j in (j for at in tree.within(v, radius) for j in places[tree.values[at]]):
            a, b = root(i), root(j)
            if a != b and alike(mine, sets[j]):
                up[a] = b
                out.append((i, j))
                met += 1
                if met == parts:
                    break
        parts += 1 - met
        tree.add(v)
        places.setdefault(v, []).append(i)
    return out


def _verified_links(batches):
    """Links whose shingle sets are alike. Groups arrive whole and in order; one is held at a time."""
    now, nodes, values, sets = None, [], [], _Sets()

    def links():
        out = [(nodes[a], nodes[b]) for a, b in verified_forest(values, sets)]
        sets.close()
        return out

    for b in batches:
        out = []
        for group, node, like, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            if group != now:
                out += links()
                now, nodes, values, sets = group, [], [], _Sets()
            if not nodes or nodes[-1] != node:
                nodes.append(node)
                values.append(int.from_bytes(like, "little"))
                sets.add(shingle_set(text.as_py()))
        if out:
            yield _link_batch(out)
    if last := links():
        yield _link_batch(last)


def _near(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """As ``_rooted``, for texts of likeness 0.8 or more; fp stands for a shingle set by its hash.

    Shards give candidate links. Each group that those connect goes to one task with a text of every
    member, and only links whose shingle sets are alike count; a large group goes to a task for each
    shard key of its members.
    """
    text = F.col(text_col).cast("binary")
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), _text_key(text_col).alias("text_key"), text.alias("text"))
    rows = cut_lineage(narrow.mapInArrow(_like_batches, "id long, text_key long, fp long, like binary, keys array<long>"))
    distinct = rows.groupBy("fp").agg(F.min(F.struct("like", "keys", "id", "text_key")).alias("x"))
    keyed = distinct.select(F.explode("x.keys").alias("key"), "fp", "x.like")
    links = keyed.repartition(input_partitions(docs), "key").sortWithinPartitions("key", "fp").mapInArrow(_like_links, "u long, v long")
    met = components(links)
    met = cut_lineage(met.unionByName(met.select(F.col("root").alias("node"), "root").distinct()))
    sizes = met.groupBy("root").agg(F.count("*").alias("size"))
    parted = F.transform("x.keys", lambda k: F.xxhash64("root", k))
    groups = F.when(F.col("size") > GROUP_LIMIT, parted).otherwise(F.array("root"))
    members = met.join(sizes, "root").join(distinct, F.col("node") == F.col("fp"))
    members = cut_lineage(members.select(F.col("x.id").alias("_n_id"), F.col("x.text_key").alias("_n_text"), groups.alias("groups"), "fp", "x.like"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), _text_key(text_col).alias("text_key"), text.alias("text"))
    texts = texts.join(members, F.col("id").eqNullSafe(F.col("_n_id")) & (F.col("text_key") == F.col("_n_text")))
    texts = texts.select(F.explode("groups").alias("group"), "fp", "like", "text")
    placed = texts.repartition(input_partitions(docs), "group").sortWithinPartitions("group", "fp")
    roots = components(placed.mapInArrow(_verified_links, "u long, v long"))
    fps = rows.select("id", "text_key", "fp")
    nodes = fps.select("fp").distinct()
    return fps, cut_lineage(nodes.join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root")))


def _rooted(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(a row (id, text_key, fp) per row of docs, (fp, root) of every fingerprint), both checkpointed."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col))
    distinct = fps.select("fp").distinct()
    roots = components(fingerprint_links(distinct, input_partitions(docs)))
    named = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return fps, cut_lineage(named)


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of docs.

    Null and blank texts have fingerprint zero and link like any other; long texts are hashed whole. Rows without an id take part
    and get the smallest id of their component, null if it has none. Repeated rows stay repeated; an empty table gives none; other columns are not read.
    """
    fps, named = _rooted(docs, id_col, text_col)
    first = fps.groupBy("fp").agg(F.min("id").alias("first"))
    least = named.join(first, "fp").groupBy("root").agg(F.min("first").alias("component_id"))
    groups = cut_lineage(named.join(least, "root").select("fp", "component_id"))
    return fps.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies: that of the smallest id, rows without an id last, of equal ids the first by a hash of the text.

    Near copies are texts whose sets of 5-word shingles have a Jaccard likeness of 0.8 or more; SimHashes only find the
    pairs, and every link is checked on the two sets. Chains of near copies are one group. Null and blank texts are copies of each other,
    texts of any length are compared whole; of rows equal in id and text any one stays. Columns stay as they were, whatever
    their names; an empty table stays empty.
    """
    fps, named = _near(docs, id_col, text_col)
    place = F.struct(F.col("id").isNull().alias("n"), "id", "text_key")
    first = fps.groupBy("fp").agg(F.min(place).alias("place"))
    kept = named.join(first, "fp").groupBy("root").agg(F.min("place").alias("place")).select("place.id", "place.text_key")
    p = helper_prefix(docs.columns, "_d_")
    same = F.col("id").eqNullSafe(F.col(f"{p}id")) & (F.col("text_key") == F.col(f"{p}text"))
    kept = kept.select(F.col("id").alias(f"{p}id"), F.col("text_key").alias(f"{p}text"))
    # How many rows share the place of a kept one is settled on narrow rows, so that whole ones are joined once and seldom dealt again.
    kept = cut_lineage(fps.join(kept, same).groupBy(f"{p}id", f"{p}text").agg(F.count("*").alias(f"{p}rows")))
    keyed = docs.withColumn(f"{p}key", _text_key(text_col))
    rows = keyed.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(f"{p}id")) & (F.col(f"{p}key") == F.col(f"{p}text")))
    out = rows.where(F.col(f"{p}rows") == 1)
    if kept.where(F.col(f"{p}rows") > 1).limit(1).count():
        out = out.unionByName(rows.where(F.col(f"{p}rows") > 1).dropDuplicates([f"{p}id", f"{p}text"]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
