"""Suffix-array dedup: removes every byte that lies in a 100-byte string which also starts earlier.

No stage ships all suffixes. Every 100-byte window has one anchor, its least 20-byte gram by hash (the
leftmost of equal ones), which depends on the window's bytes alone, so equal windows have equal
anchors. Windows in a row that share an anchor form one entry: gram, hash of the bytes that the windows
cover, place. About one position in 41 is an anchor. Hashes only bring together what may be equal; whether
it is, the deep-shallow sort of the bytes themselves decides, in every step that finds repeats.

1. Scan: entries are made per document. Those of a task that may be equal are sorted by their bytes; of equal
   ones the first stays, the others' bytes are noted as repeated. What is left is dealt by gram. A gram that a task
   holds very often is hot: its entries aren't dealt but asked for at once, and its gram is only marked.
2. By gram: where several entries share a gram, their bytes are asked for.
3. By document: those bytes are cut out. Entries of hot grams are split by more of the bytes around them, sixteen
   windows at a time, and sorted within the task, so that only windows which are new to it go on.
4. By gram: the suffixes at which windows start are sorted and neighbours that agree in 100 bytes are repeats
   of the first of them. Hot ones go through rounds: by groups of documents first, then what is new there, four windows
   at a time, by groups of groups, so that a phrase in any number of documents never meets in one task as often.
5. By document: repeated spans are joined and cut out.

Blobs of numpy arrays travel instead of rows. Documents are shuffled once; both uses read the same exchange.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, helper_prefix, input_partitions, stored_bytes
from .deep_shallow import sort_suffixes, word_table

LENGTH = 100
GRAM = 20
SPAN = LENGTH - GRAM + 1
#: Entries of one gram beyond which it is split.
HOT = 2000
SPLIT = 16
#: Entries of one gram in one flush of a task beyond which the gram is marked as hot, and the most that all flushes together may deal to one gram
#: by staying below: the first falls with the input's size, so that no task ever holds more.
LOCAL_HOT, GRAM_ENTRIES = 64, 4 << 20
#: Buckets of documents, and groups of them, whose hot windows are sorted together in one round; windows that stay hot are then cut finer.
GROUP, FINE = 64, 4
#: Bytes hashed at once, entries held before they are sent on, input bytes per gram bucket.
CHUNK = 1 << 20
FLUSH = 1 << 20
BUCKET_BYTES = 16 << 20
#: Bytes of contexts sorted at once; one gram's are never parted.
SORT_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POS_BITS = np.uint64(22)
_ENTRY = np.dtype([("g", "<u8"), ("c", "<u8"), ("d", "<i8"), ("p", "<i8"), ("x", "u1"), ("n", "u1")])
#: What travels of an entry; the hash of its context has then done its work.
_DEALT = ("g", "d", "p", "x", "n")
_SPANS = np.dtype([("d", "<i8"), ("lo", "<i8"), ("hi", "<i8")])
_powers: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for one chunk."""
    if not _powers:
        n = CHUNK + 4 * LENGTH
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, b in (("up", _BASE), ("down", inverse)):
            t = np.full(n, b, np.uint64)
            t[0] = 1
            _powers[name] = np.multiply.accumulate(t)
    return _powers["up"], _powers["down"]


def _window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Mixed 64-bit hashes of all runs of ``width`` bytes of a chunk."""
    up, down = _tables()
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[width:] - sums[: n - width + 1]) * down[: n - width + 1]
    h ^= h >> np.uint64(31)
    h *= _MIX
    h ^= h >> np.uint64(29)
    return h


def _entries(buffer: bytes, docs: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(entries of a chunk, where each begins in the buffer); docs lists (key, start and end in the buffer, offset of the start in the document)."""
    from xxhash import xxh3_64_intdigest

    data = np.frombuffer(buffer, np.uint8)
    if len(data) < LENGTH:
        return np.empty(0, _ENTRY), np.empty(0, np.int64)
    grams = _window_hashes(data, GRAM)
    low = (grams >> _POS_BITS << _POS_BITS) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= SPAN:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[: len(low) - (SPAN - step)], low[SPAN - step :])  # by window, of which there are len(data) - LENGTH + 1
    anchor = (low & np.uint64((1 << 22) - 1)).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, bool)
    for _, lo, hi, _ in docs:
        if hi - lo >= LENGTH:
            valid[lo : hi - LENGTH + 1] = True
    first = valid[:-1].copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-2]
    last = valid[:-1].copy()
    last[:-1] &= (anchor[1:] != anchor[:-1]) | ~valid[1:-1]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    out = np.empty(len(lo), _ENTRY)
    view = memoryview(buffer)
    out["g"] = grams[anchor[lo]]
    out["c"] = np.fromiter((xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (hi + LENGTH).tolist())), np.uint64, len(lo))
    out["x"] = anchor[lo] - lo
    out["n"] = hi - lo + 1
    starts = np.array([d[1] for d in docs])
    which = np.searchsorted(starts, lo, "right") - 1
    out["d"] = np.array([d[0] for d in docs])[which]
    out["p"] = lo - starts[which] + np.array([d[3] for d in docs])[which]
    return out, lo


def _twins(key: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _repeated(group: np.ndarray, d: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether each row has one of a smaller (document, place) in its group."""
    rank = np.lexsort((p, d, group))
    out = np.zeros(len(rank), bool)
    out[rank[1:]] = group[rank][1:] == group[rank][:-1]
    return out


def _repeated_entries(text: bytes, start: np.ndarray, e: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each entry's bytes, which begin at ``start``, are those of an entry of a smaller (document, place): by sorting those whose hashes occur again."""
    out = np.zeros(len(e), bool)
    some = np.flatnonzero(_twins(e["g"] * _BASE ^ hashes + e["n"].astype(np.uint64)))
    if not len(some):
        return out
    words = word_table(text)
    for n in np.unique(e["n"][some]).tolist():
        mine = some[e["n"][some] == n]
        mine = mine[np.argsort(start[mine])]
        order, same = sort_suffixes(text, start[mine], LENGTH + n - 1, words=words)
        which = mine[np.searchsorted(start[mine], order)]
        out[which] = _repeated(np.cumsum(~same), e["d"][which], e["p"][which])
    return out


def join_spans(d: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Maximal spans per document, sorted."""
    out = np.empty(len(d), _SPANS)
    out["d"], out["lo"], out["hi"] = d, lo, hi
    if not len(out):
        return out
    out = out[np.lexsort((out["lo"], out["d"]))]
    new_doc = np.concatenate([[True], out["d"][1:] != out["d"][:-1]])
    # A running maximum that starts anew with every document: documents are set far apart on one axis.
    rank = np.cumsum(new_doc) - 1
    room = int(out["hi"].max()) + 2
    if len(out) and rank[-1] * room < 1 << 62:
        top = np.maximum.accumulate(out["hi"] + rank * room)
        new = np.concatenate([[True], out["lo"][1:] + rank[1:] * room > top[:-1]])
        at = np.flatnonzero(new)
        ends = top[np.append(at[1:], len(out)) - 1] - rank[at] * room
        got = out[at]
        got["hi"] = ends
        return got
    parts = [join_spans(p["d"], p["lo"], p["hi"]) for p in np.array_split(out, np.flatnonzero(new_doc)[1:])]
    return np.concatenate(parts)


def _repeats(e: np.ndarray) -> np.ndarray:
    return join_spans(e["d"], e["p"], e["p"] + e["n"].astype(np.int64) + LENGTH - 1)


def _row(bucket, kind: int, payload: bytes) -> tuple:
    return int(bucket), kind, payload


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    b, k, p = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(k, pa.int32()), pa.array(p, pa.binary())], ["b", "kind", "payload"])


def _split(values: np.ndarray, bucket: np.ndarray):
    """(bucket, its values) for every bucket that occurs, order kept."""
    order = np.argsort(bucket, kind="stable")
    values, bucket = values[order], bucket[order]
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    for part, b in zip(np.split(values, cuts), bucket[np.append(0, cuts)] if len(bucket) else ()):
        if len(part):
            yield int(b), part


#: Kinds of blobs: entries, marks of hot grams and contexts (those of hot grams by themselves) go by gram; spans and requests go by document.
ENTRIES, SPANS, REQUESTS, CONTEXTS, MARKS, HOT_CONTEXTS = range(6)
_BLOB = "b long, kind int, payload binary"


def _doc_bucket(d: np.ndarray, buckets: int) -> np.ndarray:
    return d % buckets


def _span_rows(spans: np.ndarray, buckets: int) -> list[tuple]:
    return [_row(b, SPANS, part.tobytes()) for b, part in _split(spans, _doc_bucket(spans["d"], buckets))]


def _request_rows(ask: np.ndarray, hot: np.ndarray, buckets: int) -> list[tuple]:
    ask = ask.copy()
    ask["c"] = hot
    return [_row(b, REQUESTS, part.tobytes()) for b, part in _split(ask, _doc_bucket(ask["d"], buckets))]


def _scan(gram_buckets: int, doc_buckets: int, local_hot: int | None = None):
    """Step 1. Spans and requests travel along, dealt like entries of bucket (document's bucket mod gram buckets)."""

    def run(batches):
        held: list[tuple[bytes, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            e = np.concatenate([x for _, x, _ in held])
            begin = np.cumsum([0, *(len(b) for b, _, _ in held)])
            again = _repeated_entries(b"".join(b for b, _, _ in held), np.concatenate([at + k for (_, _, at), k in zip(held, begin)]), e, e["c"])
            later, e = e[again], e[~again]
            _, gram, count = np.unique(e["g"], return_inverse=True, return_counts=True)
            hot = count[gram] > (LOCAL_HOT if local_hot is None else local_hot)
            along = _span_rows(_repeats(later), doc_buckets) + _request_rows(e[hot], np.ones(hot.sum(), bool), doc_buckets)
            rows = [_row(d % gram_buckets, kind, np.int64(d).tobytes() + p) for d, kind, p in along]
            marks = np.unique(e["g"][hot])
            rows += [_row(b, MARKS, part.tobytes()) for b, part in _split(marks, (marks % np.uint64(gram_buckets)).astype(np.int64))]
            e = e[~hot]
            for b, part in _split(e, (e["g"] % np.uint64(gram_buckets)).astype(np.int64)):
                rows.append(_row(b, ENTRIES, b"".join(np.ascontiguousarray(part[c]).tobytes() for c in _DEALT)))
            return _batch(rows)

        for buffer, docs in _chunks(batches):
            held.append((buffer, *_entries(buffer, docs)))
            size += len(held[-1][1])
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return run


def _chunks(batches):
    """(bytes, documents in them) of about CHUNK bytes; a longer document is cut so that pieces share LENGTH - 1 bytes."""
    parts: list[bytes] = []
    docs: list[tuple[int, int, int, int]] = []
    size = 0
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_buffer()
            at = 0
            while len(text) - at >= LENGTH:
                piece = text[at : at + CHUNK - size].to_pybytes()
                if len(piece) < LENGTH or (len(piece) < len(text) - at and size):
                    yield b"".join(parts), docs
                    parts, docs, size = [], [], 0
                    continue
                parts.append(piece)
                docs.append((key, size, size + len(piece), at))
                size += len(piece)
                at += len(piece) - LENGTH + 1
                if CHUNK - size < LENGTH:
                    yield b"".join(parts), docs
                    parts, docs, size = [], [], 0
    if docs:
        yield b"".join(parts), docs


def _from_columns(raw: bytes) -> np.ndarray:
    n = len(raw) // sum(_ENTRY[c].itemsize for c in _DEALT)
    out, at = np.zeros(n, _ENTRY), 0
    for c in _DEALT:
        out[c] = np.frombuffer(raw, _ENTRY[c], n, at)
        at += n * _ENTRY[c].itemsize
    return out


def _by_bucket(batches):
    """(bucket, [(kind, payload)]) from rows sorted by bucket."""
    now, held = None, []
    for batch in batches:
        for b, kind, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if b != now and held:
                yield now, held
                held = []
            now = b
            held.append((kind, payload.as_py()))
    if held:
        yield now, held


def _first_pass(doc_buckets: int):
    """Step 2."""

    def run(batches):
        for _, held in _by_bucket(batches):
            rows = [_row(np.frombuffer(p, "<i8", 1)[0], kind, p[8:]) for kind, p in held if kind in (SPANS, REQUESTS)]
            blobs = [_from_columns(p) for kind, p in held if kind == ENTRIES]
            if blobs:
                e = np.concatenate(blobs)
                marks = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(p, "<u8") for kind, p in held if kind == MARKS)])
                _, gram, count = np.unique(e["g"], return_inverse=True, return_counts=True)
                marked = np.isin(e["g"], marks)
                asked = (count[gram] > 1) | marked
                rows += _request_rows(e[asked], (marked | (count[gram] > HOT))[asked], doc_buckets)
            yield _batch(rows)

    return run


def _core_pieces(e: np.ndarray, width: int, read) -> tuple[np.ndarray, np.ndarray]:
    """(entries cut to ``width`` windows at a time, the entry that each was cut from). A piece's gram is the hash of the bytes that its windows
    share; ``read(k, place, n)`` gives n bytes of entry k's document.
    """
    from xxhash import xxh3_64_intdigest

    pieces, parents = [], []
    for r in range((SPAN + width - 1) // width):
        # a window at p holds its anchor at offset p0 + x - p, which lies in [r * width, (r + 1) * width)
        at = e["p"] + e["x"]
        lo = np.maximum(e["p"], at - (r + 1) * width + 1)
        hi = np.minimum(e["p"] + e["n"] - 1, at - r * width)
        some = np.flatnonzero(hi >= lo)
        part = e[some].copy()
        part["p"], part["n"] = lo[some], (hi - lo + 1)[some]
        part["x"] = (at - lo)[some]
        core = at[some] - r * width
        part["g"] = [xxh3_64_intdigest(read(k, c, LENGTH - width + 1), r) for k, c in zip(some.tolist(), core.tolist())]
        pieces.append(part)
        parents.append(some)
    return np.concatenate(pieces), np.concatenate(parents)


def _context_rows(e: np.ndarray, kind: int, bucket: np.ndarray, texts: dict) -> list[tuple]:
    rows = []
    for b, part in _split(e, bucket):
        size = part["n"].astype(np.int64) + LENGTH - 1
        body = b"".join(texts[d][p : p + n].to_pybytes() for d, p, n in zip(part["d"].tolist(), part["p"].tolist(), size.tolist()))
        rows.append(_row(b, kind, np.int64(len(part)).tobytes() + part.tobytes() + body))
    return rows


def _contexts(payloads: list[bytes]) -> tuple[np.ndarray, bytes]:
    """(entries, their bytes end to end) of blobs of contexts."""
    heads, bodies = [np.empty(0, _ENTRY)], []
    for p in payloads:
        n = int(np.frombuffer(p, "<i8", 1)[0])
        heads.append(np.frombuffer(p, _ENTRY, n, 8))
        bodies.append(p[8 + n * _ENTRY.itemsize :])
    return np.concatenate(heads), b"".join(bodies)


def _cut_contexts(gram_buckets: int, doc_buckets: int, names: tuple[str, str, str], group: int = GROUP):
    """Step 3: (documents of a bucket, blobs for it) -> contexts by gram, those of hot grams by gram and group of buckets."""
    key, text, own = names

    def run(docs: pa.Table, blobs: pa.Table) -> pa.Table:
        asked = [np.frombuffer(p.as_py(), _ENTRY) for k, p in zip(blobs.column("kind").to_pylist(), blobs.column("payload")) if k == REQUESTS]
        if not asked:
            return pa.Table.from_batches([_batch([])])
        ask = np.concatenate(asked)
        texts = {k: t.as_buffer() for k, t in zip(docs.column(key).to_pylist(), docs.column(text))}
        cold, hot = ask[ask["c"] == 0], ask[ask["c"] > 0]
        rows = _context_rows(cold, CONTEXTS, (cold["g"] % np.uint64(gram_buckets)).astype(np.int64), texts)
        if len(hot):
            d = hot["d"].tolist()
            pieces, _ = _core_pieces(hot, SPLIT, lambda k, at, n: texts[d[k]][at : at + n])
            size = pieces["n"].astype(np.int64) + LENGTH - 1
            body = b"".join(texts[d][p : p + n].to_pybytes() for d, p, n in zip(pieces["d"].tolist(), pieces["p"].tolist(), size.tolist()))
            spans, fresh = _sorted_repeats(pieces, body)
            pieces = pieces[fresh]
            pieces["c"] = docs.column(own)[0].as_py() // group
            rows += _span_rows(spans, doc_buckets) + _context_rows(pieces, HOT_CONTEXTS, _salted(pieces, gram_buckets), texts)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _salted(e: np.ndarray, gram_buckets: int) -> np.ndarray:
    """Buckets by gram and group of documents, which stands in ``c``."""
    return ((e["g"] + e["c"] * _BASE) % np.uint64(gram_buckets)).astype(np.int64)


def _sort_contexts(gram_buckets: int, doc_buckets: int, group: int = GROUP, more: bool = False, width: int = 0):
    """Step 4. With ``more`` rounds to come, hot windows that are new in their group of documents go on to a group of groups, cut to ``width`` windows if given."""

    def run(batches):
        for bucket, held in _by_bucket(batches):
            rows = [_row(bucket, SPANS, p) for k, p in held if k == SPANS]
            for kind in (CONTEXTS, HOT_CONTEXTS):
                e, body = _contexts([p for k, p in held if k == kind])
                if not len(e):
                    continue
                spans, fresh = _sorted_repeats(e, body)
                rows += _span_rows(spans, doc_buckets)
                if kind == HOT_CONTEXTS and more:
                    rows += _fresh_rows(e, body, fresh, gram_buckets, group, width)
            yield _batch(rows)

    return run


def _fresh_rows(e: np.ndarray, body: bytes, fresh: np.ndarray, gram_buckets: int, group: int, width: int) -> list[tuple]:
    """Contexts of the entries that hold a window which is new in their group, by gram and group of groups."""
    size = e["n"].astype(np.int64) + LENGTH - 1
    begin = (np.cumsum(size) - size)[fresh]
    e = e[fresh]
    if width:
        first, place = begin.tolist(), e["p"].tolist()
        e, parent = _core_pieces(e, width, lambda k, at, n: body[first[k] + at - place[k] : first[k] + at - place[k] + n])
        begin = begin[parent] + e["p"] - np.array(place)[parent]
    e["c"] //= np.uint64(group)
    size = e["n"].astype(np.int64) + LENGTH - 1
    rows = []
    for b, which in _split(np.arange(len(e)), _salted(e, gram_buckets)):
        text = b"".join(body[i : i + n] for i, n in zip(begin[which].tolist(), size[which].tolist()))
        rows.append(_row(b, HOT_CONTEXTS, np.int64(len(which)).tobytes() + e[which].tobytes() + text))
    return rows


def _taken(e: np.ndarray, text: bytes, begin: np.ndarray, which: np.ndarray) -> bytes:
    size = e["n"][which].astype(np.int64) + LENGTH - 1
    return b"".join([text[i : i + n] for i, n in zip(begin[which].tolist(), size.tolist())])


def _sorted_repeats(e: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """As ``_repeated_windows``, some grams at a time: whole contexts are sorted first, then the windows of those that differ."""
    from xxhash import xxh3_64_intdigest

    size = e["n"].astype(np.int64) + LENGTH - 1
    begin = np.cumsum(size) - size
    order = np.argsort(e["g"], kind="stable")
    ends = np.cumsum(size[order])
    edge = np.flatnonzero(np.append(e["g"][order][1:] != e["g"][order][:-1], True)) + 1  # a gram's entries stay together
    spans, fresh, lo = [np.empty(0, _SPANS)], np.ones(len(e), bool), 0
    while lo < len(order):
        least = (ends[lo - 1] if lo else 0) + SORT_BYTES
        hi = int(edge[np.searchsorted(edge, min(np.searchsorted(ends, least) + 1, len(order)))])
        some, lo = order[lo:hi], hi
        body = _taken(e, text, begin, some)
        mine, at = e[some], np.cumsum(size[some]) - size[some]
        hashes = np.fromiter((xxh3_64_intdigest(body[i : i + n]) for i, n in zip(at.tolist(), size[some].tolist())), np.uint64, len(some))
        again = _repeated_entries(body, at, mine, hashes)
        fresh[some[again]] = False
        spans.append(_repeats(mine[again]))
        _, gram, count = np.unique(mine["g"][~again], return_inverse=True, return_counts=True)
        left = np.flatnonzero(~again)[count[gram] > 1]
        if len(left):
            found, new = _repeated_windows(mine[left], _taken(mine, body, at, left))
            spans.append(found)
            fresh[some[left[~new]]] = False
    got = np.concatenate(spans)
    return join_spans(got["d"], got["lo"], got["hi"]), fresh


def _repeated_windows(e: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(spans of the windows that repeat an earlier one, whether each entry has a window that doesn't), among contexts laid end to end in text."""
    n = e["n"].astype(np.int64)
    size = n + LENGTH - 1
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(e)), n)
    start = begin[owner] + np.arange(len(owner)) - (np.cumsum(n) - n)[owner]  # in text, of every window
    hashes = np.empty(len(text), np.uint64)
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(text) - LENGTH + 1, CHUNK):
        h = _window_hashes(data[at : at + CHUNK + LENGTH - 1], LENGTH)
        hashes[at : at + len(h)] = h
    twin = _twins(hashes[start])
    start, owner = start[twin], owner[twin]
    by_start = np.full(len(text), -1, np.int64)
    by_start[start] = owner
    order, same = sort_suffixes(text, start, LENGTH)
    own = by_start[order]
    d, p = e["d"][own], e["p"][own] + (order - begin[own])
    gone = _repeated(np.cumsum(~same), d, p)
    fresh = n > np.bincount(own[gone], minlength=len(e))
    return join_spans(d[gone], p[gone], p[gone] + LENGTH), fresh


def _spans_by_doc(docs: pa.Table, blobs: pa.Table, key: str) -> list[np.ndarray]:
    """For each document of the bucket its repeated spans, as rows (lo, hi)."""
    got = [np.frombuffer(p.as_py(), _SPANS) for k, p in zip(blobs.column("kind").to_pylist(), blobs.column("payload")) if k == SPANS]
    keys = docs.column(key).to_numpy()
    if not got:
        return [np.empty((0, 2), np.int64)] * len(keys)
    raw = np.concatenate(got)
    spans = join_spans(raw["d"], raw["lo"], raw["hi"])
    pairs = np.stack([spans["lo"], spans["hi"]], axis=1)
    lo, hi = np.searchsorted(spans["d"], keys, "left"), np.searchsorted(spans["d"], keys, "right")
    return [pairs[a:b] for a, b in zip(lo.tolist(), hi.tolist())]


def kept_bytes(text: bytes, spans: np.ndarray) -> bytes:
    """text without the spans."""
    if not len(spans):
        return text
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _with_key(docs: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    """docs with a unique long ``name`` in order of id: the id itself where it is unique and never null."""
    n, there, different = docs.agg(F.count("*"), F.count(id_col), F.countDistinct(id_col)).first()
    if n == there == different:
        return docs.withColumn(name, F.col(id_col).cast("long"))
    order = [F.col(id_col).asc_nulls_first(), F.xxhash64(text)]
    spread = docs.withColumn(name, F.rand(7))  # rows of one id and text may go to several tasks
    ordered = spread.repartitionByRange(input_partitions(docs), *order, name).sortWithinPartitions(*order, name)
    return cut_lineage(ordered.withColumn(name, F.monotonically_increasing_id()))


def apply_spans(docs: DataFrame, finish, schema, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``finish(documents, bytes of each text, spans)`` over buckets of documents, as an Arrow table with columns of ``schema``.

    ``documents`` has the columns of docs but the text, and some more; spans has one array of (lo, hi) per document: the
    maximal runs of bytes that repeat an earlier string. Null texts are empty. Of rows with one id (or without any, which come first)
    the order is by a hash of the text.
    """
    p = helper_prefix(docs.columns, "_s_")
    key, text, own = names = f"{p}key", f"{p}text", f"{p}b"
    rows = _with_key(docs, id_col, text_col, key).withColumn(text, F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")))
    parts = input_partitions(docs)
    size = stored_bytes(docs)
    grams = int(min(max(parts, size // BUCKET_BYTES), 1 << 20))
    buckets = _prime(grams)
    # Stored bytes are a third of the text at worst, and a flush holds FLUSH entries of 41 bytes.
    flushes = parts + 3 * size // (41 * FLUSH)
    local_hot = max(1, min(LOCAL_HOT, GRAM_ENTRIES // flushes))
    entries = rows.select(key, text).mapInArrow(_scan(grams, buckets, local_hot), _BLOB)
    first = cut_lineage(entries.repartition(parts, "b").sortWithinPartitions("b").mapInArrow(_first_pass(buckets), _BLOB))
    dealt = rows.drop(text_col).withColumn(own, F.pmod(F.col(key), F.lit(buckets).cast("long"))).groupBy(own)
    asked = first.where(F.col("kind") == REQUESTS).groupBy("b")
    contexts = dealt.cogroup(asked).applyInArrow(_cut_contexts(grams, buckets, names), _BLOB)
    groups, width = -(-buckets // GROUP), FINE
    spans = first.where(F.col("kind") == SPANS)
    while groups > 1:
        found = cut_lineage(_dealt(contexts, parts).mapInArrow(_sort_contexts(grams, buckets, more=True, width=width), _BLOB))
        spans = spans.unionByName(found.where(F.col("kind") == SPANS))
        contexts, groups, width = found.where(F.col("kind") == HOT_CONTEXTS), -(-groups // GROUP), 0
    spans = spans.unionByName(_dealt(contexts, parts).mapInArrow(_sort_contexts(grams, buckets), _BLOB))

    def run(part: pa.Table, blobs: pa.Table) -> pa.Table:
        return finish(part, part.column(text), _spans_by_doc(part, blobs, key))

    return dealt.cogroup(spans.groupBy("b")).applyInArrow(run, schema)


def _dealt(blobs: DataFrame, parts: int) -> DataFrame:
    return blobs.repartition(parts, "b").sortWithinPartitions("b")


def _prime(n: int) -> int:
    """The least prime from n on, so that ids in steps spread over all buckets."""
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: n_bytes, n_removed, n_spans and the SHA-256 of what is left.

    Null texts count as empty, and texts below 100 bytes never repeat; long ones are treated whole. Repeated rows are rows of their own,
    the first of which keeps its text; rows without an id come before all others. An empty table gives an empty one.
    """

    def finish(part: pa.Table, texts: pa.ChunkedArray, spans: list[np.ndarray]) -> pa.Table:
        texts = [t.as_buffer() for t in texts]
        left = [hashlib.sha256(kept_bytes(t.to_pybytes(), s)).hexdigest() for t, s in zip(texts, spans)]
        columns = [
            part.column("id"),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([int((s[:, 1] - s[:, 0]).sum()) for s in spans], pa.int64()),
            pa.array([len(s) for s in spans], pa.int64()),
            pa.array(left, pa.string()),
        ]
        return pa.Table.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return apply_spans(narrow, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", "id", "text")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every repeated byte cut out of the text; characters that lose a part of their bytes go as a whole.

    All rows stay, those whose whole text repeats with an empty text, null texts as empty ones. Other columns are untouched, whatever their names;
    repeated rows, rows without an id and empty tables: as in ``repeat_report``.
    """
    names = docs.columns

    def finish(part: pa.Table, texts: pa.ChunkedArray, spans: list[np.ndarray]) -> pa.Table:
        left = [kept_bytes(t.as_py(), s).decode("utf-8", "ignore") for t, s in zip(texts, spans)]
        return pa.Table.from_arrays([pa.array(left, pa.string()) if c == text_col else part.column(c) for c in names], names)

    return apply_spans(docs, finish, docs.schema, id_col, text_col).select(*[F.col(f"`{c}`") for c in names])
