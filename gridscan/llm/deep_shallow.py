"""Deep-shallow suffix sorting.

Suffixes are first bucketed by their leading bytes and then ordered by multikey quicksort on 8-byte
characters, all groups of one round at a time: a group splits around a pivot into less, equal and
greater, and only the equal part moves on by one character. Groups that still agree at the shallow
depth share a long prefix; each is ordered by a blind trie, which descends by branching bytes alone and
compares a suffix with one leaf.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32
_CHAR = 8


def _word_view(text: np.ndarray) -> np.ndarray:
    """Big-endian 8-byte words at every byte position of a text that ends in 8 spare bytes."""
    return np.ndarray((len(text) - _CHAR + 1,), ">u8", text, 0, (1,))


def _multikey(words: np.ndarray, order: np.ndarray, depth_end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group starts, depth of each group): suffixes sorted until every group is single or agrees up to depth_end."""
    n = len(order)
    group = np.zeros(n, np.int64)  # start of each place's group
    depth = np.zeros(n, np.int64)  # by place
    keys = words[order]
    first = np.argsort(keys, kind="stable")  # the leading characters bucket everything at once
    order, keys = order[first], keys[first]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(new, n))
    group = np.repeat(new, sizes)
    depth[:] = _CHAR
    while True:
        starts = np.flatnonzero(group == np.arange(n))
        sizes = np.diff(np.append(starts, n))
        live = (sizes > 1) & (depth[starts] < depth_end)
        if not live.any():
            return order, starts, depth[starts]
        s, z = starts[live], sizes[live]
        places = np.repeat(s, z) + np.arange(z.sum()) - np.repeat(np.cumsum(z) - z, z)
        keys = words[order[places] + depth[places]]
        at = np.cumsum(z) - z
        three = np.sort(np.stack([keys[at], keys[at + z // 2], keys[at + z - 1]]), axis=0)
        pivot = np.repeat(three[1], z)
        side = (keys > pivot).astype(np.int8) - (keys < pivot)
        moved = np.argsort(np.repeat(np.arange(len(z)) * 3, z) + side + 1, kind="stable")
        order[places] = order[places][moved]
        side, base = side[moved], group[places]
        depth[places] += np.where(side == 0, _CHAR, 0)
        cut = np.flatnonzero(np.concatenate([[True], (base[1:] != base[:-1]) | (side[1:] != side[:-1])]))
        group[places] = np.repeat(places[cut], np.diff(np.append(cut, len(places))))


class BlindTrie:
    """Orders suffixes of ``text`` by their first ``limit`` bytes; equal ones share a leaf."""

    def __init__(self, text: bytes, limit: int) -> None:
        self.text, self.limit = text, limit
        self.root = None  # a leaf is a list of suffixes, an inner node a tuple (depth, {byte: child})

    def common(self, a: int, b: int) -> int:
        """Length of the common prefix, at most the limit."""
        x, y = self.text[a : a + self.limit], self.text[b : b + self.limit]
        if x == y:
            return self.limit
        differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        return self.limit - (differ.bit_length() + 7) // 8

    def insert(self, suffix: int) -> None:
        if self.root is None:
            self.root = [suffix]
            return
        text, node, path = self.text, self.root, []
        while type(node) is tuple:
            path.append(node)
            node = node[1].get(text[suffix + node[0]]) or next(iter(node[1].values()))
        shared = self.common(suffix, node[0])
        if shared >= self.limit:
            node.append(suffix)
            return
        above = None
        below = node
        for inner in path:
            if inner[0] >= shared:
                below = inner
                break
            above = inner
        if type(below) is tuple and below[0] == shared:
            below[1][text[suffix + shared]] = [suffix]
            return
        leaf = below
        while type(leaf) is tuple:
            leaf = next(iter(leaf[1].values()))
        new = (shared, {text[leaf[0] + shared]: below, text[suffix + shared]: [suffix]})
        if above is None:
            self.root = new
        else:
            above[1][text[suffix + above[0]]] = new

    def walk(self) -> tuple[list[int], list[int]]:
        """(suffixes in order, length of the prefix that each shares with the one before; 0 for the first)."""
        order: list[int] = []
        shared: list[int] = []
        todo = [(self.root, 0)] if self.root is not None else []
        while todo:
            node, lcp = todo.pop()
            if type(node) is tuple:
                kids = sorted(node[1].items(), reverse=True)
                todo += [(child, node[0]) for _, child in kids[:-1]]
                todo.append((kids[-1][1], lcp))
            else:
                order += node
                shared += [lcp] + [self.limit] * (len(node) - 1)
        return order, shared


def word_table(text: bytes) -> np.ndarray:
    """The 8-byte characters of a text, for several calls of ``sort_suffixes``."""
    return _word_view(np.frombuffer(text + b"\0" * _CHAR, np.uint8))


def sort_suffixes(text: bytes, starts: np.ndarray, limit: int, shallow: int = SHALLOW, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of text at ``starts`` in order of their first ``limit`` bytes, and for each whether it equals the one before in all of them.

    Every suffix must have ``limit`` bytes of text, ``limit`` being at least ``shallow``, a multiple of 8.
    """
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, bool)
    order, at, depth = _multikey(word_table(text) if words is None else words, np.asarray(starts, np.int64).copy(), shallow)
    same = np.zeros(len(order), bool)
    sizes = np.diff(np.append(at, len(order)))
    for lo, n in zip(at[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        trie = BlindTrie(text, limit)
        for s in order[lo : lo + n].tolist():
            trie.insert(s)
        got, shared = trie.walk()
        order[lo : lo + n] = got
        same[lo : lo + n] = np.array(shared) >= limit
    return order, same
