"""Sum-of-squares online packing.

Every input partition packs its own documents in one pass, without a shuffle: whole windows are cut
off a document's end-marked ids first, and the rest goes to the fill level whose move least increases
the sum of squared counts of partially filled windows, held in one level array. Of the windows still open
at the end of a partition the emptiest are taken apart to fill the fullest, so that only one stays short; that one is cut at
powers of two, which need no padding. All other pieces stay where the level array placed them.

A task holds the ids of its open windows: their counts are what the method keeps small, and each has less than a window's ids.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import default_vocabulary, encoder

WINDOW = 2048
END_ID = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_BATCH = 20_000


class SumOfSquares:
    """Online choice of a fill level for each item; ``counts[l]`` is the number of open windows filled to l."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)

    def choose(self, size: int) -> int:
        """The level to put an item of 1 <= size <= window on; 0 opens a window. Of equal choices the fullest wins."""
        top = self.window - size
        here, there = self.counts[: top + 1], self.counts[size:].copy()
        there[-1] = -1  # a full window is no longer counted: N[window] stays 0 before and after
        change = 2 * (there - here) + 2
        change[-1] = -2 * here[-1] + 1
        change[0] = 2 * there[0] + 1 if top else 0
        change[1:][here[1:] == 0] = np.iinfo(np.int64).max
        level = int(top - np.argmin(change[::-1]))
        if level:
            self.counts[level] -= 1
        if level + size < self.window:
            self.counts[level + size] += 1
        return level


def tail_sizes(n: int) -> list[int]:
    """n as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Places documents one by one; ``pieces`` yields what is final."""

    def __init__(self, base: int, window: int = WINDOW) -> None:
        self.window, self.next = window, base
        self.levels = SumOfSquares(window)
        self.open: dict[int, list[list]] = defaultdict(list)  # level -> windows, each a list of pieces
        self.rows: list[tuple] = []
        self.placed = self.moved = 0  # ids beside whole windows: all that went to a level, and those moved again at the end

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for key, start, ids, total in pieces:
            self.rows.append((key, start, len(ids) // 4, zlib.crc32(ids), total, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def add(self, key: int | None, ids: bytes) -> None:
        total = len(ids) // 4
        cut = total // self.window * self.window
        for at in range(0, cut, self.window):
            self._close([(key, at, ids[4 * at : 4 * (at + self.window)], total)])
        if size := total - cut:
            self.placed += size
            level = self.levels.choose(size)
            pieces = self.open[level].pop() if level else []
            pieces.append((key, cut, ids[4 * cut :], total))
            if level + size == self.window:
                self._close(pieces)
            else:
                self.open[level + size].append(pieces)

    def finish(self) -> None:
        """Fill the windows that are still open: the emptiest are taken apart, and their pieces cut to fit the room in the fullest.

        All other pieces stay where they were placed. Less than a window is left at last; it is cut at powers of two.
        """
        left = [pieces for level in sorted(self.open) for pieces in self.open[level]]  # the emptiest first
        self.open.clear()
        loose: list[tuple] = []  # what is left of the window that is being taken apart
        lent, count = 0, len(left)
        while lent < count:
            count -= 1
            pieces = left[count]  # the fullest
            room = self.window - sum(len(p[2]) // 4 for p in pieces)
            while room and (loose or lent < count):
                if not loose:
                    loose, lent = left[lent][::-1], lent + 1
                key, start, ids, total = loose.pop()
                pieces.append((key, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    loose.append((key, start + room, ids[4 * room :], total))
                self.moved += len(pieces[-1][2]) // 4
                room -= len(pieces[-1][2]) // 4
            if room:
                loose = pieces[::-1]
            else:
                self._close(pieces)
        # The last one, short of a window, or what is left of one that was taken apart.
        rest = sum(len(p[2]) // 4 for p in loose)
        self.moved += rest
        for room in tail_sizes(rest):
            now = []
            while room:
                key, start, ids, total = loose.pop()
                now.append((key, start, ids[: 4 * room], total))
                if len(ids) > 4 * room:
                    loose.append((key, start + room, ids[4 * room :], total))
                room -= len(now[-1][2]) // 4
            self._close(now)

    def drain(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [[]] * 7
        self.rows = []
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece of each row of docs, in windows of 2048 ids at most.

    Null and empty texts hold the end id alone; long ones are cut into whole windows and a rest. Repeated rows and rows without an id are
    packed each for itself; an empty table gives no pieces; other columns are not read. Sequence ids are the partition's number times 2^32 and a running number. Reruns of a task agree,
    as rows are taken in the order of the input partition, which for a scan is fixed by the files.
    """
    path = vocabulary or default_vocabulary()
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        encode = encoder(path)
        packer = Packer(TaskContext.get().partitionId() << 32, window)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(key, encode(text.as_py()) + end)
                if len(packer.rows) >= _BATCH:
                    yield packer.drain()
        packer.finish()
        yield packer.drain()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
