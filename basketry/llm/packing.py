"""Sum-of-squares online packing of token documents into windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from basketry.llm.common import Tables, python_tasks, texts_of

#: Partially filled windows that one task keeps before it closes them.
OPEN_WINDOWS = 4096

#: Partitions whose open windows one task goes on with, and how often at the most:
#: 64^6 partitions come down to one task.
PARTS_A_TASK, MOST_TURNS = 64, 6

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


class Packer:
    """Places documents in the order they come.

    ``counts[h]`` is the number of open windows filled to level h. What is left
    of a document after its full windows goes to the level, or to a new window,
    that makes the sum of the squared counts least; ties go to the fuller one.

    ``leave`` hands over the pieces of the windows that are still open, for others
    to go on with. ``flush``, at the very end and when more than ``most_open``
    windows are open, joins these in order and cuts them anew at the window's size;
    the last remainder is cut at powers of two, which need no padding.
    """

    def __init__(self, size: int = 1024, first_sequence: int = 0, most_open: int = OPEN_WINDOWS):
        self.size, self.next, self.most_open = size, first_sequence, most_open
        self.counts = np.zeros(size + 1, np.int64)
        self.at_level: list[list[list]] = [[] for _ in range(size + 1)]
        self.n_open = 0
        self.done: list[tuple] = []  # rows of pieces

    def _close(self, pieces: list) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((key, start, n, zlib.crc32(ids), total, self.next, offset, None))
            offset += n
        self.next += 1

    def level(self, need: int) -> int:
        """The level to fill, 0 for a new window."""
        counts, size = self.counts, self.size
        here = counts[1 : size - need + 1]
        after = counts[need + 1 : size + 1]
        change = np.where(here > 0, 2 * (after - here) + 2, np.iinfo(np.int64).max)
        if len(change) and here[-1]:
            change[-1] = 1 - 2 * here[-1]  # that window is full and leaves
        new = 2 * counts[need] + 1
        if not len(change):
            return 0
        best = len(change) - 1 - int(np.argmin(change[::-1]))
        return best + 1 if change[best] <= new else 0

    def add(self, key, ids: bytes) -> None:
        total, wide = len(ids) // 4, 4 * self.size
        cut = total // self.size * wide
        for i in range(0, cut, wide):
            self._close([(key, i // 4, ids[i : i + wide], total)])
        if cut < len(ids):
            self.place(key, cut // 4, ids[cut:], total)

    def place(self, key, start: int, ids: bytes, total: int) -> None:
        """Put a piece shorter than a window into one."""
        need = len(ids) // 4
        level = self.level(need)
        window = self.at_level[level].pop() if level else []
        window.append((key, start, ids, total))
        self.counts[level] -= level > 0
        self.n_open += level == 0
        if level + need == self.size:
            self._close(window)
            self.n_open -= 1
        else:
            self.at_level[level + need].append(window)
            self.counts[level + need] += 1
        if self.n_open > self.most_open:
            self.flush()

    def leave(self) -> None:
        """Give up the open windows: their pieces become rows that keep their ids."""
        for windows in self.at_level:
            for window in windows:
                for key, start, ids, total in window:
                    self.done.append((key, start, len(ids) // 4, None, total, self.next, 0, ids))
                self.next += 1
        self._nothing_open()

    def _nothing_open(self) -> None:
        self.at_level = [[] for _ in range(self.size + 1)]
        self.counts[:] = 0
        self.n_open = 0

    def flush(self) -> None:
        """Close all open windows without padding."""
        left = sum(h * len(w) for h, w in enumerate(self.at_level))
        room = min(left, self.size) if left >= self.size else _power_below(left)
        window: list = []
        for windows in reversed(self.at_level):
            for key, start, ids, total in (p for w in windows for p in w):
                while ids:
                    part = ids[: 4 * room]
                    window.append((key, start, part, total))
                    n = len(part) // 4
                    ids, start, room, left = ids[4 * n :], start + n, room - n, left - n
                    if not room:
                        self._close(window)
                        window = []
                        room = self.size if left >= self.size else _power_below(left)
        self._nothing_open()

    def rows(self) -> pd.DataFrame:
        """The pieces of the windows closed since the last call."""
        done, self.done = self.done, []
        names = [c.split()[0] for c in PIECES.split(", ")]
        frame = pd.DataFrame(done, columns=[*names, "ids"])
        for name in ("doc_id", "ids_crc32"):
            frame[name] = frame[name].astype("Int64")
        return frame


def _power_below(n: int) -> int:
    return 1 << (n.bit_length() - 1) if n else 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    size: int = 1024,
    most_open: int = OPEN_WINDOWS,
) -> DataFrame:
    """Pack every whole text into sequences of at most ``size`` tokens.

    A document is the ids of its text, then ``end_id``. Each partition of ``docs``
    is packed on its own as it is read. The pieces in windows that are open at its
    end go to one task for every ``PARTS_A_TASK`` partitions, which goes on placing
    them, the longest first, and so on until one task has the last of them; only what
    is open then is cut anew. How much that is depends on the method: placing all
    documents in one task leaves about as much open (28 % of what is left of 10,000
    documents after their full windows, 13 % of 50,000, less of more). A task holds at most ``most_open`` open windows, and each round has a
    small part of the pieces of the one before.

    Returns a row per piece: doc_id, start (the document's ids before it),
    length, ids_crc32, doc_tokens, sequence_id, offset in the sequence. A
    sequence shorter than ``size`` is as long as a power of two. A null text is
    empty and gives one piece, the end id. Rows that repeat are packed each;
    null keys stay null. An empty table gives no pieces. Runs jobs: the rows of
    each round are written.
    """
    python_tasks(docs.sparkSession)
    tables = Tables(docs.sparkSession)
    schema = f"{PIECES}, ids binary"

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from basketry.llm.tokens import encoder

        encode, end = encoder(tokenizer).encode, np.uint32(end_id).tobytes()
        packer = Packer(size, TaskContext.get().partitionId() << 36, most_open)
        for frame in frames:
            keys = [None if pd.isna(k) else int(k) for k in frame["doc_id"]]
            for key, ids in zip(keys, encode(list(frame["text"]))):
                packer.add(key, ids + end)
            yield packer.rows()
        packer.leave()
        yield packer.rows()

    def go_on(turn: int, last: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            first = turn << 60 | TaskContext.get().partitionId() << 36
            packer = Packer(size, first, most_open)
            for frame in frames:
                keys = [None if pd.isna(k) else int(k) for k in frame["doc_id"]]
                for row in zip(keys, frame["start"], frame["ids"], frame["doc_tokens"]):
                    packer.place(*row)
                yield packer.rows()
            packer.flush() if last else packer.leave()
            yield packer.rows()

        return run

    found = tables.write(texts_of(docs).mapInPandas(place, schema))
    closed, turn = [found.where("ids IS NULL")], 0
    while turn < MOST_TURNS and not (left := found.where("ids IS NOT NULL")).isEmpty():
        turn += 1
        parts = left.select(F.expr("shiftright(sequence_id, 36)")).distinct().count()
        tasks = -(-parts // PARTS_A_TASK) if turn < MOST_TURNS else 1
        dealt = left.repartition(tasks, F.expr("shiftright(sequence_id, 36)"))
        ordered = dealt.sortWithinPartitions(F.desc("length"), "sequence_id", "start", "doc_id")
        found = tables.write(ordered.mapInPandas(go_on(turn, tasks == 1), schema))
        closed.append(found.where("ids IS NULL"))
    return reduce(DataFrame.union, closed).drop("ids")
