"""Adaptive context-mixing range coder for token ids, many blocks at a time.

Ids are coded in blocks that are reset and checksummed on their own. Within a
block, every order proposes ids for the next one:

* order 2: the id that last followed the two before it,
* order 1: the id that last followed the one before it,
* order 0: a table of the ids seen last, by hash.

Which proposal holds is one of four outcomes (the last: none, a literal id).
Three adaptive models give their probabilities: one without context, one by
the confidence of the order-1 proposal, one by that of both proposals. They
are mixed with weights that follow how well each model predicts, and the mixed
probability drives a carry-less range coder. All arithmetic is on integers, so
that any machine decodes what another has coded.

The steps of one block depend on each other, those of different blocks don't:
step t of all blocks of a segment is one pass of numpy over its blocks.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1024  # ids in a block
_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 40)  # settled high word; least range
_SCALE = _U(12)  # bits of the mixed probabilities
_ONE = 32767  # a probability of 1 in the models
_ALL = 1 << 14  # sum of the weights
_SLOT_BITS = (8, 9, 10)  # of the tables of order 0, 1 and 2
_MAGIC = b"CMR2"


class _Blocks:
    """Model and coder state of all blocks of a segment, for either direction.

    ``bits`` are those of a literal id. Tables of order 1 and 2 hold an id and,
    in the two lowest bits, how often in a row it was right. The four
    probabilities of a context lie side by side in one word of 64 bits, so a
    step fetches and stores them at once.
    """

    def __init__(self, lanes: int, bits: int):
        kind = self.kind = np.int32 if bits <= 16 else np.int64
        self.at = np.arange(lanes, dtype=np.int64)
        self.at4 = self.at << 2
        self.bits = np.array([0, 0, _SLOT_BITS[0], bits], _U)
        self.base = [self.at << b for b in _SLOT_BITS]
        self.table0, self.table1, self.table2 = (
            np.full(lanes << b, -4, kind) for b in _SLOT_BITS
        )
        self.p0, self.p1, self.p2 = (
            np.full(lanes * n * 4, _ONE // 4, np.int16).view(_U) for n in (1, 4, 16)
        )
        self.w0 = np.full(lanes, _ALL // 3, np.int32)
        self.w1 = np.full(lanes, _ALL // 3, np.int32)
        self.one = self.two = np.zeros(lanes, np.uint32)
        self.spread = np.zeros(lanes, np.uint32)  # of the id before, see _spread
        self.low, self.span = np.zeros(lanes, _U), np.full(lanes, ~_U(0), _U)

    def propose(self, k: int) -> None:
        """Proposals and cumulated mixed probabilities of the first k blocks."""
        pair = _spread(self.one[:k] * np.uint32(50021) + self.two[:k])
        self.slot1 = self.base[1][:k] + (self.spread[:k] >> np.uint32(32 - _SLOT_BITS[1]))
        self.slot2 = self.base[2][:k] + (pair >> np.uint32(32 - _SLOT_BITS[2]))
        entry1, entry2 = self.table1.take(self.slot1), self.table2.take(self.slot2)
        self.id1, self.id2 = entry1 >> 2, entry2 >> 2
        self.sure1, self.sure2 = entry1 & 3, entry2 & 3
        self.row1 = self.at4[:k] + self.sure1
        self.row2 = (self.row1 << 2) + self.sure2
        rows = self.p0[:k], self.p1.take(self.row1), self.p2.take(self.row2)
        self.q0, self.q1, self.q2 = (x.view(np.int16) for x in rows)
        each = np.empty((3, 3, k), np.int32)  # of each model, the first three probabilities
        for own, q in zip(each, (self.q0, self.q1, self.q2)):
            own[:] = q.reshape(k, 4).T[:3]
        mixed = _mixed(*each, self.w0[:k], self.w1[:k])
        mixed *= 4092
        mixed >>= 15
        mixed += 1
        ends = np.empty((5, k), np.int32)
        ends[0] = 0
        ends[1] = mixed[0]
        np.add(ends[1], mixed[1], out=ends[2])
        np.add(ends[2], mixed[2], out=ends[3])
        ends[4] = 1 << 12
        self.ends = ends

    def outcome(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first proposal that holds, and what tells its id."""
        slot = self._see(ids)
        known = self.table0.take(self.slot0) == ids
        outcome = 3 - known.astype(np.int64)
        np.copyto(outcome, 1, where=self.right1)
        np.copyto(outcome, 0, where=self.right2)
        return outcome, np.where(known, slot, ids).astype(_U)

    def told(self, outcome: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """The ids of outcomes."""
        recent = np.flatnonzero(outcome == 2)
        ids = extra
        slot = extra[recent] & ((1 << _SLOT_BITS[0]) - 1)
        ids[recent] = self.table0[self.base[0][recent] + slot]
        np.copyto(ids, self.id1, where=outcome == 1)
        np.copyto(ids, self.id2, where=outcome == 0)
        self._see(ids)
        return ids

    def _see(self, ids: np.ndarray) -> np.ndarray:
        """Where the ids are kept in order 0, and which proposals hold."""
        self.now = ids.astype(np.uint32)
        self.spread = _spread(self.now)
        slot = self.spread >> np.uint32(32 - _SLOT_BITS[0])
        self.slot0 = self.base[0][: len(ids)] + slot
        self.right1, self.right2 = self.id1 == ids, self.id2 == ids
        return slot

    def learn(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        k = len(ids)
        own = self.at4[:k] + outcome
        w0, w1 = self.w0[:k], self.w1[:k]
        q0, q1, q2 = (q.take(own).astype(np.int32) for q in (self.q0, self.q1, self.q2))
        mixed = _mixed(q0.copy(), q1.copy(), q2, w0, w1)
        for w, q in ((w0, q0), (w1, q1)):
            w += (w * (q - mixed)) >> 17
            np.maximum(w, 256, out=w)
            np.minimum(w, _ALL // 2 - 256, out=w)
        hit = _HITS.take(outcome).view(np.int16)
        for p, row, q in ((self.p1, self.row1, self.q1), (self.p2, self.row2, self.q2)):
            p[row] = (q + ((hit - q) >> 4)).view(_U)
        self.q0 += (hit - self.q0) >> 5
        packed = ids << 2
        self.table1[self.slot1] = packed | _SURER.take(self.sure1) * self.right1
        self.table2[self.slot2] = packed | _SURER.take(self.sure2) * self.right2
        self.table0[self.slot0] = ids
        self.two, self.one = self.one[:k], self.now

    def narrow(self, outcome: np.ndarray) -> None:
        """The range of an outcome, of a span that is scaled already."""
        k = len(outcome)
        flat = outcome * k + self.at[:k]
        start, end = self.ends.take(flat), self.ends.take(flat + k)
        self.low[:k] += self.span[:k] * start.astype(_U)
        self.span[:k] *= (end - start).astype(_U)

    def settled(self, k: int):
        """Shifts out high words that are settled.

        Yields blocks, whether each has one, and words: first all blocks, as
        most steps settle one in most of them, then only those with more.
        """
        low, span = self.low[:k], self.span[:k]
        differ = low ^ (low + span)
        settled = differ < _TOP
        short = span < _BOTTOM
        ready = settled | short
        apart = np.flatnonzero(ready ^ settled)
        if len(apart):
            a = low[apart]
            span[apart] = (-a) & (_BOTTOM - _U(1))
            differ[apart] = a ^ (a + span[apart])
        yield slice(0, k), ready, low >> _U(48)
        shift = ready.astype(_U) << _U(4)
        low <<= shift
        span <<= shift
        differ <<= shift
        where = np.flatnonzero((differ < _TOP) | (span < _BOTTOM))
        while len(where):
            a, r = low[where], span[where]
            far = (a ^ (a + r)) >= _TOP
            if far.any():
                r[far] = (-a[far]) & (_BOTTOM - _U(1))
            yield where, True, a >> _U(48)
            a <<= _U(16)
            r <<= _U(16)
            low[where], span[where] = a, r
            where = where[((a ^ (a + r)) < _TOP) | (r < _BOTTOM)]


#: What each outcome moves the four probabilities towards, and surer by one.
_HITS = (_U(_ONE) << (np.arange(4, dtype=_U) << _U(4))).astype("<u8").view("<i2").astype(np.int16).view(_U)
_SURER = np.array([1, 2, 3, 3], np.int32)


def _mixed(q0: np.ndarray, q1: np.ndarray, q2: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    """Probabilities by their weights, the third one's being the rest; writes over q0 and q1."""
    q0 -= q2
    q1 -= q2
    q0 *= w0
    q1 *= w1
    q0 += q1
    q0 >>= 14
    q0 += q2
    return q0


def _spread(ids: np.ndarray) -> np.ndarray:
    """A hash of 32 bits, whose highest ones tell a slot."""
    return ids * np.uint32(0x9E3779B1)


def _lanes(n_ids: int, block: int) -> tuple[int, int, int]:
    """Blocks, ids of the last one, and steps."""
    lanes = -(-n_ids // block)
    return lanes, n_ids - (lanes - 1) * block, min(n_ids, block)


def encode_segment(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Ids (unsigned, 32 bits) as one segment of blocks.

    Layout, little-endian: magic, ids, ids per block, bits of a literal; for
    each block its length in 16-bit words and the crc32 of its ids; the blocks.
    """
    ids = np.ascontiguousarray(ids, "<u4")
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    head = _MAGIC + struct.pack("<QII", len(ids), block, bits)
    if not len(ids):
        return head
    lanes, last, steps = _lanes(len(ids), block)
    blocks = _Blocks(lanes, bits)
    padded = np.zeros(lanes * block, blocks.kind)
    padded[: len(ids)] = ids
    columns = np.ascontiguousarray(padded.reshape(lanes, block).T)
    width = steps * 4 + 16
    first = blocks.at * width
    place, out = first.copy(), np.zeros(lanes * width, "<u2")

    def settle(k: int) -> None:
        for where, ready, high in blocks.settled(k):
            out[place[where]] = high  # one that is not ready is written over later
            place[where] += ready

    for t in range(steps):
        k = lanes if t < last else lanes - 1
        now = columns[t, :k]
        blocks.propose(k)
        outcome, extra = blocks.outcome(now)
        low, span = blocks.low[:k], blocks.span[:k]
        span >>= _SCALE
        blocks.narrow(outcome)
        size = blocks.bits.take(outcome)
        extra *= outcome >= 2
        if bits > 16:  # the high part on its own, so that the range never runs out
            settle(k)
            more = np.where(size > 16, size - _U(16) * (size > 16), _U(0))
            span >>= more
            low += span * ((extra >> _U(16)) * (more > 0))
            size = size - more
            extra = extra & _U(0xFFFF)
            settle(k)
        span >>= size
        low += span * extra
        settle(k)
        blocks.learn(now, outcome)
    for shift in (48, 32, 16, 0):
        out[place] = (blocks.low >> _U(shift)) & _U(0xFFFF)
        place += 1
    words = place - first
    sums = [zlib.crc32(ids[i : i + block].tobytes()) for i in range(0, len(ids), block)]
    index = np.stack((words, np.array(sums, np.int64)), 1).astype("<u4").tobytes()
    return b"".join([head, index, *(out[a:b].tobytes() for a, b in zip(first, place))])


def decode_segment(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError if a block's checksum differs."""
    if data[:4] != _MAGIC:
        raise ValueError("not a segment of coded ids")
    n_ids, block, bits = struct.unpack_from("<QII", data, 4)
    if not n_ids:
        return np.zeros(0, "<u4")
    lanes, last, steps = _lanes(n_ids, block)
    index = np.frombuffer(data, "<u4", 2 * lanes, 20).reshape(lanes, 2)
    words = np.frombuffer(data, "<u2", offset=20 + 8 * lanes)
    words = np.append(words, np.zeros(8, "<u2"))
    place = np.cumsum(index[:, 0], dtype=np.int64) - index[:, 0]
    code = np.zeros(lanes, _U)
    for _ in range(4):
        code = (code << _U(16)) | words[place].astype(_U)
        place += 1
    blocks = _Blocks(lanes, bits)
    columns = np.zeros((block, lanes), "<u4")

    def settle(k: int) -> None:
        for where, ready, _ in blocks.settled(k):
            here, taken = place[where], np.asarray(ready, _U)
            word = words.take(here, mode="clip").astype(_U)
            code[where] = (code[where] << (taken << _U(4))) | (word * taken)
            place[where] = here + ready

    def value(k: int, most: np.ndarray) -> np.ndarray:
        part = np.maximum(blocks.span[:k], _U(1))  # damaged data may empty it
        return np.minimum((code[:k] - blocks.low[:k]) // part, most)

    for t in range(steps):
        k = lanes if t < last else lanes - 1
        blocks.propose(k)
        low, span = blocks.low[:k], blocks.span[:k]
        span >>= _SCALE
        beyond = (code[:k] - low) >= span * blocks.ends[1:4].astype(_U)
        outcome = beyond[0].astype(np.int64)
        outcome += beyond[1]
        outcome += beyond[2]
        blocks.narrow(outcome)
        size = blocks.bits.take(outcome)
        upper = 0
        if bits > 16:
            settle(k)
            more = np.where(size > 16, size - _U(16) * (size > 16), _U(0))
            span >>= more
            upper = value(k, (_U(1) << more) - _U(1))
            low += span * upper
            size = size - more
            settle(k)
            upper = upper << _U(16)
        span >>= size
        extra = value(k, (_U(1) << size) - _U(1))
        low += span * extra
        settle(k)
        now = blocks.told(outcome, (extra + upper).astype(blocks.kind))
        columns[t, :k] = now
        blocks.learn(now, outcome)
    ids = np.ascontiguousarray(columns.T).reshape(-1)[:n_ids]
    for i in range(lanes):
        if zlib.crc32(ids[i * block : (i + 1) * block].tobytes()) != index[i, 1]:
            raise ValueError(f"block {i}: the checksum differs")
    return ids
