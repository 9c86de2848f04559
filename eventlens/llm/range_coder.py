"""Adaptive context-mixing range coder for token ids.

A block is coded on its own: model, coder and checksum start anew, so any
block can be read, or found broken, without the others.  Its ids are laid out
as lanes, contiguous runs that are coded side by side in one numpy step, each
with its own range coder; the model is shared by the block's lanes and learns
from all of them after each step.

The prediction for the next id mixes three models:

- order 0: adaptive counts over the whole vocabulary;
- order 1 and 2: for the last one or two ids, the id that followed most, with
  a count of its lead.

The weights of the three are learned per confidence class (the counts of order
2 and 1) from how often each order held the id that came.  Orders that name
the same id add their shares; what is left goes to order 0, so every id can be
coded.  All arithmetic is on integers: the decoder
repeats it exactly.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids per block, lanes per block, and the shortest lane worth having.
BLOCK, LANES, LANE_IDS = 1 << 19, 4096, 64
MAGIC = b"CMX1"
HEADER = struct.Struct("<4sIIIII")  # magic, ids, vocabulary, lanes, words, crc32 of the ids
_TOTAL_BITS = 30
_TOTAL = 1 << _TOTAL_BITS
_STEP0 = 24  # order-0 count of one id seen
_REFRESH = 4  # steps between two order-0 tables
_ONE = np.uint64(1)
_U16, _U30, _U48 = np.uint64(16), np.uint64(_TOTAL_BITS), np.uint64(48)
#: A slot is id << 5 | count; counts have confidence levels.
_MAX_COUNT = 31
_LEVELS = 8
_LEVEL = np.searchsorted([1, 2, 3, 5, 8, 13, 24], np.arange(32), side="right")


#: The pair of levels of a pair of counts, order 2 first.
_KIND = (_LEVEL[:, None] * _LEVELS + _LEVEL).reshape(-1)
#: Who held the id: order 2, 1 or 0, if none did, order 2 alone, order 1 alone, both.
_HELD = np.array([[0, 1, 0, 1], [0, 0, 1, 1], [1, 0, 0, 0]])
#: Buckets of counts by which order 0 finds an id.
_BUCKET_BITS = 14


def _mask(hit: np.ndarray) -> np.ndarray:
    """-1 and 0 for true and false.  Which lanes hit cannot be foretold, so
    branches on them cost more than arithmetic on all."""
    return -hit.astype(np.int32)


def _choose(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return b ^ ((a ^ b) & mask)


class _Slots:
    """The leading id and its count for each hashed context of one order."""

    def __init__(self, bits: int):
        self.table = np.zeros(1 << bits, np.int32)

    def read(self, context: np.ndarray) -> None:
        """Looks the contexts up; one never seen has the count 0."""
        self.row, self.entry = context, self.table.take(context)
        self.id, self.count = self.entry >> 5, self.entry & 31

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """The first contexts saw ``ids``; those of ``hit`` (-1, others 0)
        named them.  Lanes that share a context overwrite each other in lane
        order."""
        n = len(ids)
        entry, count = self.entry[:n], self.count[:n]
        now = _choose(_mask(count <= 1), ids << 5 | 1, entry - (count >> 2) - 1)
        self.table[self.row[:n]] = _choose(hit, entry + (count < _MAX_COUNT), now)


class _Model:
    def __init__(self, n: int, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.bits2 = max(8, min(18, int(n).bit_length()))
        self.bits1 = max(8, min(16, int(n).bit_length()))
        self.order2, self.order1 = _Slots(self.bits2), _Slots(self.bits1)
        self.counts0 = np.ones(vocabulary, np.uint32)
        self.cum0 = np.arange(vocabulary + 1, dtype=np.uint32)
        self.total0, self.buckets = vocabulary, None
        self.weights = np.tile(np.array([[4], [4], [8]], np.int64), _LEVELS * _LEVELS)  # order 2, 1, 0
        self.last, self.before = (np.full(lanes, vocabulary, np.uint32) for _ in range(2))
        self.steps = 0

    def predict(self) -> None:
        """The ends of the intervals of order 2's and order 1's id; order 0
        has the rest."""
        u = np.uint32
        context1 = (self.last if self.bits1 == 16 else (self.last.astype(np.int64) * 40503 >> 3)) & ((1 << self.bits1) - 1)
        # of the products only bits below 32 count
        context2 = ((self.last * u(0x9E3779B1) + self.before * u(0x85EBCA77)) >> u(7)) & u((1 << self.bits2) - 1)
        two, one = self.order2, self.order1
        two.read(context2.astype(np.intp))
        one.read(context1.astype(np.intp))
        self.kind = _KIND.take((two.count << 5 | one.count).astype(np.intp))
        w = self.weights.copy()
        w[0, :_LEVELS] = 0  # contexts never seen name no id
        w[1, ::_LEVELS] = 0
        part2, part1 = ((_TOTAL - _TOTAL // 64) * w[:2] // w.sum(axis=0)).astype(np.int32)
        self.end2, mass1 = part2.take(self.kind), part1.take(self.kind)
        self.end1 = self.end2 + mass1
        # the same id in both orders: one interval
        self.end2 = _choose(_mask((two.id == one.id) & (two.count > 0)), self.end1, self.end2)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks of the lanes whose ids order 2 and order 1 name."""
        two, one = self.order2, self.order1
        return _mask((two.id == ids) & (two.count > 0)), _mask((one.id == ids) & (one.count > 0))

    def _order0(self, ids: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest, total = (_TOTAL - used).astype(np.uint64), np.uint64(self.total0)
        # division of unsigned arrays by one number needs no hardware division
        at = ids.astype(np.intp)
        first = (self.cum0.take(at) * rest // total).astype(np.int32)
        at += 1
        return first + used, (self.cum0.take(at) * rest // total).astype(np.int32) - first

    def interval(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the lanes' ids."""
        start, width = self._order0(ids, self.end1)
        start, width = _choose(hit1, self.end2, start), _choose(hit1, self.end1 - self.end2, width)
        return (start & ~hit2).astype(np.uint64), _choose(hit2, self.end2, width).astype(np.uint64)

    def _id0(self, v: np.ndarray) -> np.ndarray:
        """The ids whose shares of order 0 hold the counts ``v``."""
        if self.buckets is None:
            self.shift = np.uint32(max(0, self.total0.bit_length() - _BUCKET_BITS))
            bucket = self.cum0 >> self.shift
            ends = np.flatnonzero(bucket[1:] != bucket[:-1])  # ids that reach into a later bucket
            first = np.repeat(ends, bucket[ends + 1] - bucket[ends])  # of the second bucket and so on
            self.buckets = np.concatenate([[0], first, [self.vocabulary]]).astype(np.int32)
        bucket = (v >> self.shift).astype(np.intp)
        found = self.buckets.take(bucket)
        bucket += 1
        several = np.flatnonzero(found != self.buckets.take(bucket))
        # in order of counts, as a search close to the last one is faster
        sought = v.take(several).astype(np.uint64) << np.uint64(32) | several.view(np.uint64)
        sought.sort()
        found[(sought & np.uint64(0xFFFFFFFF)).view(np.int64)] = np.searchsorted(self.cum0, (sought >> np.uint64(32)).astype(np.uint32), side="right") - 1
        return found

    def find(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold the points ``at``, their starts and widths."""
        rest = (_TOTAL - self.end1).astype(np.uint64)
        v = ((np.maximum(at - self.end1, 0) + 1).astype(np.uint64) * np.uint64(self.total0) - _ONE) // rest
        ids = self._id0(v.astype(np.uint32))
        start, width = self._order0(ids, self.end1)
        two, one = _mask(at < self.end2), _mask(at < self.end1)
        ids = _choose(two, self.order2.id, _choose(one, self.order1.id, ids))
        start, width = _choose(one, self.end2, start), _choose(one, self.end1 - self.end2, width)
        return ids, (start & ~two).astype(np.uint64), _choose(two, self.end2, width).astype(np.uint64)

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, n: int) -> None:
        """The first ``n`` lanes saw ``ids``, which order 2 and 1 named or not."""
        ids, hit2, hit1 = ids[:n], hit2[:n], hit1[:n]
        self.order2.learn(ids, hit2)
        self.order1.learn(ids, hit1)
        seen = np.bincount((self.kind[:n] << 2) - (hit2 + 2 * hit1), minlength=4 * _LEVELS * _LEVELS)
        self.weights += _HELD @ seen.reshape(-1, 4).T
        np.add.at(self.counts0, ids.astype(np.intp), np.uint32(_STEP0))
        self.before[:n], self.last[:n] = self.last[:n], ids
        self.steps += 1
        if self.steps % _REFRESH == 0:
            np.cumsum(self.counts0, dtype=np.uint32, out=self.cum0[1:])
            self.total0, self.buckets = int(self.cum0[-1]), None


def _layout(n: int) -> tuple[int, int, np.ndarray]:
    """Lanes, steps and the lanes' first positions; the first lanes may be
    one id longer than the others."""
    lanes = max(1, min(LANES, n // LANE_IDS))
    short, longer = divmod(n, lanes)
    lane = np.arange(lanes)
    return lanes, short + (longer > 0), lane * short + np.minimum(lane, longer)


def _active(n: int, lanes: int, step: int) -> int:
    short, longer = divmod(n, lanes)
    return lanes if step < short else longer


def _held(n: int, steps: int, first: np.ndarray) -> np.ndarray:
    """Which steps of the lanes hold an id."""
    return np.arange(steps) < np.diff(first, append=n)[:, None]


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """One block of at most BLOCK ids below ``vocabulary``."""
    n = len(ids)
    ids = np.ascontiguousarray(ids, dtype=np.int32)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    if not n:
        return HEADER.pack(MAGIC, 0, vocabulary, 0, 0, crc)
    lanes, steps, first = _layout(n)
    model = _Model(n, vocabulary, lanes)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, ~np.uint64(0))
    row = 2 * steps + 4
    lane = np.arange(lanes)
    words, at = np.zeros(lanes * row, np.uint32), lane * row + 1  # word 0 of a lane takes a last carry
    grid = np.zeros((lanes, steps), np.int32)
    grid[_held(n, steps, first)] = ids
    grid = np.ascontiguousarray(grid.T)
    for step, now in enumerate(grid):
        active = _active(n, lanes, step)
        model.predict()
        hit2, hit1 = model.hits(now)
        start, part = model.interval(now, hit2, hit1)
        r = width >> _U30
        new = low + r * start
        over = np.flatnonzero((new < low)[:active])
        if len(over):
            words[at.take(over) - 1] += 1
        low[:active], width[:active] = new[:active], (r * part)[:active]
        # the first word is written in any case and stays where the lane goes on
        words[at] = low >> _U48
        on = width < _ONE << _U48
        on[active:] = False
        at += on
        shift = on.astype(np.uint64) << np.uint64(4)
        low <<= shift
        width <<= shift
        small = np.flatnonzero(width[:active] < _ONE << _U48)
        while len(small):
            here, out = at.take(small), low.take(small)
            words[here] = out >> _U48
            at[small], low[small] = here + 1, out << _U16
            width[small] = wide = width.take(small) << _U16
            small = small.take(np.flatnonzero(wide < _ONE << _U48))
        model.learn(now, hit2, hit1, active)
    words, at = words.reshape(lanes, row), at - lane * row
    last = low + ((_ONE << _U48) - _ONE)  # the shortest word inside the interval
    words[lane, at - 1] += (last < low).astype(np.uint32)
    words[lane, at] = (last >> _U48).astype(np.uint32)
    at += 1
    while (words > 0xFFFF).any():
        carry = words >> 16
        words &= 0xFFFF
        words[:, :-1] += carry[:, 1:]
    used = np.arange(words.shape[1]) < at[:, None]
    used[:, 0] = False
    payload = words[used].astype("<u2")
    return HEADER.pack(MAGIC, n, vocabulary, lanes, len(payload), crc) + (at - 1).astype("<u2").tobytes() + payload.tobytes()


def block_length(header: bytes) -> int:
    """Bytes of a block, from its header."""
    magic, _, _, lanes, words, _ = HEADER.unpack(header)
    if magic != MAGIC:
        raise ValueError("not a block")
    return HEADER.size + 2 * lanes + 2 * words


def decode_block(raw: bytes) -> np.ndarray:
    """The ids of one block (uint32); raises if the checksum does not hold."""
    magic, n, vocabulary, lanes, n_words, crc = HEADER.unpack_from(raw)
    if magic != MAGIC or len(raw) != block_length(raw[: HEADER.size]):
        raise ValueError("not a block")
    out = np.zeros(n, "<u4")
    if n:
        if lanes != _layout(n)[0]:
            raise ValueError("broken block")
        _, steps, first = _layout(n)
        counts = np.frombuffer(raw, "<u2", lanes, HEADER.size).astype(np.int64)
        if counts.sum() != n_words:
            raise ValueError("broken block")
        if counts.max() > 2 * steps + 4:
            raise ValueError("broken block")
        # a lane reads three words past its own: zeros
        row, lane = int(counts.max()) + 4, np.arange(lanes)
        words = np.zeros((lanes, row), np.uint64)
        words[np.arange(row) < counts[:, None]] = np.frombuffer(raw, "<u2", n_words, HEADER.size + 2 * lanes)
        words, at = words.reshape(-1), lane * row
        value = np.zeros(lanes, np.uint64)
        for _ in range(4):
            value = (value << _U16) | words.take(at)
            at += 1
        width = np.full(lanes, ~np.uint64(0))
        model, grid = _Model(n, vocabulary, lanes), np.zeros((steps, lanes), "<u4")
        for step in range(steps):
            active = _active(n, lanes, step)
            model.predict()
            r = width >> _U30
            point = np.minimum(value // np.maximum(r, _ONE), np.uint64(_TOTAL - 1)).astype(np.int32)
            now, start, part = model.find(point)
            value[:active] -= (r * start)[:active]
            width[:active] = (r * part)[:active]
            grid[step] = now
            on = width < _ONE << _U48
            on[active:] = False
            shift = on.astype(np.uint64) << np.uint64(4)
            value = (value << shift) | words.take(at, mode="clip") * on
            at += on
            width <<= shift
            small = np.flatnonzero(width[:active] < _ONE << _U48)
            while len(small):
                here = at.take(small)
                value[small] = (value.take(small) << _U16) | words.take(here, mode="clip")
                at[small] = here + 1
                width[small] = wide = width.take(small) << _U16
                small = small.take(np.flatnonzero(wide < _ONE << _U48))
            model.learn(now, *model.hits(now), active)
        out = grid.T[_held(n, steps, first)]
    if zlib.crc32(out.tobytes()) != crc:
        raise ValueError("block checksum differs")
    return out
