"""Adaptive context-mixing range coder for token ids, many blocks in step.

A block is coded on its own, from a model that starts empty. The model has three predictions for an id: the id
that last followed the two ids before (order 2), the one that last followed the id before (order 1), and the frequencies of ids
(order 0). They are mixed: where order 2 predicts, it gets the share of the range that its predictions deserved lately, order 1 its
share of what is left likewise, ids not yet counted a share of the rest by how often such ids came lately, and order 0 has the remainder.
Predictions, frequencies and shares are learnt anew whenever the number of ids has doubled, from the ids of the block so far. A
range coder with 64 bits of range codes each id's place in the mixture in one step.

All blocks of a group advance together, as arrays with an element for each block: between two lessons the encoder works out the
mixture for all ids at once, and the decoder goes id by id.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Ids in a block.
BLOCK = 2048
#: Ids are below; a slot that holds it predicts nothing.
NOTHING = (1 << 16) - 1
SLOTS1, SLOTS2 = 1 << 9, 1 << 10
SHARE = 12  # bits of a share
WHOLE = 1 << SHARE
TOTAL = 24  # bits of the mixture's total
#: Of the total for each unit of a share; what is over makes sure that any id can be coded.
WIDTH = WHOLE - 32
LEAST, MOST = 32, WHOLE - 64  # the ends of shares
UNIT = np.uint64(TOTAL)
LOW = np.uint64(1 << 32)
DIGIT = np.uint64(32)
DIGIT_MASK = np.uint64((1 << 32) - 1)
FIRST = 32  # ids before the first lesson
#: Ids of each block that the encoder works out at once.
STRIDE = 32


def _lessons(steps: int) -> list[tuple[int, int]]:
    """From where to where each lesson holds: 0 to 32, 32 to 64, 64 to 128 and so on."""
    ends = [0, FIRST]
    while ends[-1] < steps:
        ends.append(2 * ends[-1])
    return [(a, min(b, steps)) for a, b in zip(ends, ends[1:], strict=False) if a < steps]


class Model:
    """What all blocks know; ``seen`` holds their ids by step, after two rows of zeros."""

    def __init__(self, blocks: int):
        self.lane = np.arange(blocks, dtype=np.int32)
        self.counted = 0
        self.table1 = np.full(blocks * SLOTS1, NOTHING, np.uint16)  # the predicted id
        self.table2 = np.full(blocks * SLOTS2, NOTHING, np.uint16)
        self.deserved1 = self.deserved2 = np.full(blocks, WHOLE // 4, np.int32)
        self.old = np.full(blocks, WHOLE // 2, np.int32)  # the share of counted ids among those that no context predicts
        self.ordered = np.zeros((blocks, 0), np.uint16)

    def _slots(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the tables for the id before and the one before that."""
        return ((two * 73 + one & SLOTS2 - 1) + self.lane * SLOTS2), ((one & SLOTS1 - 1) + self.lane * SLOTS1)

    def learn(self, seen: np.ndarray, count: int) -> None:
        """The lesson after ``count`` ids; the shares are those that the ids since the last one would have deserved."""
        fresh = seen[2 + self.counted:2 + count]
        at2, at1 = self._slots(seen[1 + self.counted:1 + count], seen[self.counted:count])
        ordered = np.sort(np.ascontiguousarray(seen[2:2 + count].T.astype(np.uint16)), axis=1, kind="stable")
        kinds = 1 + (ordered[:, 1:] != ordered[:, :-1]).sum(1)
        if self.counted:
            found2, found1 = self.table2.take(at2), self.table1.take(at1)
            right2, tried2 = found2 == fresh, found2 != NOTHING
            tried1 = ~right2 & (found1 != NOTHING)
            right1 = tried1 & (found1 == fresh)

            def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
                return np.clip((2 * part + 1) * WHOLE // (2 * whole + 2), LEAST, MOST).astype(np.int32)
            self.deserved2 = share(right2.sum(0), tried2.sum(0))
            self.deserved1 = share(right1.sum(0), tried1.sum(0))
            rest = len(fresh) - (right2 | right1).sum(0)
            self.old = share(np.maximum(rest - (kinds - self.kinds), 0), rest)
        self.table2[at2] = fresh  # of repeated places the last stays
        self.table1[at1] = fresh
        self.counted, self.ordered, self.kinds = count, ordered, kinds

    def mix(self, one: np.ndarray, two: np.ndarray) -> None:
        """The mixture after these ids: where the parts of order 2, 1 and 0 end, and the width of an id in those of order 0 and of the rest."""
        at2, at1 = self._slots(one, two)
        self.id2, self.id1 = self.table2.take(at2), self.table1.take(at1)
        share2 = (self.id2 != NOTHING) * self.deserved2
        self.part1 = (WHOLE - share2) * ((self.id1 != NOTHING) * self.deserved1) >> SHARE
        first = share2 + self.part1
        self.part0 = (WHOLE - first) * self.old >> SHARE if self.counted else np.zeros_like(first)
        self.share2 = share2
        self.end2, self.end1 = share2 * WIDTH, first * WIDTH
        self.end0 = (first + self.part0) * WIDTH
        self.unit0 = self.part0 * WIDTH >> max(self.counted, 1).bit_length() - 1
        self.unit = (1 << TOTAL) - self.end0 >> 16


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each element of ascending rows, the place where its value begins, and how often it occurs."""
    rows, n = ordered.shape
    flat = ordered.ravel()
    head = np.r_[True, flat[1:] != flat[:-1]]
    head[::n] = True
    heads = np.flatnonzero(head)
    sizes = np.diff(np.r_[heads, rows * n])
    return np.repeat(heads % n, sizes).reshape(rows, n), np.repeat(sizes, sizes).reshape(rows, n)


def _places(ordered: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For ids by step and block, where they begin among the counted ones, and above that, by 16 bits, how many there are.

    A few blocks at a time lay out their counted ids by value and read off the wanted ones.
    """
    first, known = _runs(ordered)
    entries = (first + (known << 16)).astype(np.int32)
    wanted = np.ascontiguousarray(wanted.T)
    found = np.empty(wanted.shape, np.int32)
    few = 16
    by_value = np.zeros(few << 16, np.int32)
    origin = np.arange(few, dtype=np.int32)[:, None] << 16
    for a in range(0, len(ordered), few):
        b = min(a + few, len(ordered))
        cells = ordered[a:b] + origin[:b - a]
        by_value[cells] = entries[a:b]
        found[a:b] = by_value.take(wanted[a:b] + origin[:b - a])
        by_value[cells] = 0
    return np.ascontiguousarray(found.T)


def encode(ids: np.ndarray) -> list[bytes]:
    """The blocks of ``ids`` (below 65,535), each with its number of ids and its checksum in front."""
    if ids.max(initial=0) >= NOTHING or ids.min(initial=0) < 0:
        raise ValueError("ids must be below 65,535")
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return []
    steps = min(BLOCK, len(ids))
    held = np.zeros((blocks, steps), np.int32)
    held.ravel()[:len(ids)] = ids
    lengths = np.minimum(BLOCK, len(ids) - BLOCK * np.arange(blocks))  # all but the last are full
    seen = np.zeros((steps + 2, blocks), np.int32)
    seen[2:] = held.T
    model = Model(blocks)
    low, span = np.zeros(blocks, np.uint64), np.full(blocks, 0xFFFFFFFFFFFFFFFF, np.uint64)
    width = steps + 2
    digits = np.zeros(blocks * width, np.uint64)  # of 32 bits, with carries
    filled = np.arange(blocks) * width
    for begin, end in _lessons(steps):
        if begin:
            model.learn(seen, begin)
            places = _places(model.ordered, seen[2 + begin:2 + end])
        for a in range(begin, end, STRIDE):
            b = min(a + STRIDE, end)
            x = seen[2 + a:2 + b]
            model.mix(seen[1 + a:1 + b], seen[a:b])
            start, size = model.end0 + x * model.unit, model.unit.copy()
            if begin:
                known = places[a - begin:b - begin] >> 16
                has = (known > 0) & (model.part0 > 0)
                np.copyto(start, model.end1 + (places[a - begin:b - begin] & 0xFFFF) * model.unit0, where=has)
                np.copyto(size, known * model.unit0, where=has)
                in1 = (x == model.id1) & (model.part1 > 0)
                np.copyto(start, model.end2, where=in1)
                np.copyto(size, model.end1 - model.end2, where=in1)
                in2 = (x == model.id2) & (model.share2 > 0)
                np.copyto(start, 0, where=in2)
                np.copyto(size, model.end2, where=in2)
            start, size = start.astype(np.uint64), size.astype(np.uint64)
            for step in range(a, b):
                if step == lengths[-1]:  # what the last block has written stays as it is
                    last = int(low[-1]), digits[(blocks - 1) * width:filled[-1]].copy()
                unit = span >> UNIT
                moved = low + unit * start[step - a]
                span = unit * size[step - a]
                over = np.flatnonzero(moved < low)
                if len(over):
                    digits[filled[over] - 1] += np.uint64(1)
                low = moved
                small = np.flatnonzero(span < LOW)
                if len(small):
                    digits[filled[small]] = low[small] >> DIGIT
                    filled[small] += 1
                    low[small] <<= DIGIT
                    span[small] <<= DIGIT
    out = []
    for b in range(blocks):
        rest, column = int(low[b]), digits[b * width:filled[b]]
        if lengths[b] < steps:
            rest, column = last
        column = np.r_[column, np.array([rest >> 32, rest & 0xFFFFFFFF], np.uint64)]
        while len(over := np.flatnonzero(column >> DIGIT)):
            column &= DIGIT_MASK
            column[over - 1] += np.uint64(1)
        check = zlib.crc32(held[b, :lengths[b]].astype("<u4").tobytes())
        out.append(int(lengths[b]).to_bytes(4, "little") + check.to_bytes(4, "little") + column.astype("<u4").tobytes())
    return out


def decode(blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks, one after another; raises ValueError if a block does not give what its checksum says."""
    if not blocks:
        return np.zeros(0, np.int64)
    lengths = np.array([int.from_bytes(b[:4], "little") for b in blocks])
    n, steps = len(blocks), int(lengths.max())
    bodies = [np.frombuffer(b, "<u4", offset=8) for b in blocks]
    width = max(map(len, bodies)) + 2
    digits = np.zeros((n, width), np.uint64)
    for b, body in enumerate(bodies):
        digits[b, :len(body)] = body
    code = digits[:, 0] << DIGIT | digits[:, 1]
    digits = digits.ravel()
    model = Model(n)
    span, ahead = np.full(n, 0xFFFFFFFFFFFFFFFF, np.uint64), np.arange(n) * width + 2
    last_digit = (np.arange(n) + 1) * width - 1  # a zero, for blocks that go on beyond their end
    seen = np.zeros((steps + 2, n), np.int32)
    for begin, end in _lessons(steps):
        if begin:
            model.learn(seen, begin)
            first, known = _runs(model.ordered)
            table = (first + (known << 16)).astype(np.int32).ravel()
            ordered = model.ordered.astype(np.int32).ravel()
            origin = model.lane * begin
        for step in range(begin, end):
            model.mix(seen[step + 1], seen[step])
            unit = span >> UNIT
            place = (code // unit).astype(np.int32)
            x = (place - model.end0) // model.unit
            start, size = model.end0 + x * model.unit, model.unit.copy()
            if begin:
                has = place < model.end0
                at = origin + (place - model.end1) // np.maximum(model.unit0, 1)
                entry = table.take(at, mode="clip")
                np.copyto(x, ordered.take(at, mode="clip"), where=has)
                np.copyto(start, model.end1 + (entry & 0xFFFF) * model.unit0, where=has)
                np.copyto(size, (entry >> 16) * model.unit0, where=has)
                in1, in2 = place < model.end1, place < model.end2
                np.copyto(x, model.id1, where=in1)
                np.copyto(start, model.end2, where=in1)
                np.copyto(size, model.end1 - model.end2, where=in1)
                np.copyto(x, model.id2, where=in2)
                np.copyto(start, 0, where=in2)
                np.copyto(size, model.end2, where=in2)
            np.bitwise_and(x, 0xFFFF, out=seen[step + 2])  # only ended or damaged blocks go beyond
            code = code - unit * start.astype(np.uint64)
            span = unit * size.astype(np.uint64)
            small = np.flatnonzero(span < LOW)
            if len(small):
                at = ahead[small]
                code[small] = code[small] << DIGIT | digits[at]
                ahead[small] = np.minimum(at + 1, last_digit[small])
                span[small] = np.maximum(span[small] << DIGIT, LOW)
    held = np.ascontiguousarray(seen[2:].T)
    found = [held[b, :lengths[b]] for b in range(n)]
    for block, ids in zip(blocks, found, strict=True):
        if zlib.crc32(ids.astype("<u4").tobytes()) != int.from_bytes(block[4:8], "little"):
            raise ValueError("a block does not give what its checksum says")
    return np.concatenate(found).astype(np.int64)
