"""Adaptive context-mixing range coder for streams of 16-bit ids.

A stream is cut into blocks of ``BLOCK`` ids.  Each block starts from an empty
model, ends flushed and has a checksum, so blocks are read independently.  All
blocks of a call are coded side by side: step t handles id t of every block
with numpy, which is how a sequential coder runs fast here.

Ids go by their number in order of appearance in the block.  Three predictors
give each number a probability:

* order 0: its share of the block so far (exact counts);
* order 1 and order 2: the number that last followed the hash of the one or
  two ids before, with a confidence of 0 to 3.

A fourth says that the id is new.  The coder's probability of a number is the
weighted sum of all that predict it, so what several orders agree on adds up:

    p(x) = (w2 [x = p2] + w1 [x = p1] + w0 count(x) / t + wn [x is new]) / sum of w

in whole numbers throughout, hence alike on every machine.  The weights are
kept per context (both confidences, and whether the orders agree) and move by
1/2**RATE towards each predictor's share of the probability that the id really
got.  Cumulative sums run over numbers, and the masses of orders 1 and 2 lie
before the order-0 mass of their number, so a reader finds x by comparing with
at most two places and searching the order-0 sums (three levels of ``WIDTH``).

A new id follows by a fixed law that falls with the id (vocabularies number
their tokens by merge rank).

The arithmetic coder keeps 48 bits of low and range, sends 16-bit words and
shortens the range where a carry could arise, so no word sent ever changes.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 4096
SLOTS1, SLOTS2 = 2048, 4096
WIDTH = 16  # BLOCK = WIDTH**3 numbers
ROW = np.dtype("V32")  # WIDTH 16-bit counts, moved as one value
CONTEXTS = 32
WEIGHT, RATE = 1 << 14, 5  # sum of the weights, and how slowly they move
HALF = 1 << RATE - 1  # rounds; no weight falls below it
LEVEL, ONE = np.int16(3 << 12), np.int16(1 << 12)  # confidence in a slot
EMPTY = np.int16(1 << 14)  # of a slot without a number
MASK = (1 << 48) - 1
SHORT = 1 << 30  # least range; totals stay below 2**27
WORST = 6  # 16-bit words an id may take
#: what number j of a row adds to the sums before the others
_ADD = np.triu(np.ones((WIDTH, WIDTH), dtype=np.uint16), 1).view(ROW).ravel()
_NEW = np.concatenate([[0], np.cumsum((1 << 22) // (np.arange(1 << 16) + 512) + 1)]).astype(np.int64)


def _start_weights() -> np.ndarray:
    """Order 2, order 1, order 0, new; for every context."""
    two, one = np.divmod(np.arange(CONTEXTS) >> 1, 4)
    parts = np.stack([1 + 3 * two, 1 + 2 * one, np.full(CONTEXTS, 6), np.full(CONTEXTS, 4)])
    return parts * WEIGHT // parts.sum(axis=0)


class _Model:
    """State of all blocks.  ``high``, ``middle`` and ``low`` hold counts of the
    numbers before each: within the block by 256, within 256 by 16, within 16.
    Probabilities are whole numbers below 2**53 in float64, whose quotients cut
    down are exact; slots hold number | confidence << 12, and ``weights`` the
    four 16-bit weights of a context as one value."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes, dtype=np.int64)
        self.base = self.lane * BLOCK
        self.slot1, self.slot2, self.context = self.lane * SLOTS1, self.lane * SLOTS2, self.lane * CONTEXTS
        self.count = np.zeros(lanes * BLOCK, dtype=np.uint16)
        self.high = np.zeros((lanes, WIDTH), dtype=np.uint16)
        self.middle = np.zeros(lanes * WIDTH, dtype=ROW)
        self.low = np.zeros(lanes * WIDTH * WIDTH, dtype=ROW)
        self.levels = self.high.ravel(), self.middle.view(np.uint16), self.low.view(np.uint16)
        start = np.ascontiguousarray(_start_weights().T, dtype=np.int16).view(np.int64).ravel()
        self.weights = np.tile(start, lanes)
        self.first = np.full(lanes * SLOTS1, EMPTY, dtype=np.int16)
        self.second = np.full(lanes * SLOTS2, EMPTY, dtype=np.int16)
        self.one = np.zeros(lanes, dtype=np.int64)  # the number before
        self.two = np.zeros(lanes, dtype=np.int64)  # and the one before it

    def before(self, at) -> np.ndarray:
        """Ids so far with a smaller number; ``at`` is base + number."""
        high, middle, low = self.levels
        return high.take(at >> 8, mode="clip") + middle.take(at >> 4, mode="clip") + low.take(at, mode="clip")

    def predict(self, n: int, t: int) -> None:
        """What the orders expect as id t of the first n blocks."""
        one = self.one[:n]
        self.at1 = self.slot1[:n] + (one & SLOTS1 - 1)
        self.at2 = self.slot2[:n] + ((one * 30011 + self.two[:n] * 52391) >> 4 & SLOTS2 - 1)
        self.packed1, self.packed2 = self.first.take(self.at1, mode="clip"), self.second.take(self.at2, mode="clip")
        self.p1, self.p2 = self.packed1 & ~LEVEL, self.packed2 & ~LEVEL
        self.row = self.context[:n] + ((self.packed2 & LEVEL) >> 9 | (self.packed1 & LEVEL) >> 11 | (self.p1 == self.p2))
        packed = self.weights.take(self.row, mode="clip").view(np.int16).reshape(n, 4)
        self.w = np.array(packed.T, dtype=np.float64, order="C")
        scale = max(t, 1)
        self.mass2 = self.w[0] * scale * (self.p2 != EMPTY)
        self.mass1 = self.w[1] * scale * (self.p1 != EMPTY)
        self.mass_new = self.w[3] * scale
        self.total = self.w[2] * t + self.mass2 + self.mass1 + self.mass_new

    def interval(self, n: int, x, new) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of number x; the weights learn from it."""
        at, x = self.base[:n] + x, x.astype(np.int16)
        w0 = self.w[2]
        start = w0 * self.before(at) + self.mass1 * (self.p1 < x) + self.mass2 * (self.p2 < x)
        share = np.empty_like(self.w)
        np.multiply(self.mass2, self.p2 == x, out=share[0])
        np.multiply(self.mass1, self.p1 == x, out=share[1])
        np.multiply(w0, self.count.take(at, mode="clip"), out=share[2])
        np.multiply(self.mass_new, new, out=share[3])
        size = share[0] + share[1] + share[2] + share[3]
        share *= WEIGHT
        share /= size
        np.floor(share, out=share)
        share -= self.w
        share += HALF
        share *= 1 / (1 << RATE)
        np.floor(share, out=share)
        share += self.w
        packed = np.empty((n, 4), dtype=np.int16)
        packed.T[...] = share
        self.weights.put(self.row, packed.view(np.int64).ravel(), mode="clip")
        return start, size

    def find(self, n: int, value) -> tuple[np.ndarray, np.ndarray]:
        """The number whose interval holds the value, and which are new."""
        new = value >= self.total - self.mass_new
        p1, p2 = self.p1 & BLOCK - 1, self.p2 & BLOCK - 1  # 0 where empty
        base, w0 = self.base[:n], self.w[2]
        a, b = np.minimum(p1, p2), np.maximum(p1, p2)
        mass_a = np.where(p2 < p1, self.mass2, self.mass1)
        mass_b = self.mass1 + self.mass2 - mass_a
        start_a, start_b = w0 * self.before(base + a), w0 * self.before(base + b)
        past_a = value >= start_a + mass_a
        is_a = (value >= start_a) & ~past_a
        value = value - mass_a * past_a
        past_b = past_a & (value >= start_b + mass_b)
        is_b = past_a & (value >= start_b) & ~past_b
        # what exceeds the block belongs to new ids
        rest = np.minimum((value - mass_b * past_b) / w0, BLOCK - 1).astype(np.uint16)
        high, middle, _ = self.levels
        at = self.lane[:n] * WIDTH + _last(self.high[:n], rest)
        rest -= high.take(at, mode="clip")
        at2 = at * WIDTH + _last(_counts(self.middle.take(at, mode="clip")), rest)
        rest -= middle.take(at2, mode="clip")
        x = at2 * WIDTH + _last(_counts(self.low.take(at2, mode="clip")), rest) - base
        return np.where(is_a, a, np.where(is_b, b, x)), new

    def learn(self, n: int, x) -> None:
        at, number = self.base[:n] + x, x.astype(np.int16)
        for table, slot, packed, guess in ((self.first, self.at1, self.packed1, self.p1), (self.second, self.at2, self.packed2, self.p2)):
            # a miss lowers the confidence; without any the number takes the slot
            missed = np.where(packed & LEVEL, packed - ONE, number | ONE)
            table.put(slot, np.where(guess == number, np.minimum(packed + ONE, guess | LEVEL), missed), mode="clip")
        self.two[:n] = self.one[:n]
        self.one[:n] = x
        self.count.put(at, self.count.take(at, mode="clip") + np.uint16(1), mode="clip")
        high = self.high[:n]
        high += _counts(_ADD.take(x >> 8, mode="clip"))
        for table, place in ((self.middle, at >> 4), (self.low, at)):
            row = place >> 4
            rows = table.take(row, mode="clip")
            counts = _counts(rows)
            counts += _counts(_ADD.take(place & WIDTH - 1, mode="clip"))
            table.put(row, rows, mode="clip")


def _counts(rows: np.ndarray) -> np.ndarray:
    return rows.view(np.uint16).reshape(-1, WIDTH)


def _last(rows: np.ndarray, value: np.ndarray) -> np.ndarray:
    """In each row of rising counts, which start at 0, the place of the last not above the value."""
    below = np.bitwise_count((rows <= value[:, None]).view(np.uint64))
    return below[:, 0].astype(np.int64) + below[:, 1] - 1


def _numbers(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ids (blocks, BLOCK): the number of each in order of appearance in
    its block, and whether it is there for the first time."""
    order = np.argsort(grid, axis=1, kind="stable")
    ranked = np.take_along_axis(grid, order, axis=1)
    head = np.ones(grid.shape, dtype=bool)
    head[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
    new = np.zeros(grid.shape, dtype=bool)
    np.put_along_axis(new, order, head, axis=1)
    seen = np.cumsum(new, axis=1, dtype=np.int32) - 1
    # equal ids are neighbours in the order, the earliest place first
    own = np.take_along_axis(seen, order, axis=1)[head][np.cumsum(head.ravel()) - 1]
    number = np.empty(grid.shape, dtype=np.uint16)
    np.put_along_axis(number, order, own.reshape(grid.shape).astype(np.uint16), axis=1)
    return number, new


class _Coder:
    """48-bit low and range of all blocks; ``lane`` is a slice or places of them."""

    def __init__(self, lanes: int):
        self.low, self.span = np.zeros(lanes, dtype=np.int64), np.full(lanes, MASK, dtype=np.int64)

    def _narrow(self, lane, lo, sp, move) -> None:
        """Take the new low and range; ``move`` handles a word of some lanes."""
        w = np.flatnonzero(((lo ^ (lo + sp)) < (1 << 32)) | (sp < SHORT))
        while len(w):
            low, span = lo[w], sp[w]
            cut = (low ^ (low + span)) >= (1 << 32)
            span = np.where(cut, -low & (SHORT - 1), span) << 16
            move(w, lo)
            low = (low << 16) & MASK
            lo[w], sp[w] = low, span
            w = w[((low ^ (low + span)) < (1 << 32)) | (span < SHORT)]
        self.low[lane], self.span[lane] = lo, sp


class _Writer(_Coder):
    def __init__(self, lanes: int):
        super().__init__(lanes)
        room = WORST * BLOCK + 4
        self.out = np.zeros(lanes * room, dtype=np.uint16)
        self.begin = np.arange(lanes, dtype=np.int64) * room
        self.at = self.begin.copy()

    def put(self, lane, start, size, total) -> None:
        r = np.floor(self.span[lane] / total)

        def move(w, lo):
            target = w if isinstance(lane, slice) else lane[w]
            at = self.at[target]
            self.out[at] = lo[w] >> 32
            self.at[target] = at + 1

        self._narrow(lane, self.low[lane] + (r * start).astype(np.int64), (r * size).astype(np.int64), move)

    def finish(self) -> None:
        for shift in (32, 16, 0):
            self.out[self.at] = (self.low >> shift) & 0xFFFF
            self.at += 1


class _Reader(_Coder):
    def __init__(self, blocks: list[bytes]):
        super().__init__(len(blocks))
        self.words = np.frombuffer(b"".join(b + b"\0" * 16 for b in blocks), "<u2").astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum([len(b) // 2 + 8 for b in blocks])[:-1]]).astype(np.int64)
        self.code = (self.words[self.at] << 32) | (self.words[self.at + 1] << 16) | self.words[self.at + 2]
        self.at += 3

    def value(self, lane, total) -> np.ndarray:
        """Where in the total the code lies; ``take`` follows for the same blocks."""
        self.r = np.floor(self.span[lane] / total)
        return np.clip(np.floor((self.code[lane] - self.low[lane]) / self.r), 0, total - 1)  # in bounds even in damaged blocks

    def take(self, lane, start, size) -> None:
        code = self.code[lane]  # a view for a slice

        def move(w, lo):
            source = w if isinstance(lane, slice) else lane[w]
            at = self.at[source]
            code[w] = ((code[w] << 16) & MASK) | self.words.take(at, mode="clip")
            self.at[source] = at + 1

        self._narrow(lane, self.low[lane] + (self.r * start).astype(np.int64), (self.r * size).astype(np.int64), move)
        self.code[lane] = code


def encode(ids: np.ndarray) -> list[tuple[bytes, int, int]]:
    """(bytes, crc32, ids) of each block."""
    ids = np.ascontiguousarray(ids, dtype=np.uint16)
    lanes = -(-len(ids) // BLOCK)
    if not lanes:
        return []
    grid = np.zeros(lanes * BLOCK, dtype=np.uint16)
    grid[: len(ids)] = ids
    grid = grid.reshape(lanes, BLOCK)
    number, new = np.empty((BLOCK, lanes), dtype=np.uint16), np.empty((BLOCK, lanes), dtype=bool)
    for k in range(0, lanes, 64):
        some, first = _numbers(grid[k : k + 64])
        number[:, k : k + 64], new[:, k : k + 64] = some.T, first.T
    grid = np.ascontiguousarray(grid.T)
    tail = len(ids) - (lanes - 1) * BLOCK
    model, writer = _Model(lanes), _Writer(lanes)
    for t in range(BLOCK if lanes > 1 else tail):
        n = lanes if t < tail else lanes - 1
        x = number[t, :n].astype(np.int64)
        model.predict(n, t)
        writer.put(slice(n), *model.interval(n, x, new[t, :n]), model.total)
        fresh = np.flatnonzero(new[t, :n])
        if len(fresh):
            own = grid[t, fresh].astype(np.int64)
            writer.put(fresh, _NEW[own], _NEW[own + 1] - _NEW[own], _NEW[-1])
        model.learn(n, x)
    writer.finish()
    raw = ids.astype("<u2").tobytes()
    result = []
    for i in range(lanes):
        own = raw[2 * i * BLOCK : 2 * (i + 1) * BLOCK]
        result.append((writer.out[writer.begin[i] : writer.at[i]].astype("<u2").tobytes(), zlib.crc32(own), len(own) // 2))
    return result


def decode(blocks: list[tuple[bytes, int, int]]) -> list[np.ndarray]:
    """Ids of each block; raises if a checksum does not hold.  The blocks may
    come from several streams and have any lengths up to ``BLOCK``."""
    if not blocks:
        return []
    if max(size for _, _, size in blocks) > BLOCK:
        raise ValueError("a block is longer than any that is written")
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][2])  # longest first
    sizes = np.array([blocks[i][2] for i in order], dtype=np.int64)
    lanes = len(blocks)
    reader, model = _Reader([blocks[i][0] for i in order]), _Model(lanes)
    grid = np.zeros((int(sizes[0]), lanes), dtype=np.uint16)
    met_ids = np.zeros(lanes * BLOCK, dtype=np.uint16)  # ids by their number
    n_met = np.zeros(lanes, dtype=np.int64)
    n = lanes
    for t in range(int(sizes[0])):
        while sizes[n - 1] <= t:
            n -= 1
        lane = model.lane[:n]
        model.predict(n, t)
        x, new = model.find(n, reader.value(slice(n), model.total))
        # a damaged block may name a number that is not met yet
        new |= x >= n_met[:n]
        fresh = np.flatnonzero(new)
        x[fresh] = n_met[fresh]
        reader.take(slice(n), *model.interval(n, x, new))
        if len(fresh):
            own = np.searchsorted(_NEW, reader.value(fresh, _NEW[-1]).astype(np.int64), side="right") - 1
            reader.take(fresh, _NEW[own], _NEW[own + 1] - _NEW[own])
            met_ids[fresh * BLOCK + n_met[fresh]] = own
            n_met[fresh] += 1
        grid[t, :n] = met_ids[lane * BLOCK + x]
        model.learn(n, x)
    result: list[np.ndarray] = [np.zeros(0, np.uint16)] * lanes
    columns = np.ascontiguousarray(grid.T)
    for k, i in enumerate(order):
        ids = columns[k, : sizes[k]]
        if zlib.crc32(ids.astype("<u2").tobytes()) != blocks[i][1]:
            raise ValueError(f"block {i}: the checksum does not hold")
        result[i] = ids
    return result
