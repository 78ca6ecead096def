"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks; every block starts with a reset model and can be decoded alone, given
the order-0 classes that its record keeps.  Blocks advance together as lanes of numpy arrays:
one step codes one id of each lane.

An id is coded in one three-way decision and, if need be, one more.  The order-2
context (two ids before) and the order-1 context (one before) each predict an id, with a
confidence.  The probability that the order-2 prediction holds is mixed in the logistic
domain from what the order-2 confidence, the order-1 confidence and the block so far say
(order 0), with weights learnt on the way.  The order-1 prediction, if it is another id, has
an adaptive probability of its own.  What neither predicts is coded by the order-0
frequencies of the record, of which each id's class (a quarter of a power of two) is kept
once a record: one table look-up an id instead of four adaptive digits.  All arithmetic is in
integers, so any machine decodes what another has written; the one quotient taken in double
precision is exact, as both sides lie below 2^48 and the result below 2^20.
"""

from __future__ import annotations

import numpy as np

LANES = 2048
SLOTS = 1 << 11
IDS = 1 << 16
_KNOWN = 12  # bits of the first decision's frequencies
_PLAIN = 20  # bits of the order-0 frequencies
_WORD = 24  # bits put out at a time; the range lies in 2^24 .. 2^48
_LEAST, _LOW = np.int64(1 << _WORD), np.int64((1 << _WORD) - 1)
_BOUND = 1 << 20  # of the weights
_SQUASH = np.clip(np.round(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), 1, 4094).astype(np.int64)
_STRETCH = np.clip(np.round(256 * np.log((np.arange(4096) + 0.5) / (4095.5 - np.arange(4096)))), -2047, 2047).astype(np.int64)
_SHARE = np.concatenate([[0], np.round(16 * 2.0 ** (np.arange(255) / 4))])


def classes(ids: np.ndarray) -> np.ndarray:
    """Order-0 class of each of the 65,536 ids: 0 if it does not occur, else 1 more than four
    times the binary logarithm of its count."""
    counts = np.bincount(ids, minlength=IDS)
    return np.where(counts, 1 + np.round(4 * np.log2(np.maximum(counts, 1))), 0).astype(np.uint8)


def _order0(kinds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Start and frequency of every id of 2^20; without classes all ids are alike."""
    if kinds is None or not kinds.any():
        kinds = np.ones(IDS, np.uint8)
    share = _SHARE[kinds]
    room = (1 << _PLAIN) - np.count_nonzero(share)
    freq = np.where(share > 0, np.maximum(np.floor(share / share.sum() * room), 1), 0).astype(np.int64)
    freq[np.argmax(freq)] += (1 << _PLAIN) - freq.sum()
    return np.cumsum(freq) - freq, freq


class _Model:
    """Predictions and adaptive state of all lanes."""

    def __init__(self, lanes: int):
        every = np.arange(lanes)
        self.table = np.zeros(2 * lanes * SLOTS, np.int32)  # order 1, order 2: predicted id and, above it, its confidence
        self.table_at = np.stack([every, every + lanes]) * SLOTS
        self.chance = np.full(3 * lanes * 8, 1 << 13, np.int64)  # order-0, 1, 2 views of "order 2 is right"
        self.chance_at = np.stack([every, every + lanes, every + 2 * lanes]) * 8
        self.weight = np.full((3, lanes), 22000, np.int64)
        self.single = np.full(lanes * 4, 1 << 13, np.int64)  # "order 1 is right" by its confidence
        self.single_at = every * 4
        self.prev = np.zeros(lanes, np.int64)
        self.slot, self.ids, self.sure = (np.zeros((2, lanes), np.int64) for _ in range(3))
        self.view, self.p, self.st, self.work = (np.zeros((3, lanes), np.int64) for _ in range(4))
        self.got = np.zeros((2, lanes), np.int32)
        self.p2, self.pick, self.older, self.f1 = (np.zeros(lanes, np.int64) for _ in range(4))

    def split(self):
        """Predicted ids of order 2 and 1, and their frequencies of 4096."""
        slot = self.slot
        np.multiply(self.prev, 40503, out=slot[0])
        slot[0] >>= 3
        np.multiply(self.prev, 0x9E3779B1, out=slot[1])
        slot[1] += self.older
        slot[1] >>= 15
        slot &= SLOTS - 1
        slot += self.table_at
        np.take(self.table, slot, out=self.got, mode="clip")
        np.bitwise_and(self.got, IDS - 1, out=self.ids)
        np.right_shift(self.got, 16, out=self.sure)
        self.same = self.ids[0] == self.ids[1]
        view = self.view
        view[0] = self.same
        np.multiply(view[0], 4, out=view[2])
        np.add(self.sure[0], view[2], out=view[1])
        view[2] += self.sure[1]
        view += self.chance_at
        np.take(self.chance, view, out=self.p, mode="clip")
        np.right_shift(self.p, 4, out=self.work)
        np.take(_STRETCH, self.work, out=self.st, mode="clip")
        np.multiply(self.weight, self.st, out=self.work)
        dot = self.work[0]
        dot += self.work[1]
        dot += self.work[2]
        dot >>= 16
        dot += 2047
        np.take(_SQUASH, dot, out=self.p2, mode="clip")
        self.single_slot = self.sure[0] + self.single_at
        np.take(self.single, self.single_slot, out=self.pick, mode="clip")
        room, f1 = 4095 - self.p2, self.f1
        np.right_shift(self.pick, 4, out=f1)
        f1 *= room + 1
        f1 >>= 12
        np.maximum(f1, 1, out=f1)
        np.minimum(f1, room, out=f1)
        f1 *= ~self.same
        return self.p2, f1

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray) -> None:
        work = self.work
        np.subtract(right2 * 65535, self.p, out=work)
        work >>= 5
        work += self.p
        self.chance[self.view] = work
        np.multiply(self.st, (right2 * 4096 - self.p2) * 10, out=work)
        work >>= 14
        self.weight += work
        np.maximum(self.weight, -_BOUND, out=self.weight)
        np.minimum(self.weight, _BOUND, out=self.weight)
        step = right1 * 65535 - self.pick
        step >>= 5
        step *= ~(right2 | self.same)
        step += self.pick
        self.single[self.single_slot] = step
        up = (self.sure < 3) * np.int32(IDS)
        up += self.got
        down = np.where(self.sure > 1, self.got - np.int32(IDS), ids.astype(np.int32))
        self.table[self.slot] = np.where(self.ids == ids, up, down)
        np.multiply(self.prev, 0x85EBCA6B, out=self.older)
        self.prev = ids


def _encode_lanes(ids: np.ndarray, lengths: np.ndarray, order0) -> list[bytes]:
    n, steps = ids.shape
    ids = np.ascontiguousarray(ids.T)
    low, rng = np.zeros(n, np.int64), np.full(n, (1 << 48) - 1, np.int64)
    words, at = np.zeros((2 * steps + 3) * n, np.uint32), np.arange(n)
    final, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def renew():
        out = np.flatnonzero(rng < _LEAST)
        lo, where = low[out], at[out]
        words[where] = lo >> _WORD  # bit 24 is a carry
        at[out] = where + n
        low[out] = (lo & _LOW) << _WORD
        rng[out] <<= _WORD

    model, (start, freq) = _Model(n), order0
    for t in range(steps):
        x = ids[t]
        f2, f1 = model.split()
        right2 = x == model.ids[1]
        right1 = x == model.ids[0]
        right1 &= ~right2
        rest = f2 + f1
        unit = rng >> _KNOWN
        low += np.where(right2, 0, np.where(right1, f2, rest)) * unit
        np.multiply(np.where(right2, f2, np.where(right1, f1, 4096 - rest)), unit, out=rng)
        renew()
        lanes = np.flatnonzero(~(right2 | right1))
        if len(lanes):
            y = x[lanes]
            unit = rng[lanes] >> _PLAIN
            low[lanes] += start[y] * unit
            rng[lanes] = freq[y] * unit
            renew()
        model.learn(x, right2, right1)
        done = np.flatnonzero(lengths == t + 1)
        if len(done):  # the highest word within the range decides; the decoder reads on in zeros
            final[done] = (low[done] + rng[done] - 1) >> _WORD
            ends[done] = at[done]
    words[ends] = final
    last = int(ends.max()) // n + 1
    grid = words[:last * n].reshape(last, n)
    grid[np.arange(last)[:, None] > ends // n] = 0  # of lanes past their end
    for k in range(last - 1, 0, -1):
        grid[k - 1] += grid[k] >> _WORD
        grid[k] &= _LOW.astype(np.uint32)
    data = np.ascontiguousarray(grid.T).astype(">u4").view(np.uint8).reshape(n, last, 4)[:, :, 1:].reshape(n, 3 * last)
    return [d[:3 * k].tobytes().rstrip(b"\0") for d, k in zip(data, (ends // n + 1).tolist())]


def _decode_lanes(payloads: list[bytes], lengths: np.ndarray, order0) -> np.ndarray:
    n, steps = len(payloads), int(lengths.max())
    height = max(map(len, payloads)) // 3 + 4
    data = np.frombuffer(b"".join(p.ljust(3 * height, b"\0") for p in payloads), np.uint8).reshape(n, height, 3)
    words = np.zeros((height, n), np.int64)
    for k in range(3):
        words = words << 8 | data[:, :, k].T
    words = np.ascontiguousarray(words).ravel()
    code, rng, at = words[:n] << _WORD | words[n:2 * n], np.full(n, (1 << 48) - 1, np.int64), np.arange(2 * n, 3 * n)

    def renew():
        need = np.flatnonzero(rng < _LEAST)
        where = at[need]
        code[need] = code[need] << _WORD | np.take(words, where, mode="clip")
        at[need] = where + n
        rng[need] <<= _WORD

    model, (start, freq) = _Model(n), order0
    holder = np.repeat(np.arange(IDS, dtype=np.uint16), freq)
    out = np.zeros((steps, n), np.int64)
    for t in range(steps):
        f2, f1 = model.split()
        unit = rng >> _KNOWN
        # a lane past its end reads noise; its values are kept in range and dropped
        v = (code / unit).astype(np.int64)
        rest = f2 + f1
        right2 = v < f2
        right1 = v < rest
        right1 &= ~right2
        code -= np.where(right2, 0, np.where(right1, f2, rest)) * unit
        np.multiply(np.where(right2, f2, np.where(right1, f1, 4096 - rest)), unit, out=rng)
        renew()
        x = out[t]
        x[:] = np.where(right2, model.ids[1], model.ids[0])
        lanes = np.flatnonzero(~(right2 | right1))
        if len(lanes):
            c, unit = code[lanes], rng[lanes] >> _PLAIN
            y = np.take(holder, (c / unit).astype(np.int64), mode="clip")
            code[lanes] = c - start[y] * unit
            rng[lanes] = freq[y] * unit
            renew()
            x[lanes] = y
        model.learn(x, right2, right1)
    return out.T


def encode(ids: np.ndarray, block: int, lanes: int = LANES, kinds: np.ndarray | None = None) -> list[bytes]:
    """Payloads of the blocks of ``ids`` (below 65,536 each); ``kinds`` are their ``classes``."""
    if len(ids) and (int(ids.max()) >= IDS or int(ids.min()) < 0):
        raise ValueError("ids must lie in 0 .. 65535")
    n = -(-len(ids) // block)
    grid = np.zeros(n * block, np.int64)
    grid[:len(ids)] = ids
    lengths = np.full(n, block)
    if n:
        lengths[-1] = len(ids) - (n - 1) * block
    order0 = _order0(kinds)
    grid, out = grid.reshape(n, block), []
    for k in range(0, n, lanes):
        steps = int(lengths[k:k + lanes].max())
        out += _encode_lanes(grid[k:k + lanes, :steps], lengths[k:k + lanes], order0)
    return out


def decode(payloads: list[bytes], lengths: np.ndarray, lanes: int = LANES, kinds: np.ndarray | None = None) -> np.ndarray:
    """The ids of blocks of these lengths, by the ``classes`` that they were written with."""
    parts, order0 = [], _order0(kinds)
    for k in range(0, len(payloads), lanes):
        size = lengths[k:k + lanes]
        grid = _decode_lanes(payloads[k:k + lanes], size, order0)
        parts.append(grid[np.arange(grid.shape[1])[None, :] < size[:, None]])
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)
