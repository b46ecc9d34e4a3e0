"""Adaptive context-mixing range coder for token-id blocks.

Ids (16 bit) of a block are coded one after the other with models that start
afresh in every block:

* order 2 and order 1: the id that last followed the previous two ids / one id,
  each with a count of how often it was right in a row;
* order 0: adaptive frequencies of the ids themselves, as a tree of 64 x 32 x 32
  cumulative tables.

The longest context with a prediction names a candidate id. The chance that it is
right is mixed from three adaptive estimates (overall, by order-1 state, by
order-2 state) in the logistic domain with weights learned by gradient; a range
coder codes hit or miss, and after a miss the id from the order-0 tables.

Many blocks run side by side as numpy lanes: one step codes one id of every block.
All arithmetic is in integers, so any machine decodes what another has written.

Block bytes: ``<IIII`` = magic, ids in the block, crc32 of the ids (little-endian
unsigned 32 bit), crc32 of the code; then the code.
"""

from __future__ import annotations

import struct
import zlib
from decimal import Decimal

import numpy as np

MAGIC = 0x31434442
HEADER = struct.Struct("<IIII")

_BITS = 14
_TOT = 1 << _BITS
_SLOTS1 = 12  # log2 of the order-1 table
_SLOTS2 = 12  # log2 of the order-2 table
_LEVELS = ((64, 10, 5), (32, 5, 4), (32, 0, 3))  # width, shift of the id, adaption rate
_ROOM = np.uint64(1) << np.uint64(48)
_LOW = np.uint64(1) << np.uint64(32)
_MASK = _LOW - np.uint64(1)
_U16, _U32, _U14 = np.uint64(16), np.uint64(32), np.uint64(_BITS)


def _logistic_tables() -> tuple[np.ndarray, np.ndarray]:
    """squash[d + 2048] = 2^14 / (1 + e^(-d/256)); stretch is its inverse by 4096 steps."""
    squash = np.array([int(_TOT / (1 + (Decimal(-d) / 256).exp())) for d in range(-2048, 2048)], np.int32)
    squash = np.clip(squash, 32, _TOT - 32)
    stretch = np.clip(np.searchsorted(squash, np.arange(4096) * 4 + 2), 0, 4095).astype(np.int32) - 2048
    return squash, stretch


_SQUASH, _STRETCH = _logistic_tables()


def _targets(width: int) -> np.ndarray:
    """Row s: where cumulative entries (and their total) move when symbol s was seen; every gap stays >= 1."""
    i, s = np.arange(width + 1), np.arange(width)[:, None]
    return np.where(i <= s, i, _TOT - width + i).astype(np.int16)


_TARGETS = [_targets(w) for w, _, _ in _LEVELS]


class _Encoder:
    """Range coder of all lanes; ``low`` and ``rng`` may be worked on in compacted copies."""

    def __init__(self, lanes: int, steps: int):
        self.low = np.zeros(lanes, np.uint64)
        self.rng = np.full(lanes, _ROOM)
        self.pos = np.zeros(lanes, np.int64)
        self.out = np.zeros((lanes, steps + 16), np.uint32)

    def room(self) -> None:
        if self.out.shape[1] - int(self.pos.max(initial=0)) < 24:
            self.out = np.hstack([self.out, np.zeros_like(self.out)])

    def state(self, at) -> tuple[np.ndarray, np.ndarray]:
        return self.low[at], self.rng[at]

    def store(self, at, state) -> None:
        self.low[at], self.rng[at] = state

    def code(self, lanes, state, start, freq) -> None:
        """Narrow each lane's interval to [start, start + freq) of 2^14."""
        low, rng = state
        rng >>= _U14
        low += rng * start
        rng *= freq
        short = np.flatnonzero(rng < _LOW)
        if len(short):
            where, s = lanes[short], low[short]
            p = self.pos[where]
            self.out[where, p] = s >> _U32  # may hold a carry, resolved in finish()
            self.pos[where] = p + 1
            low[short] = (s & _MASK) << _U16
            rng[short] <<= _U16

    def finish(self) -> list[bytes]:
        lanes = np.arange(len(self.low))
        for _ in range(3):
            self.room()
            self.out[lanes, self.pos] = self.low >> _U32
            self.low = (self.low & _MASK) << _U16
            self.pos += 1
        used = int(self.pos.max(initial=0))
        for k in range(used - 1, 0, -1):
            self.out[:, k - 1] += self.out[:, k] >> 16
        digits = (self.out[:, :used] & 0xFFFF).astype("<u2")
        # trailing zero digits are implied: the decoder reads zeros past the end
        return [digits[i, : int(n)].tobytes().rstrip(b"\0") for i, n in enumerate(self.pos)]


class _Decoder:
    def __init__(self, codes: list[bytes]):
        length = max(map(len, codes), default=0) // 2 + 8
        self.digits = np.zeros((len(codes), length), np.uint16)
        for i, c in enumerate(codes):
            c += b"\0" * (len(c) % 2)
            self.digits[i, : len(c) // 2] = np.frombuffer(c, "<u2")
        first = self.digits[:, :3].astype(np.uint64)
        self.low = (first[:, 0] << _U32) | (first[:, 1] << _U16) | first[:, 2]  # code value less the interval's start
        self.rng = np.full(len(codes), _ROOM)
        self.pos = np.full(len(codes), 3, np.int64)

    def state(self, at) -> tuple[np.ndarray, np.ndarray]:
        return self.low[at], self.rng[at]

    def store(self, at, state) -> None:
        self.low[at], self.rng[at] = state

    def value(self, state) -> np.ndarray:
        """Where each lane's code lies in its interval, of 2^14; ``code`` has to follow."""
        low, rng = state
        rng >>= _U14
        return np.minimum(low // rng, np.uint64(_TOT - 1)).astype(np.int16)

    def code(self, lanes, state, start, freq) -> None:
        low, rng = state
        low -= rng * start
        rng *= freq
        short = np.flatnonzero(rng < _LOW)
        if len(short):
            where = lanes[short]
            p = np.minimum(self.pos[where], self.digits.shape[1] - 1)  # a damaged code ends here, its checksum fails
            low[short] = (low[short] << _U16) | self.digits[where, p]
            self.pos[where] = p + 1
            rng[short] <<= _U16


class _Model:
    """The per-lane models; one instance codes or decodes a set of lanes."""

    def __init__(self, lanes: int):
        n = lanes
        self.tree = [
            np.tile((np.arange(w + 1) * (_TOT // w)).astype(np.int16), (n * nodes, 1))
            for (w, _, _), nodes in zip(_LEVELS, (1, 64, 64 * 32))
        ]
        self.nodes = (1, 64, 64 * 32)
        # predicted id | run of hits << 16; 0 in the run means nothing seen
        self.t1 = np.zeros((n, 1 << _SLOTS1), np.uint32)
        self.t2 = np.zeros((n, 1 << _SLOTS2), np.uint32)
        self.p0 = np.full(n, _TOT // 2, np.int32)
        self.p1 = np.full((n, 8), _TOT // 2, np.int32)
        self.p2 = np.full((n, 8), _TOT // 2, np.int32)
        self.w = np.full((3, n), 1 << 14, np.int32)
        self.last = np.zeros(n, np.uint32)
        self.before = np.zeros(n, np.uint32)

    def step(self, at: np.ndarray, ids: np.ndarray | None, coder) -> np.ndarray:
        """Codes ``ids`` of the lanes ``at`` (0 to n - 1) or, with ids None, decodes and returns them."""
        n = len(at)
        last, before = self.last[:n], self.before[:n]
        h1 = (last * np.uint32(0x9E3779B1)) >> np.uint32(32 - _SLOTS1)
        h2 = ((last * np.uint32(0x85EBCA6B)) ^ (before * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - _SLOTS2)
        a1, a2 = at * (1 << _SLOTS1) + h1, at * (1 << _SLOTS2) + h2
        e1, e2 = self.t1.take(a1), self.t2.take(a2)
        run1, run2 = e1 >> np.uint32(16), e2 >> np.uint32(16)
        id1, id2 = e1 & np.uint32(0xFFFF), e2 & np.uint32(0xFFFF)
        guess = np.where(run2 > 0, id2, id1)
        c1 = at * 8 + run1 + 4 * (id1 == guess)
        c2 = at * 8 + run2 + 4 * (id1 == id2)
        q0, q1, q2 = self.p0[:n], self.p1.take(c1), self.p2.take(c2)
        s0, s1, s2 = _STRETCH.take(q0 >> 2), _STRETCH.take(q1 >> 2), _STRETCH.take(q2 >> 2)
        w0, w1, w2 = self.w[0, :n], self.w[1, :n], self.w[2, :n]
        dot = (w0 * s0 + w1 * s1 + w2 * s2) >> 16
        np.maximum(dot, -2048, out=dot)
        np.minimum(dot, 2047, out=dot)
        p = _SQUASH.take(dot + 2048)
        state = (coder.low[:n], coder.rng[:n])
        hit = ids == guess if ids is not None else coder.value(state) < p
        coder.code(at, state, np.where(hit, 0, p).astype(np.uint64), np.where(hit, p, _TOT - p).astype(np.uint64))
        target = hit * np.int32(_TOT - 1)
        err = (target - p) >> 3
        for w, s in ((w0, s0), (w1, s1), (w2, s2)):
            w += (s * err) >> 10
            np.maximum(w, -(1 << 18), out=w)
            np.minimum(w, 1 << 18, out=w)
        q0 += (target - q0) >> 5
        self.p1.put(c1, q1 + ((target - q1) >> 4))
        self.p2.put(c2, q2 + ((target - q2) >> 4))
        miss = np.flatnonzero(~hit)
        got = guess if ids is None else ids
        if len(miss):
            found = self._order0(miss, None if ids is None else ids[miss], coder)
            if ids is None:
                got[miss] = found
        self.t1.put(a1, _followed(got, e1, id1, run1))
        self.t2.put(a2, _followed(got, e2, id2, run2))
        before[:] = last
        last[:] = got
        return got

    def _order0(self, at: np.ndarray, ids: np.ndarray | None, coder) -> np.ndarray:
        node = np.zeros(len(at), np.int64)
        row0 = np.arange(len(at))
        state = coder.state(at)
        if ids is not None:
            ids = ids.astype(np.int64)
        for k, (width, shift, rate) in enumerate(_LEVELS):
            where = at * self.nodes[k] + node
            rows = self.tree[k].take(where, axis=0)  # each row ends with the total
            if ids is not None:
                sym = (ids >> shift) & (width - 1)
            else:
                sym = (rows <= coder.value(state)[:, None]).sum(axis=1, dtype=np.int64) - 1
            flat = row0 * (width + 1) + sym
            start = rows.take(flat).astype(np.uint64)
            coder.code(at, state, start, rows.take(flat + 1).astype(np.uint64) - start)
            rows += (_TARGETS[k].take(sym, axis=0) - rows) >> rate
            self.tree[k][where] = rows
            node = node * width + sym
        coder.store(at, state)
        return node.astype(np.uint32)


def _followed(got: np.ndarray, entry: np.ndarray, known: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Table entries after ``got``: a run of hits grows to 3; a miss halves it, at 0 or 1 the id is replaced."""
    hit = known == got
    longer = known | (np.minimum(run + np.uint32(1), np.uint32(3)) << np.uint32(16))
    other = np.where(run > 1, known | ((run >> np.uint32(1)) << np.uint32(16)), got | np.uint32(1 << 16))
    return np.where(hit, longer, other)


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """One byte string per block of 16-bit ids. Blocks run side by side."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    lengths = np.array([len(blocks[i]) for i in order], np.int64)
    steps = int(lengths.max(initial=0))
    ids = np.zeros((steps, len(blocks)), np.uint32)
    for lane, i in enumerate(order):
        ids[: len(blocks[i]), lane] = blocks[i]
    coder, model = _Encoder(len(blocks), steps), _Model(len(blocks))
    lanes = np.arange(len(blocks))
    for t in range(steps):
        n = int(np.searchsorted(-lengths, -t))  # lanes with more than t ids
        if t % 4 == 0:
            coder.room()
        model.step(lanes[:n], ids[t, :n], coder)
    codes = coder.finish()
    out: list[bytes] = [b""] * len(blocks)
    for lane, i in enumerate(order):
        out[i] = HEADER.pack(MAGIC, len(blocks[i]), zlib.crc32(np.asarray(blocks[i]).astype("<u4").tobytes()), zlib.crc32(codes[lane])) + codes[lane]
    return out


def decode_blocks(coded: list[bytes]) -> list[np.ndarray]:
    """The ids (``<u4``) of each block; raises if a checksum doesn't hold."""
    heads, codes = [], []
    for c in coded:
        magic, n, ids_crc, code_crc = HEADER.unpack_from(c)
        if magic != MAGIC or zlib.crc32(c[HEADER.size :]) != code_crc:
            raise ValueError("damaged block")
        heads.append((n, ids_crc))
        codes.append(c[HEADER.size :])
    order = sorted(range(len(coded)), key=lambda i: -heads[i][0])
    lengths = np.array([heads[i][0] for i in order], np.int64)
    steps = int(lengths.max(initial=0))
    ids = np.zeros((steps, len(coded)), "<u4")
    coder, model = _Decoder([codes[i] for i in order]), _Model(len(coded))
    lanes = np.arange(len(coded))
    for t in range(steps):
        n = int(np.searchsorted(-lengths, -t))
        ids[t, :n] = model.step(lanes[:n], None, coder)
    out: list[np.ndarray] = [np.empty(0, "<u4")] * len(coded)
    for lane, i in enumerate(order):
        out[i] = np.ascontiguousarray(ids[: heads[i][0], lane])
        if zlib.crc32(out[i].tobytes()) != heads[i][1]:
            raise ValueError("block does not decode to what was written")
    return out
