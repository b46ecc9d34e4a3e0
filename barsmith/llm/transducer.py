"""One pass over UTF-8 bytes: words, capitals, code points, symbols and distinct words.

A finite-state transducer with two states, outside and inside a word. ``AFTER`` gives
the state behind a byte, ``EMIT`` what the byte means in a state (events as bits). A
byte alone decides the state behind it, so the state in front of any byte is ``AFTER``
of the byte before it, and all bytes of a batch are looked up at once.

The word spans found go into a hash table with open addressing. A span takes the first
slot on its way that is free or holds the same word: same text, same length and, as the
table verifies, the same bytes. A hash alone never makes two words one.
"""

from __future__ import annotations

import re

import numpy as np

# --- fixed values: byte classes ------------------------------------------------------
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
CAPITAL_BYTES = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOL_BYTES = b"#$%&*|"

WORD_BEGINS, WORD_ENDS, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8, 16
OUTSIDE, INSIDE = 0, 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    after = np.full(256, INSIDE, np.uint8)
    after[list(SPACE)] = OUTSIDE
    emit = np.zeros((2, 256), np.uint8)
    emit[OUTSIDE, after == INSIDE] |= WORD_BEGINS
    emit[INSIDE, after == OUTSIDE] |= WORD_ENDS
    emit[:, list(CAPITAL_BYTES)] |= CAPITAL
    emit[:, list(SYMBOL_BYTES)] |= SYMBOL
    emit[:, [b for b in range(256) if b & 0xC0 != 0x80]] |= POINT  # all but continuation bytes
    return after, emit.ravel()


AFTER, EMIT = _tables()
_GAP = re.compile(b"[" + SPACE + b"]")

GROUP_BYTES = 1 << 20  # bytes looked up at once
SEGMENT_BYTES = 4 << 20  # a longer text is cut at the next white space
CHUNKED = 64  # longer words are hashed and compared one by one

_MASK = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], "<u8")  # by number of bytes left
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Spans:
    """Word spans of ``codes`` (with 8 bytes to spare), each belonging to a text."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray):
        self.codes, self.starts, self.lengths, self.owners = codes, starts, lengths, owners
        self._eights = np.lib.stride_tricks.as_strided(codes[: len(codes) - 7], (len(codes) - 7, 8), (1, 1))

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.codes[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()

    def _chunk(self, spans: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at + 8`` of spans longer than ``at``, as integers."""
        eight = self._eights[self.starts[spans] + at].view("<u8").ravel()
        return eight & _MASK[np.minimum(self.lengths[spans] - at, 8)]

    def hashes(self) -> np.ndarray:
        h = (self.owners.astype("<u8") << np.uint64(32)) ^ self.lengths.astype("<u8")
        live, at = np.flatnonzero(self.lengths <= CHUNKED), 0
        while len(live):
            mixed = (h[live] ^ self._chunk(live, at)) * _MIX
            h[live] = mixed ^ (mixed >> np.uint64(29))
            at += 8
            live = live[self.lengths[live] > at]
        for i in np.flatnonzero(self.lengths > CHUNKED):
            h[i] ^= np.uint64(hash(self.word(i)) & 0xFFFFFFFFFFFFFFFF)
        return h * _MIX

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` are the same word of the same text, byte for byte."""
        equal = (a == b) | ((self.owners[a] == self.owners[b]) & (self.lengths[a] == self.lengths[b]))
        live, at = np.flatnonzero(equal & (a != b) & (self.lengths[a] <= CHUNKED)), 0
        long = np.flatnonzero(equal & (a != b) & (self.lengths[a] > CHUNKED))
        while len(live):
            match = self._chunk(a[live], at) == self._chunk(b[live], at)
            equal[live[~match]] = False
            at += 8
            live = live[match]
            live = live[self.lengths[a[live]] > at]
        for i in long:
            equal[i] = self.word(a[i]) == self.word(b[i])
        return equal

    def distinct(self) -> np.ndarray:
        """One span of each distinct word of each text."""
        if not len(self):
            return np.empty(0, np.int64)
        bits = (2 * len(self)).bit_length()
        table = np.full(1 << bits, -1, np.int64)
        slot = (self.hashes() >> np.uint64(64 - bits)).astype(np.int64)
        waiting = np.arange(len(self))
        while len(waiting):
            free = table[slot[waiting]] < 0
            table[slot[waiting[free]]] = waiting[free]  # one of those that ask for a slot gets it
            settled = self.same(waiting, table[slot[waiting]])
            waiting = waiting[~settled]
            slot[waiting] = (slot[waiting] + 1) & ((1 << bits) - 1)
        return table[table >= 0]


def _segments(text: bytes) -> list[bytes]:
    """``text`` in pieces of about ``SEGMENT_BYTES``, no word cut."""
    out, at = [], 0
    while len(text) - at > SEGMENT_BYTES:
        gap = _GAP.search(text, at + SEGMENT_BYTES)
        if gap is None:
            break
        out.append(text[at : gap.start()])
        at = gap.start()
    return [*out, text[at:]]


COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def _measure(pieces: list[bytes], cut: list[bool]) -> tuple[np.ndarray, list[list[bytes] | None]]:
    """Counts of each piece (a row of ``COUNTS``), and for cut texts the distinct words."""
    # a blank behind each piece ends its last word; 8 bytes to spare
    codes = np.frombuffer(b" ".join(pieces) + b" " + bytes(8), np.uint8)
    body = codes[:-8]
    begins = np.cumsum([0] + [len(p) + 1 for p in pieces[:-1]])
    state = np.empty(len(body), np.uint16)
    state[0] = OUTSIDE
    state[1:] = AFTER[body[:-1]]
    events = EMIT[(state << 8) | body]
    out = np.zeros((len(pieces), len(COUNTS)), np.int64)
    for column, event in ((0, WORD_BEGINS), (2, CAPITAL), (3, POINT), (4, SYMBOL)):
        out[:, column] = np.add.reduceat((events & event) != 0, begins, dtype=np.int64)
    out[:, 3] -= 1  # the blank behind
    starts = np.flatnonzero(events & WORD_BEGINS)
    lengths = np.flatnonzero(events & WORD_ENDS) - starts
    owners = np.repeat(np.arange(len(pieces)), out[:, 0])
    spans = Spans(codes, starts, lengths, owners)
    first = spans.distinct()
    of = owners[first]
    out[:, 1] = np.bincount(of, minlength=len(pieces))
    words: list[list[bytes] | None] = [None] * len(pieces)
    for i in np.flatnonzero(cut):
        words[i] = [spans.word(k) for k in first[of == i]]
    return out, words


def text_counts(texts: list[bytes]) -> np.ndarray:
    """A row of ``COUNTS`` for each text; whole texts, however long."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    pieces: list[bytes] = []
    owner: list[int] = []
    cut: list[bool] = []
    open_text, known = -1, set()  # the cut text whose words are being gathered
    held = 0

    def flush():
        nonlocal pieces, owner, cut, open_text, known, held
        if not pieces:
            return
        counts, words = _measure(pieces, cut)
        for i, row, found in zip(owner, counts, words):
            distinct = out[i, 1]
            out[i] += row
            if found is not None:
                if i != open_text:
                    open_text, known = i, set()
                known.update(found)
                out[i, 1] = len(known)
            else:
                out[i, 1] = distinct + row[1]
        pieces, owner, cut, held = [], [], [], 0

    for i, text in enumerate(texts):
        parts = _segments(text)
        for part in parts:
            pieces.append(part)
            owner.append(i)
            cut.append(len(parts) > 1)
            held += len(part)
            if held >= GROUP_BYTES:
                flush()
    flush()
    return out
