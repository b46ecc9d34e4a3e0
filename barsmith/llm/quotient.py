"""Counting quotient filters: multisets of fingerprints as bit vectors and remainders.

A fingerprint's high bits are its quotient, the rest its remainder. Remainders lie in
ascending order of (quotient, remainder), one slot for each distinct fingerprint; a bit
per quotient says whether it has a run of slots, a bit per slot whether its run ends
there. So the quotient isn't stored, and the fingerprint comes back in full. Slots met
more than once have a counter in a short list beside the filter.

Because slots are sorted, filters of any sizes merge losslessly: their (quotient,
remainder) sequences are merged in order and counters of equal fingerprints added.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<BBIII")  # quotient bits, bytes per remainder, slots, occupied bytes, counters


def counted(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints and how often each occurs."""
    order = np.argsort(fingerprints, kind="stable")  # merges sorted runs
    found = fingerprints[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else np.empty(0, np.int64)
    weights = np.ones(len(found), np.int64) if counts is None else counts[order]
    return found[first], np.add.reduceat(weights, first) if len(first) else np.empty(0, np.int64)


def pack(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of sorted distinct fingerprints below 2**bits (load factor 1/2 to 1)."""
    n = len(fingerprints)
    quotient_bits = min(max(n - 1, 1).bit_length(), bits)
    remainder_bits = bits - quotient_bits
    quotients = fingerprints >> remainder_bits
    width = -(-remainder_bits // 8)
    remainders = (fingerprints & ((1 << remainder_bits) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotients] = True
    run_end = np.append(quotients[1:] != quotients[:-1], True) if n else np.empty(0, bool)
    many = np.flatnonzero(counts > 1)
    packed = np.packbits(occupied).tobytes()
    return b"".join([
        HEAD.pack(quotient_bits, width, n, len(packed), len(many)), packed, np.packbits(run_end).tobytes(),
        remainders.tobytes(), many.astype("<u4").tobytes(), counts[many].astype("<u8").tobytes(),
    ])


def unpack(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct fingerprints of a filter, and their counts."""
    quotient_bits, width, n, size, many = HEAD.unpack_from(data)
    at = HEAD.size
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=1 << quotient_bits))
    at += size
    ends = -(-n // 8)
    run_end = np.unpackbits(np.frombuffer(data, np.uint8, ends, at), count=n)
    at += ends
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    run = np.cumsum(run_end) - run_end  # runs that end before the slot
    quotients = occupied[run] if n else np.empty(0, np.int64)
    fingerprints = (quotients << (bits - quotient_bits)) | remainders.view("<u8").ravel().astype(np.int64)
    counts = np.ones(n, np.int64)
    slots = np.frombuffer(data, "<u4", many, at)
    counts[slots] = np.frombuffer(data, "<u8", many, at + 4 * many)
    return fingerprints, counts


def merge(filters: list[bytes], bits: int) -> bytes:
    """The filter of all fingerprints of several filters."""
    parts = [unpack(f, bits) for f in filters]
    none = np.empty(0, np.int64)
    found, counts = counted(np.concatenate([none, *(p[0] for p in parts)]), np.concatenate([none, *(p[1] for p in parts)]))
    return pack(found, counts, bits)
