"""Byte runs of a batch, hashed and interned with numpy.

`Runs` holds one buffer and gives XXH64 and CRC-32 of many of its stretches at a time;
`intern` maps equal stretches to one slot of an open-addressed table, probing linearly and
comparing the bytes wherever the keys agree, so that no two different stretches share a
slot. Stretches of up to `SHORT` bytes are handled eight bytes a step for all stretches
together; longer ones, which are few to a buffer, go through the libraries one by one.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
import xxhash

from .common import U64

SHORT = 32
_P1, _P2, _P3, _P4, _P5 = (U64(p) for p in (       # XXH64's primes: fixed values
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U64(by)) | (x >> U64(64 - by))


@functools.cache
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """(effect of a byte in each place of an eight-byte step, CRC of n zero bytes)."""
    step = np.zeros((8, 256), dtype=np.uint32)
    for place in range(8):
        for value in range(256):
            tail = bytes(7 - place)
            step[place, value] = zlib.crc32(bytes([value]) + tail) ^ zlib.crc32(bytes(8 - place))
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 1)], dtype=np.uint32)
    return step, zeros


@functools.cache
def _crc_shift() -> np.ndarray:
    """What n zero bytes make of each byte of a CRC before them."""
    out = np.zeros((SHORT + 1, 4, 256), dtype=np.uint32)
    for n in range(SHORT + 1):
        zeros, base = bytes(n), zlib.crc32(bytes(n))
        for place in range(4):
            out[n, place] = [zlib.crc32(zeros, v << (8 * place)) ^ base for v in range(256)]
    return out


class Runs:
    """Stretches of one buffer, named by start and length in bytes."""

    def __init__(self, buffer: np.ndarray):
        self.size = len(buffer)
        padded = np.zeros(self.size + 16, dtype=np.uint8)
        padded[:self.size] = buffer
        self.bytes = padded
        lane = padded.astype(U64)                     # eight bytes from each place on
        for by in (1, 2, 4):
            lane[:-by] |= lane[by:] << U64(8 * by)
        self.lane = lane

    def raw(self, start: int, length: int) -> bytes:
        return self.bytes[start:start + length].tobytes()

    def _lane(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The first min(length, 8) bytes of each stretch, the rest zero; length >= 1."""
        left = U64(8) * (U64(8) - np.minimum(length, 8).astype(U64))
        return (self.lane[start] << left) >> left

    def xxh64(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """XXH64 with seed 0."""
        h = _P5 + length.astype(U64)
        at = start.copy()
        live = np.flatnonzero((length >= 8) & (length < SHORT))
        while len(live):
            k = _turn(self.lane[at[live]] * _P2, 31) * _P1
            h[live] = _turn(h[live] ^ k, 27) * _P1 + _P4
            at[live] += 8
            live = live[start[live] + length[live] - at[live] >= 8]
        left = start + length - at
        live = np.flatnonzero((left >= 4) & (length < SHORT))
        word = self.lane[at[live]] & U64(0xFFFFFFFF)
        h[live] = _turn(h[live] ^ word * _P1, 23) * _P2 + _P3
        at[live] += 4
        live = np.flatnonzero((start + length > at) & (length < SHORT))
        while len(live):
            h[live] = _turn(h[live] ^ self.bytes[at[live]].astype(U64) * _P5, 11) * _P1
            at[live] += 1
            live = live[start[live] + length[live] > at[live]]
        h = (h ^ (h >> U64(33))) * _P2
        h = (h ^ (h >> U64(29))) * _P3
        h ^= h >> U64(32)
        for i in np.flatnonzero(length >= SHORT):
            h[i] = xxhash.xxh64_intdigest(self.raw(start[i], length[i]))
        return h

    def crc32(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of each stretch."""
        step, zeros = _crc_tables()
        out = np.zeros(len(start), dtype=np.uint32)
        short = np.flatnonzero((length > 0) & (length <= SHORT))
        first = (length[short] - 1) % 8 + 1           # the odd bytes come first, after zeros
        at = start[short]
        lane = self._lane(at, first) << (U64(8) * (8 - first).astype(U64))
        at, left = at + first, length[short] - first
        state = self._step(step, lane)
        live = np.flatnonzero(left > 0)
        while len(live):
            state[live] = self._step(step, self.lane[at[live]] ^ state[live])
            at[live] += 8
            left[live] -= 8
            live = live[left[live] > 0]
        out[short] = state ^ zeros[length[short]]
        for i in np.flatnonzero(length > SHORT):
            out[i] = zlib.crc32(self.raw(start[i], length[i]))
        return out

    @staticmethod
    def _step(step: np.ndarray, lane: np.ndarray) -> np.ndarray:
        parts = lane.view(np.uint8).reshape(-1, 8)
        out = step[0][parts[:, 0]]
        for place in range(1, 8):
            out ^= step[place][parts[:, place]]
        return out

    def crc32_after(self, before: np.ndarray, own: np.ndarray, start: np.ndarray,
                    length: np.ndarray) -> np.ndarray:
        """CRC-32 of some bytes with the CRC `before`, followed by each stretch with the CRC
        `own`."""
        shift = _crc_shift()
        n = np.minimum(length, SHORT)
        out = own.copy()
        for place in range(4):
            out ^= shift[n, place, (before >> np.uint32(8 * place)) & np.uint32(255)]
        for i in np.flatnonzero(length > SHORT):
            out[i] = zlib.crc32(self.raw(start[i], length[i]), int(before[i]))
        return out

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of one length at a and at b have the same bytes."""
        same = np.ones(len(a), dtype=bool)
        live = np.flatnonzero((length > 0) & (length <= SHORT) & (a != b))
        done = 0
        while len(live):
            left = length[live] - done
            same[live] = self._lane(a[live] + done, left) == self._lane(b[live] + done, left)
            done += 8
            live = live[same[live] & (length[live] > done)]
        for i in np.flatnonzero((length > SHORT) & (a != b)):
            same[i] = self.raw(a[i], length[i]) == self.raw(b[i], length[i])
        return same

    def intern(self, start: np.ndarray, length: np.ndarray, key: np.ndarray | None = None
               ) -> tuple[np.ndarray, np.ndarray]:
        """(slot of every occurrence, an occurrence of every slot); equal bytes, one slot."""
        key = self.xxh64(start, length) if key is None else key
        n = len(start)
        size = 1 << max(4, int(2 * n).bit_length())
        holder = np.full(size, -1, dtype=np.int64)     # the occurrence that fills a place
        place = (key & U64(size - 1)).astype(np.int64)
        live = np.arange(n)
        while len(live):
            at = place[live]
            free = holder[at] < 0
            holder[at[free]] = live[free]              # of several, one stays
            held = holder[at]
            match = (key[held] == key[live]) & (length[held] == length[live])
            sure = np.flatnonzero(match)
            match[sure] = self.equal(start[held[sure]], start[live[sure]], length[live[sure]])
            live = live[~match]
            place[live] = (place[live] + 1) & (size - 1)
        filled = np.flatnonzero(holder >= 0)
        number = np.empty(size, dtype=np.int64)
        number[filled] = np.arange(len(filled))
        return number[place], holder[filled]
