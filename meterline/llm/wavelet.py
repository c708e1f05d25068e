"""Wavelet matrix over a sequence of whole numbers, in numpy.

One bit-plane per bit of the largest number. On each plane the sequence is dealt stably
into zeros and ones, so following a symbol down the planes is a chain of ranks. Ranks come
from a directory of running counts per 64-bit word. All lookups take arrays.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

WORD = 64
HEAD = struct.Struct("<4sIQ")
MARK = b"WVM1"


class BitPlane:
    """A bit vector with constant-time rank."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        self.before = np.zeros(len(words) + 1, dtype=np.uint32)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        raw = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-len(bits) // WORD) * 8 + 8, dtype=np.uint8)  # a spare word, so rank(size) needs no test
        padded[: len(raw)] = raw
        return cls(padded.view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), bitorder="little", count=self.size).view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 6].astype(np.int64) + np.bitwise_count(self.words[at >> 6] & low)

    def ones(self) -> int:
        return int(self.before[-1])


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], size: int):
        self.planes, self.size = planes, size
        self.zeros = [size - p.ones() for p in planes]
        self.width = len(planes)

    @classmethod
    def of(cls, symbols: np.ndarray) -> WaveletMatrix:
        """Build from non-negative numbers."""
        top = int(symbols.max()) if len(symbols) else 0
        width = max(1, top.bit_length())
        now = symbols.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for level in range(width - 1, -1, -1):
            bits = (now & now.dtype.type(1 << level)) != 0
            planes.append(BitPlane.of(bits))
            # Taking by places is some times faster than taking by mask.
            now = np.concatenate((now[np.flatnonzero(~bits)], now[np.flatnonzero(bits)]))
        return cls(planes, len(symbols))

    def _bit(self, level: int, symbols: np.ndarray) -> np.ndarray:
        return (symbols >> (self.width - 1 - level)) & 1 == 1

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where each place arrives below the last plane if it follows its symbol."""
        for level, plane in enumerate(self.planes):
            ones = plane.rank(at)
            at = np.where(self._bit(level, symbols), self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self.down(symbols, at) - self.down(symbols, np.zeros_like(at))

    def count(self, symbols: np.ndarray) -> np.ndarray:
        """How often each symbol occurs; symbols out of range occur nowhere."""
        known = (symbols >= 0) & (symbols < 1 << self.width)
        found = self.rank(np.where(known, symbols, 0), np.full(len(symbols), self.size, dtype=np.int64))
        return np.where(known, found, 0)

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and where the places arrive below the last plane."""
        symbols = np.zeros(len(at), dtype=np.int64)
        for level, plane in enumerate(self.planes):
            bit, ones = plane.get(at), plane.rank(at)
            symbols = symbols << 1 | bit
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return symbols, at

    def select(self, symbol: int, nth: np.ndarray) -> np.ndarray:
        """Places of the nth occurrences (from 0) of a symbol that has that many."""
        at = self.down(np.array([symbol]), np.array([0]))[0] + nth
        for level in range(self.width - 1, -1, -1):
            plane, zeros = self.planes[level], self.zeros[level]
            one = bool(self._bit(level, np.array([symbol]))[0])
            places = np.flatnonzero(plane.bits() == one)
            at = places[at - zeros if one else at]
        return at

    def occurrences(self, symbol: int) -> np.ndarray:
        """All places of a symbol, in order."""
        return self.select(symbol, np.arange(self.count(np.array([symbol]))[0]))

    def symbols(self) -> np.ndarray:
        """The whole sequence, put together from the last plane upwards."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        now = np.zeros(self.size, dtype=kind)
        for level in range(self.width - 1, -1, -1):
            bits = self.planes[level].bits()
            above = np.empty_like(now)
            zeros = self.zeros[level]
            above[np.flatnonzero(~bits)] = now[:zeros]
            above[np.flatnonzero(bits)] = now[zeros:] | kind(1 << (self.width - 1 - level))
            now = above
        return now

    def to_bytes(self) -> bytes:
        """Head, then each plane compressed on its own behind its length."""
        press = zstandard.ZstdCompressor(level=1)
        parts = [HEAD.pack(MARK, self.width, self.size)]
        for plane in self.planes:
            packed = press.compress(plane.words.tobytes())
            parts += [struct.pack("<I", len(packed)), packed]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        mark, width, size = HEAD.unpack_from(raw)
        if mark != MARK:
            raise ValueError("not a wavelet matrix")
        at, planes, unpress = HEAD.size, [], zstandard.ZstdDecompressor()
        for _ in range(width):
            (n,) = struct.unpack_from("<I", raw, at)
            planes.append(BitPlane(np.frombuffer(unpress.decompress(raw[at + 4 : at + 4 + n]), dtype="<u8"), size))
            at += 4 + n
        return cls(planes, size)
